"""Exact rank quantiles of many columns without sorting or collecting a column.

1. A sketch of every column proposes a value per target rank, and one a little to either side.
2. One pass counts the rows below and at every proposed value of all columns. This proves or refutes
   the proposals (``count(x < v) < rank <= count(x <= v)``) and tells how many values are left between
   the neighbours of a refuted one.
3. As these are few, they are counted one by one in one more pass. Only if they are more than
   ``GATHER`` - the number is known by then - are they sketched again inside their ranges.

Every pass is a partial aggregation; what reaches the driver is a few numbers per column, and at
most ``GATHER`` values.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.missing import no_nan

# sketch entries over all columns of one pass; bounds the memory of a task
SKETCH_BUDGET = 800_000
COLUMNS_PER_PASS = 50
GATHER = 500_000
# a proposal need not be close: what lies between two of them is counted
PROPOSAL_ACCURACY = 10_000


def sketch_accuracy(columns: int) -> int:
    """Accuracy of each sketch when so many are held at once."""
    return max(10_000, min(1_000_000, SKETCH_BUDGET // max(1, columns)))


def _proposal_accuracy(sketches: int) -> int:
    return max(50, min(PROPOSAL_ACCURACY, sketch_accuracy(1), SKETCH_BUDGET // max(1, sketches)))


def target_rank(probability: float, n: int) -> int:
    exact = Fraction(str(probability)) * n
    return max(1, -(-exact.numerator // exact.denominator))


class _Target:
    """One wanted rank of one column and the open value range it is known to lie in."""

    def __init__(self, column: str, rank: int, probability: float):
        self.column, self.rank, self.probability = column, rank, probability
        self.low, self.high = None, None          # exclusive limits
        self.at_or_below_low, self.below_high = 0, None
        self.answer = None

    def learn(self, value: float, below: int, at_or_below: int) -> None:
        if below < self.rank <= at_or_below:
            self.answer = value
        elif at_or_below < self.rank:
            if self.low is None or value > self.low:
                self.low, self.at_or_below_low = value, at_or_below
        elif self.high is None or value < self.high:
            self.high, self.below_high = value, below

    def left(self, count: int) -> int:
        """Rows inside the range."""
        return (count if self.below_high is None else self.below_high) - self.at_or_below_low

    def inside(self, x: Column) -> Column:
        keep = x.isNotNull()
        if self.low is not None:
            keep = keep & (x > F.lit(self.low))
        if self.high is not None:
            keep = keep & (x < F.lit(self.high))
        return keep


def exact_quantiles(df: DataFrame, columns: list[str],
                    probabilities: list[float]) -> dict[str, list[float | None]]:
    """Rank quantiles (elements of the data) per column; None for a column of missings."""
    out: dict[str, list[float | None]] = {}
    for start in range(0, len(columns), COLUMNS_PER_PASS):
        out.update(_pass(df, columns[start:start + COLUMNS_PER_PASS], probabilities))
    return out


def _pass(df, columns, probabilities):
    accuracy = _proposal_accuracy(len(columns))
    # generated names: the input names may hold dots or quotes
    x = {c: F.col(f"x{i}") for i, c in enumerate(columns)}
    data = df.select(*[
        no_nan(F.col(f"`{c}`"), df.schema[c].dataType).cast("double").alias(f"x{i}")
        for i, c in enumerate(columns)])

    near = sorted({min(1.0, max(0.0, p + d)) for p in probabilities for d in (-2.0 / accuracy, 0, 2.0 / accuracy)})
    grid = F.array(*[F.lit(p) for p in near])
    first = data.agg(*[
        e for i, c in enumerate(columns) for e in (
            F.count(x[c]).alias(f"n{i}"),
            F.percentile_approx(x[c], grid, F.lit(accuracy)).alias(f"q{i}"))
    ]).first()
    count = {c: first[f"n{i}"] for i, c in enumerate(columns)}
    targets = [_Target(c, target_rank(p, count[c]), p)
               for c in columns if count[c] for p in probabilities]
    proposals = {c: set(first[f"q{i}"] or ()) for i, c in enumerate(columns)}

    while True:
        _verify(data, columns, proposals, targets)
        open_targets = [t for t in targets if t.answer is None]
        if not open_targets:
            break
        if sum(t.left(count[t.column]) for t in open_targets) <= GATHER:
            _gather(data, columns, open_targets)
            break
        proposals = _sketch_inside(data, x, count, open_targets, _proposal_accuracy(len(open_targets)))
    found = {(t.column, t.probability): t.answer for t in targets}
    return {c: [found.get((c, p)) for p in probabilities] for c in columns}


def _verify(data, columns, proposals, targets):
    """Count the rows below and at every proposed value, all in one pass, and tell the targets."""
    values = [(i, sorted(proposals.get(c, ()))) for i, c in enumerate(columns) if proposals.get(c)]
    if not values:
        return

    def counted(batches):
        import numpy as np
        import pyarrow as pa
        below = [np.zeros(len(v), dtype=np.int64) for _, v in values]
        up_to = [np.zeros(len(v), dtype=np.int64) for _, v in values]
        for batch in batches:
            for k, (_, v) in enumerate(values):
                x = batch.column(k).drop_null().to_numpy()
                for sums, side in ((below, "right"), (up_to, "left")):
                    passed = np.bincount(np.searchsorted(v, x, side=side), minlength=len(v) + 1)
                    sums[k] += np.cumsum(passed)[:len(v)]
        rows = [(i, j, b, a) for (i, v), bs, us in zip(values, below, up_to)
                for j, (b, a) in enumerate(zip(bs.tolist(), us.tolist()))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.int64()))],
            ["i", "j", "below", "up_to"])

    counts = (data.select(*[f"x{i}" for i, _ in values]).mapInArrow(counted, "i int, j int, below long, up_to long")
              .groupBy("i", "j").agg(F.sum("below").alias("below"), F.sum("up_to").alias("up_to")).collect())
    of_column = dict(values)
    for r in counts:
        for t in targets:
            if t.column == columns[r["i"]] and t.answer is None:
                t.learn(of_column[r["i"]][r["j"]], r["below"], r["up_to"])


def _gather(data, columns, open_targets):
    """Count every value inside the ranges of the open targets in one pass, and find the ranks."""
    ranges = [(columns.index(t.column), t.low, t.high) for t in open_targets]

    def inside(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for k, (i, low, high) in enumerate(ranges):
                x = batch.column(i).drop_null().to_numpy()
                keep = np.ones(len(x), dtype=bool)
                if low is not None:
                    keep &= x > low
                if high is not None:
                    keep &= x < high
                found, n = np.unique(x[keep], return_counts=True)
                if len(found):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k] * len(found), pa.int32()), pa.array(found), pa.array(n.astype(np.int64))],
                        ["k", "v", "n"])

    rows = (data.mapInArrow(inside, "k int, v double, n long").groupBy("k", "v").agg(F.sum("n").alias("n"))
            .collect())  # at most GATHER rows, as counted before
    for k, target in enumerate(open_targets):
        passed = target.at_or_below_low
        for v, n in sorted((r["v"], r["n"]) for r in rows if r["k"] == k):
            passed += n
            if passed >= target.rank:
                target.answer = v
                break


def _sketch_inside(data, x, count, open_targets, accuracy):
    """Propose values for the open targets from a sketch of their own value range."""
    exprs = []
    for i, t in enumerate(open_targets):
        middle = (t.rank - t.at_or_below_low - 0.5) / t.left(count[t.column])
        near = sorted({min(1.0, max(0.0, middle + d)) for d in (-2.0 / accuracy, 0, 2.0 / accuracy)})
        exprs.append(F.percentile_approx(
            F.when(t.inside(x[t.column]), x[t.column]),
            F.array(*[F.lit(p) for p in near]), F.lit(accuracy)).alias(f"q{i}"))
    row = data.agg(*exprs).first()
    proposals: dict[str, set] = {}
    for i, t in enumerate(open_targets):
        proposals.setdefault(t.column, set()).update(row[f"q{i}"] or ())
    return proposals
