"""Head, random and keyed samples, partition numbers, splits and folds."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewright.base import StageBase, as_float, as_int, as_str, param, unused_name
from tablewright.plans.staging import stage_table

HEAD_LIMIT = 2_000_000_000
ONE_TASK_ROWS = 1_000_000
_GRAIN = 1 << 30


def head(df: DataFrame, count: int) -> DataFrame:
    """The first ``count`` rows in partition order.

    Spark's limit moves its rows through one task, which is fine for small counts. Above
    that the row count of each partition tells which partitions are taken whole and how
    many rows come from the one where the count is reached; no row is moved.
    """
    if count > HEAD_LIMIT:
        raise ValueError(f"head returns at most {HEAD_LIMIT} rows")
    if count <= ONE_TASK_ROWS:
        return df.limit(count)
    part, row = unused_name("_part", df.columns), unused_name("_row", df.columns)
    numbered = df.withColumn(part, F.spark_partition_id()).withColumn(
        row, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    return _cut(numbered, part, row, count)


def _cut(numbered: DataFrame, part: str, row: str, count: int) -> DataFrame:
    """The first ``count`` rows by (part, row); all rows when there are fewer."""
    sizes = numbered.groupBy(part).count()
    # one row per partition
    reached = sizes.withColumn("seen", F.sum("count").over(
        Window.orderBy(part).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = reached.filter(F.col("seen") >= count).orderBy(part).first()
    if last is None:
        return numbered.drop(part, row)
    rest = count - (last["seen"] - last["count"])
    return numbered.filter(
        (F.col(part) < last[part]) | ((F.col(part) == last[part]) & (F.col(row) < rest))
    ).drop(part, row)


def unit_hash(keys: list[str], seed: int) -> Column:
    """A number in [0, 1) that depends on the key values and the seed only."""
    h = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.lit(seed)), F.lit(_GRAIN))
    return h.cast("double") / F.lit(float(_GRAIN))


def hash_sample(df: DataFrame, keys: list[str], fraction: float, seed: int = 0) -> DataFrame:
    """Rows whose key hash falls below the fraction: the same rows on every run and layout."""
    return df.filter(unit_hash(keys, seed) < F.lit(fraction))


def exact_sample(df: DataFrame, keys: list[str], count: int, seed: int = 0) -> DataFrame:
    """Exactly ``count`` rows (or all): the ones with the smallest key hashes.

    Small counts are a bounded top-k. Larger ones keep the rows whose hash can be among the
    smallest, order and write only those, and cut where the count is reached.
    """
    columns = [F.col(f"`{k}`") for k in keys]
    order = [F.xxhash64(*columns, F.lit(seed)), *columns]
    if count <= ONE_TASK_ROWS:
        return df.orderBy(*order).limit(count)
    total = df.count()
    if count >= total:
        return df
    hashed = unused_name("_hash", df.columns)
    part, row = unused_name("_part", df.columns), unused_name("_row", df.columns)
    # share of the hash range that holds the wanted rows, with room for chance
    share = min(1.0, 1.05 * count / total + 0.001)
    with_hash = df.withColumn(hashed, order[0])
    while True:
        limit = int(-(1 << 63) + share * (1 << 64)) if share < 1.0 else (1 << 63) - 1
        near = with_hash.filter(F.col(hashed) <= F.lit(min(limit, (1 << 63) - 1)))
        if share >= 1.0 or near.count() >= count:
            break
        share = min(1.0, share * 2)
    numbered = near.orderBy(hashed, *columns).withColumn(part, F.spark_partition_id()).withColumn(
        row, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    return _cut(stage_table(numbered, "sample"), part, row, count).drop(hashed)


class PartitionSample(StageBase, Transformer):
    """Head rows, a random sample, or a random partition number per row."""

    mode = param("mode", "AssignToPartition, RandomSample, or Head", as_str)
    rsMode = param("rsMode", "Absolute or Percentage", as_str)
    seed = param("seed", "seed for random operations", as_int)
    percent = param("percent", "share of rows to return", as_float)
    count = param("count", "number of rows to return", as_int)
    newColName = param("newColName", "name of the partition column", as_str)
    numParts = param("numParts", "number of partitions", as_int)

    _defaults = {"mode": "RandomSample", "rsMode": "Percentage", "seed": -1, "percent": 0.01,
                 "count": 1000, "newColName": "Partition", "numParts": 10}

    def _transform(self, df: DataFrame) -> DataFrame:
        mode = self.getMode()
        if mode == "Head":
            return head(df, self.getCount())
        if mode == "AssignToPartition":
            number = F.floor(F.rand(self.getSeed()) * self.getNumParts()).cast("int")
            return df.withColumn(self.getNewColName(), number)
        if mode != "RandomSample":
            raise ValueError(f"unknown mode {mode!r}")
        if self.getRsMode() == "Percentage":
            fraction = self.getPercent()
        elif self.getRsMode() == "Absolute":
            total = df.count()
            fraction = min(1.0, self.getCount() / total) if total else 0.0
        else:
            raise ValueError(f"unknown random sample mode {self.getRsMode()!r}")
        return df.sample(False, fraction, self.getSeed())


def assign_partition(df: DataFrame, keys: list[str], parts: int, name: str = "Partition",
                     seed: int = 0) -> DataFrame:
    """Partition number in [0, parts) from the key hash."""
    return df.withColumn(name, F.pmod(
        F.xxhash64(*[F.col(f"`{k}`") for k in keys], F.lit(seed)), F.lit(parts)).cast("int"))


def random_split(df: DataFrame, weights: list[float], seed: int | None = None) -> list[DataFrame]:
    return df.randomSplit(weights, seed)


def hash_split(df: DataFrame, keys: list[str], weights: list[float],
               seed: int = 0) -> list[DataFrame]:
    """Disjoint parts that cover the input; a row's part depends on its key only."""
    total, low, parts = float(sum(weights)), 0.0, []
    u = unit_hash(keys, seed)
    for i, w in enumerate(weights):
        high = 1.0 if i == len(weights) - 1 else low + w / total
        parts.append(df.filter((u >= F.lit(low)) & (u < F.lit(high))))
        low = high
    return parts


def fold_column(df: DataFrame, num_folds: int, seed: int = 0, keys: list[str] | None = None,
                name: str = "_fold") -> DataFrame:
    """Fold number per row. With keys the fold follows from the key; without, rows are dealt
    at random and the result is written down, so that copies of a row spread over the folds
    and a lost executor cannot deal them again."""
    if keys:
        return assign_partition(df, keys, num_folds, name, seed)
    dealt = df.withColumn(name, F.floor(F.rand(seed) * num_folds).cast("int"))
    return stage_table(dealt, "folds")


def k_fold(df: DataFrame, num_folds: int, seed: int = 0, keys: list[str] | None = None
           ) -> list[tuple[DataFrame, DataFrame]]:
    """(training, validation) pair per fold."""
    if num_folds < 2:
        raise ValueError("at least two folds are needed")
    name = unused_name("_fold", df.columns)
    folded = fold_column(df, num_folds, seed, keys, name)
    return [(folded.filter(F.col(name) != i).drop(name), folded.filter(F.col(name) == i).drop(name))
            for i in range(num_folds)]
