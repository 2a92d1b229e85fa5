"""Running totals and dense positions over a total order, without a one-task window.

An un-partitioned window sorts everything in a single task. Here the ordering values are
cut into ranges first: every range is a window partition of its own, and the totals of the
ranges before it come from a table with one row per range. Range limits only steer
balance; any limits give the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_PER_RANGE = 16
ONE_RANGE_ROWS = 4096


def default_ranges(df: DataFrame) -> int:
    """As many ranges as shuffle partitions, within what one expression tree can hold."""
    return min(1024, max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def range_limits(values: DataFrame, column: str, ranges: int) -> list:
    """Ascending cut points for distinct ``column`` values.

    The values with the smallest hashes are a uniform sample of the distinct values, and a
    bounded top-k keeps the collected part small.
    """
    wanted = max(ranges * SAMPLE_PER_RANGE, ONE_RANGE_ROWS)
    sample = (
        values.select(column).filter(F.col(column).isNotNull())
        .orderBy(F.xxhash64(column)).limit(wanted)
    )
    found = sorted(r[0] for r in sample.collect())
    if len(found) < wanted:
        return []
    step = len(found) / ranges
    return sorted({found[int(i * step)] for i in range(1, ranges)})


def range_number(column: Column, limits: list) -> Column:
    """Number of limits that are at or below the value, as a balanced tree of tests."""
    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(column < F.lit(limits[mid]), build(lo, mid)).otherwise(build(mid + 1, hi))
    return build(0, len(limits))


def running_totals(df: DataFrame, order_col: str, totals: dict[str, str], descending: bool = False,
                   ranges: int | None = None) -> DataFrame:
    """Add to ``df`` (one row per distinct ``order_col`` value) inclusive running sums.

    ``totals`` maps an input column to the name of its running sum. Null ordering values
    come first in ascending and last in descending order.
    """
    limits = range_limits(df, order_col, ranges or default_ranges(df))
    order = F.col(order_col).desc() if descending else F.col(order_col).asc()
    number = F.when(F.col(order_col).isNull(), F.lit(-1)).otherwise(
        range_number(F.col(order_col), limits))
    ranged = df.withColumn("_range", -number if descending else number)
    inside = (Window.partitionBy("_range").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range: at most len(limits) + 2 rows, so this window and broadcast are bounded
    per_range = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_sum_{c}") for c in totals])
    offsets = per_range.select(
        "_range", *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_before_{c}")
                    for c in totals])
    joined = ranged.join(F.broadcast(offsets), "_range")
    out = joined.select(
        *df.columns,
        *[(F.sum(c).over(inside) + F.col(f"_before_{c}")).alias(name)
          for c, name in totals.items()])
    return out


def dense_positions(distinct: DataFrame, column: str, name: str) -> DataFrame:
    """Zero-based position of every distinct value in ascending order, nulls first. Other
    columns of ``distinct`` are kept."""
    counted = running_totals(distinct.withColumn("_one", F.lit(1).cast("long")), column,
                             {"_one": "_position"})
    return counted.select(*distinct.columns, (F.col("_position") - 1).alias(name))
