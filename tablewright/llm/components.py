"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import staged

MOST_ROUNDS = 60
#: Links that one task writes at least.
TASK_LINKS = 200_000


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Hang a node's larger (or smaller) neighbours onto its smallest one. The minimum is a
    partial aggregation; it joins back by node, which the adaptive plan splits where hot."""
    if large:
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        return (around.filter("b > a").join(least, "a")
                .select(F.col("m").alias("a"), "b").filter("a != b"))
    down = links.select(F.greatest("a", "b").alias("b"), F.least("a", "b").alias("a"))
    least = down.groupBy("b").agg(F.min("a").alias("m"))
    hung = down.join(least, "b").select(F.col("m").alias("_m"), F.col("a").alias("_n"))
    return (hung.filter("_m != _n").select(F.col("_m").alias("a"), F.col("_n").alias("b"))
            .unionByName(least.select(F.col("m").alias("a"), "b")))


def _written(links: DataFrame, size: int | None) -> tuple[DataFrame, tuple[int, object]]:
    """The written links with their number and a sum of their hashes. About ``size`` links are
    expected; a small table is written by few tasks.

    The sum is read from the written table. ``Observation`` would save that pass, but after its first
    use a session cannot be serialized any more, and the summary of a two-class model holds its session:
    no such model could score in that session then.
    """
    if size is not None:
        links = links.coalesce(1 + size // TASK_LINKS)
    table = staged(links, "links")
    seen = table.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return table, (seen["n"], seen["s"])


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest reachable node of every node of ``links`` (a, b: long)."""
    now, mark = _written(links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                         .distinct(), None)
    for _ in range(MOST_ROUNDS):
        if not mark[0]:
            break
        before = mark
        now, mark = _written(_stars(_stars(now, True).distinct(), False).distinct(), mark[0])
        if mark == before:
            break
    else:
        raise RuntimeError("the components did not settle")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
