"""What the registered queries share: loading, text forms of arrays, images from vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.functions.images import pixel_image
from tablewright.sources.tables import load_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where one exists, the SQL that gives the same rows."""
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_table(spark, sf_dir, name)


def joined(array: Column) -> Column:
    """Whole numbers of an array as one text."""
    return F.array_join(F.transform(array, lambda v: v.cast("long").cast("string")), ",")


# ---- images: an 8 x 8 picture per embedding, one pixel per element ----

SIDE, CHANNELS = 8, 3


def pixel_values(embedding: Column) -> Column:
    level = F.transform(embedding, lambda x: F.pmod(
        F.floor(x.cast("double") * 1000), F.lit(256)).cast("int"))
    return F.flatten(F.transform(level, lambda v: F.array(v, 255 - v, (v * 7) % 256)))


def embedding_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, label, image) in pixel form."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label", pixel_image(
        F.lit(SIDE), F.lit(SIDE), F.lit(CHANNELS), pixel_values(F.col("embedding"))).alias("image"))


IMAGES_SQL = """
img AS (
  SELECT vec_id, label, flatten([[v, 255 - v, (v * 7) % 256] for v in vs]) AS px
  FROM (SELECT vec_id, label,
               [((CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT) % 256) + 256) % 256
                for x in embedding] AS vs
        FROM embeddings))
"""


def image_sql(value: str, count: int, extra: str = "") -> str:
    """SQL for one picture per row: ``value`` is the output number at position ``i``."""
    return f"""WITH {IMAGES_SQL}
SELECT vec_id, array_to_string([{value} for i in range({count})], ',') AS pixels{extra} FROM img"""
