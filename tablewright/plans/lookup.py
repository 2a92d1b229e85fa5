"""Joins of a big table with a learned table (weights, levels, group means).

The learned table is broadcast only when its rows were counted and its bytes summed. Beyond
the bounds the join is shuffled, and keys that hold a large share of the big table are split off first:
at most ``1 / HOT_SHARE`` keys can each hold more than ``HOT_SHARE`` of all rows, so that
part is bounded by arithmetic and can be broadcast whatever the data looks like.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
HOT_SHARE = 0.001


def _bytes(value: Column, dtype: T.DataType) -> Column:
    """About how many bytes a value takes, 0 if it is null."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        size = F.octet_length(value) + 16
    elif isinstance(dtype, VectorUDT):
        size = F.size(vector_to_array(value)) * 8 + 32
    elif isinstance(dtype, T.ArrayType):
        size = F.aggregate(value, F.lit(32).cast("long"), lambda n, x: n + _bytes(x, dtype.elementType))
    elif isinstance(dtype, T.MapType):
        size = (_bytes(F.map_keys(value), T.ArrayType(dtype.keyType))
                + _bytes(F.map_values(value), T.ArrayType(dtype.valueType)))
    elif isinstance(dtype, T.StructType):
        size = sum((_bytes(value[f.name], f.dataType) for f in dtype), F.lit(8))
    else:
        size = F.lit(8)
    return F.coalesce(size.cast("long"), F.lit(0).cast("long"))


def table_bytes(table: DataFrame) -> int:
    """About how many bytes the table's values take, summed over all rows."""
    row = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in table.schema), F.lit(0).cast("long"))
    return table.agg(F.sum(row).alias("n")).first()["n"] or 0


def is_small(table: DataFrame, bound: int | None = None) -> bool:
    """Whether the table's rows and bytes stay within the broadcast bounds. Learned tables are
    written tables, so the rows come from the file footers; bytes are read only where columns
    have no fixed width."""
    if table.count() > (BROADCAST_ROWS if bound is None else bound):
        return False
    if all(isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType)) for f in table.schema):
        return True  # the rows bound the bytes
    return table_bytes(table) <= BROADCAST_BYTES


def lookup_join(big: DataFrame, table: DataFrame, keys: list[str], how: str = "inner",
                count_col: str | None = None, small: bool | None = None) -> DataFrame:
    """Join ``table`` (one row per key) to ``big``.

    ``count_col`` names a column of ``table`` with the number of ``big`` rows per key; it
    is used to split off hot keys and is dropped from the result. ``small=None`` checks
    the size of ``table``; False forces the shuffled way.
    """
    if small is None:
        small = is_small(table)
    drop = [count_col] if count_col else []
    if small:
        return big.join(F.broadcast(table.drop(*drop)), keys, how)
    if count_col is None or big.isStreaming:
        return big.join(table.drop(*drop), keys, how)
    total = table.agg(F.sum(count_col).alias("t")).first()["t"] or 0
    hot = table.filter(F.col(count_col) > F.lit(total * HOT_SHARE))
    if table_bytes(hot) > BROADCAST_BYTES:  # keys or values too wide: the adaptive plan splits what is hot
        return big.join(table.drop(*drop).hint("merge"), keys, how)
    hot_keys = F.broadcast(hot.select(*keys).withColumn("_hot", F.lit(True)))
    marked = big.join(hot_keys, keys, "left")
    cold_rows = marked.filter(F.col("_hot").isNull()).drop("_hot")
    hot_part = marked.filter(F.col("_hot")).drop("_hot").join(
        F.broadcast(hot.drop(*drop)), keys, how)
    added = [f for f in table.schema if f.name not in keys + drop]
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(f"`{k}`").isNull()
    cold_part = cold_rows.filter(~no_key).join(table.drop(*drop), keys, how)
    parts = hot_part.unionByName(cold_part)
    if how != "left":
        return parts
    # rows without a key match nothing; shuffled by key they would all meet in one task
    alone = cold_rows.filter(no_key).withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in added})
    return parts.unionByName(alone)
