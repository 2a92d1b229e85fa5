"""One rule for missing values: null in any type, NaN in floating types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)
FLOATING = (T.FloatType, T.DoubleType)
TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC)


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, FLOATING)


def is_missing(column: Column, dtype: T.DataType) -> Column:
    return (column.isNull() | F.isnan(column)) if is_floating(dtype) else column.isNull()


def no_nan(column: Column, dtype: T.DataType) -> Column:
    """The column with NaN turned into null."""
    return F.when(~F.isnan(column), column) if is_floating(dtype) else column


def drop_missing(df: DataFrame, columns) -> DataFrame:
    """Keep the rows in which none of the columns is missing (null or NaN)."""
    keep = F.lit(True)
    for name in columns:
        keep = keep & ~is_missing(F.col(f"`{name}`"), df.schema[name].dataType)
    return df.filter(keep)
