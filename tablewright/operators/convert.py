"""Column type conversion."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.base import StageBase, as_str, param, require_columns
from tablewright.functions.missing import TIMESTAMPS, is_floating

TARGETS = {
    "boolean": T.BooleanType(), "byte": T.ByteType(), "short": T.ShortType(),
    "integer": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "string": T.StringType(),
}
INTEGER_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}
LONG_MAX = (1 << 63) - 1


class DataConversion(StageBase, Transformer):
    """Convert a comma-separated list of columns to one type.

    Text that is no number becomes null, fractions are cut off, and integers that do not
    fit wrap around.
    """

    col = param("col", "comma separated list of columns", as_str)
    convertTo = param("convertTo", "the result type", as_str)
    dateTimeFormat = param("dateTimeFormat", "pattern of time texts", as_str)

    _defaults = {"col": "", "convertTo": "", "dateTimeFormat": "yyyy-MM-dd HH:mm:ss"}

    def _transform(self, df: DataFrame) -> DataFrame:
        names = [c.strip() for c in self.getCol().split(",")]
        require_columns(df, names)
        target = self.getConvertTo()
        if target == "toCategorical":
            from tablewright.operators.categorical import ValueIndexer
            for name in names:
                df = ValueIndexer(inputCol=name, outputCol=name).fit(df).transform(df)
            return df
        if target == "clearCategorical":
            from tablewright.operators.categorical import IndexToValue
            for name in names:
                df = IndexToValue(inputCol=name, outputCol=name).transform(df)
            return df
        return df.select(*[
            self._convert(df.schema[c], target).alias(c) if c in names else F.col(f"`{c}`")
            for c in df.columns])

    def _convert(self, field: T.StructField, target: str) -> Column:
        column, dtype = F.col(f"`{field.name}`"), field.dataType
        if target == "date":
            return to_time(column, dtype, self.getDateTimeFormat())
        if target not in TARGETS:
            raise ValueError(f"unknown conversion target {target!r}")
        if isinstance(dtype, TIMESTAMPS):
            return from_time(column, target, self.getDateTimeFormat())
        return cast_column(column, dtype, target)


def cast_column(column: Column, dtype: T.DataType, target: str) -> Column:
    to = TARGETS[target]
    bits = INTEGER_BITS.get(to.simpleString())
    if isinstance(dtype, T.StringType):
        if target == "boolean":
            raise TypeError("text has no defined boolean value: compare it instead")
        if target == "string":
            return column
        number = column.try_cast("double")
        return number.cast(to) if bits is None else wrap_integer(_whole_number(number, bits), bits)
    if bits is None:
        return column.cast(to)
    if isinstance(dtype, T.BooleanType):
        return column.cast(to)
    if is_floating(dtype) or isinstance(dtype, T.DecimalType):
        number = column.cast("double")
        return wrap_integer(_whole_number(number, bits), bits)
    return wrap_integer(column.cast("long"), bits)


def wrap_integer(value: Column, bits: int) -> Column:
    """Keep the low ``bits`` of a long, as two's complement."""
    if bits == 64:
        return value
    unused = 64 - bits
    kept = F.shiftright(F.shiftleft(value, unused), unused)
    return kept.cast({8: "tinyint", 16: "smallint", 32: "int"}[bits])


def _whole_number(number: Column, bits: int) -> Column:
    """Double to long without its fraction. NaN gives 0; values beyond the int range (long
    range for a long target) stop at its ends before any wrapping."""
    if bits == 64:
        edge = float(1 << 63)
        return (F.when(F.isnan(number), F.lit(0).cast("long"))
                .when(number >= F.lit(edge), F.lit(LONG_MAX))
                .when(number <= F.lit(-edge), F.lit(-LONG_MAX) - F.lit(1))
                .otherwise(number.try_cast("long")))
    clipped = F.greatest(F.lit(-float(1 << 31)), F.least(F.lit(float((1 << 31) - 1)), number))
    return (F.when(number.isNull(), F.lit(None).cast("long"))
            .when(F.isnan(number), F.lit(0).cast("long"))
            .otherwise(clipped.try_cast("long")))


def from_time(column: Column, target: str, pattern: str) -> Column:
    moment = column.cast("timestamp")
    if target == "long":
        return F.unix_millis(moment)
    if target == "string":
        return F.date_format(moment, pattern)
    raise TypeError("a time becomes text or a count of milliseconds (string, long), nothing else")


def to_time(column: Column, dtype: T.DataType, pattern: str) -> Column:
    if isinstance(dtype, T.StringType):
        return F.to_timestamp(column, pattern)
    if isinstance(dtype, T.LongType):
        return F.timestamp_millis(column)
    raise TypeError("times are made from text or counts of milliseconds (string, long)")

