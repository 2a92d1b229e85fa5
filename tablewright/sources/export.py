"""Labelled-vector exports for trainers outside Spark."""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.base import require_columns
from tablewright.functions.vectors import elements

DENSE, SPARSE = "dense", "sparse"


def _values(df: DataFrame, name: str) -> Column:
    """Array of doubles from a vector, an array or a number column."""
    dtype, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(dtype, VectorUDT):
        return elements(column)
    if isinstance(dtype, T.ArrayType):
        return column.cast("array<double>")
    return F.array(column.cast("double"))


def _check_form(form: str) -> None:
    if form not in (DENSE, SPARSE):
        raise ValueError(f"Unknown vector form {form}")


def _text(values: Column, form: str) -> Column:
    """``v v v`` or ``i:v i:v`` (all non-zero positions)."""
    if form == DENSE:
        return F.array_join(F.transform(values, lambda v: v.cast("string")), " ")
    return F.array_join(
        F.transform(_non_zero(values), lambda s: F.concat_ws(":", s["i"], s["v"])), " ")


def _non_zero(values: Column) -> Column:
    numbered = F.transform(values, lambda v, i: F.struct(i.alias("i"), v.alias("v")))
    return F.filter(numbered, lambda s: s["v"] != 0)


def to_vector_text(df: DataFrame, label: str, feats: str, labelForm: str = DENSE,
                   featureForm: str = DENSE) -> DataFrame:
    """One line ``|label ... |features ...`` per row in column ``value``."""
    require_columns(df, [label, feats])
    _check_form(labelForm)
    _check_form(featureForm)
    return df.select(F.concat(
        F.lit(f"|{label} "), _text(_values(df, label), labelForm),
        F.lit(f" |{feats} "), _text(_values(df, feats), featureForm)).alias("value"))


def to_vector_columns(df: DataFrame, label: str, feats: str, labelForm: str = DENSE,
                      featureForm: str = DENSE, precision: str = "float") -> DataFrame:
    """Features first, then the label: one array for the dense form, and
    ``name_size, name_indices, name_values`` for the sparse form."""
    require_columns(df, [label, feats])
    if precision not in ("float", "double"):
        raise ValueError(f"unknown precision {precision!r}")
    columns = []
    for name, form in ((feats, featureForm), (label, labelForm)):
        _check_form(form)
        values = _values(df, name)
        if form == DENSE:
            columns.append(values.cast(f"array<{precision}>").alias(name))
            continue
        kept = _non_zero(values)
        columns += [
            F.size(kept).alias(f"{name}_size"),
            F.transform(kept, lambda s: s["i"]).cast("array<int>").alias(f"{name}_indices"),
            F.transform(kept, lambda s: s["v"]).cast(f"array<{precision}>").alias(f"{name}_values")]
    return df.select(*columns)


def export(df: DataFrame, path: str, format: str = "text", partitions: int = 1) -> None:
    """Write text or parquet in at most ``partitions`` files. Pick the number with the size
    of the table in mind: one task writes one file."""
    if format not in ("text", "parquet"):
        raise ValueError(f"unknown format {format!r}")
    writer = df.coalesce(partitions).write.mode("overwrite")
    writer.text(path) if format == "text" else writer.parquet(path)
