"""Mean of score columns per key."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.base import (
    StageBase, as_bool, as_str, as_str_list, param, require_columns, unused_name,
)
from tablewright.functions.vectors import elements
from tablewright.plans.lookup import lookup_join
from tablewright.plans.staging import stage_table

# up to this many dimensions every element is an average of its own in one hash aggregate
WIDE_DIMS = 512


def _of_length(values: Column, dims: int) -> Column:
    """The elements of a vector; an error where their number is another one."""
    wrong = F.raise_error(F.concat(F.lit(f"vectors to average need {dims} elements, found "),
                                   F.size(values).cast("string")))
    return F.when(values.isNull() | (F.size(values) == dims), values).otherwise(wrong)


class EnsembleByKey(StageBase, Transformer):
    """Group by keys and average numeric or vector columns.

    ``collapseGroup=False`` joins the result back to every row; same-named columns are
    replaced.
    """

    keys = param("keys", "keys to group by", as_str_list)
    cols = param("cols", "columns to ensemble", as_str_list)
    colNames = param("colNames", "names of the results", as_str_list)
    strategy = param("strategy", "how to ensemble the scores: mean", as_str)
    collapseGroup = param("collapseGroup", "one row per group", as_bool)
    vectorDims = param("vectorDims", "dimensions of vector columns")

    _defaults = {"strategy": "mean", "collapseGroup": True, "vectorDims": {}}

    def setStrategy(self, value: str):
        if value != "mean":
            raise ValueError(f"unknown strategy {value!r}")
        return self._set(strategy=value)

    def _names(self) -> list[str]:
        return self._get("colNames") or [f"{self.getStrategy()}({c})" for c in self.getCols()]

    def _dims(self, df: DataFrame, name: str) -> int:
        known = self.getVectorDims().get(name)
        if known:
            return known
        row = df.select(F.size(elements(f"`{name}`")).alias("n")).filter("n >= 0").first()
        return row["n"] if row else 0

    def _transform(self, df: DataFrame) -> DataFrame:
        keys, cols, names = self.getKeys(), self.getCols(), self._names()
        require_columns(df, keys + cols)
        count = unused_name("_count", df.columns + names)
        narrow, long_vectors = [], []
        for source, target in zip(cols, names):
            dtype = df.schema[source].dataType
            if isinstance(dtype, (T.DoubleType, T.FloatType)):
                narrow.append(F.avg(f"`{source}`").alias(target))
            elif isinstance(dtype, VectorUDT):
                dims = self._dims(df, source)
                if dims > WIDE_DIMS:
                    long_vectors.append((source, target, dims))
                    continue
                values = elements(F.col(f"`{source}`"))
                means = F.array(*[F.avg(values[i]) for i in range(dims)])
                # a group whose vectors are all null has no mean
                present = F.count(_of_length(values, dims)) > 0
                narrow.append(F.when(present, array_to_vector(means)).alias(target))
            else:
                raise TypeError(
                    f"Cannot operate on type {dtype.simpleString()} with strategy mean")
        groups = df.groupBy(*[f"`{k}`" for k in keys]).agg(
            F.count(F.lit(1)).alias(count), *narrow)
        for source, target, dims in long_vectors:
            groups = self._join_long(groups, df, keys, source, target, dims)
        groups = groups.select(*[f"`{k}`" for k in keys], count, *[f"`{n}`" for n in names])
        if self.getCollapseGroup():
            return groups.drop(count)
        replaced = [n for n in names if n in df.columns and n not in keys]
        return lookup_join(df.drop(*replaced), stage_table(groups, "ensemble"), keys, "inner",
                           count_col=count)

    @staticmethod
    def _join_long(groups, df, keys, source, target, dims):
        """Vectors with many dimensions: average per (key, position), then put together."""
        parts = (df.select(*[f"`{k}`" for k in keys],
                           F.posexplode(_of_length(elements(F.col(f"`{source}`")), dims))
                           .alias("_i", "_v"))
                 .groupBy(*keys, "_i").agg(F.avg("_v").alias("_v"))
                 .groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_i", "_v"))).alias("_a"))
                 .select(*keys, array_to_vector(F.transform("_a", lambda s: s["_v"])).alias(target)))
        for k in keys:
            parts = parts.withColumnRenamed(k, f"_k_{k}")
        on = F.lit(True)
        for k in keys:
            on = on & groups[k].eqNullSafe(F.col(f"_k_{k}"))
        return groups.join(parts, on, "left").drop(*[f"_k_{k}" for k in keys])
