"""Column selection, renaming, partitioning and union."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import DataFrame

from tablewright.base import (
    HasInputCol, HasOutputCol, StageBase, as_bool, as_int, as_str_list, param, require_columns,
)


class SelectColumns(StageBase, Transformer):
    """Keep the named columns, in the order of the request."""

    cols = param("cols", "names of the selected columns", as_str_list)

    def _transform(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.getCols())
        return df.select(*[f"`{c}`" for c in self.getCols()])


class DropColumns(StageBase, Transformer):
    """Remove the named columns."""

    cols = param("cols", "names of the dropped columns", as_str_list)

    def _transform(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.getCols())
        return df.drop(*self.getCols())


class RenameColumn(HasInputCol, HasOutputCol, Transformer):
    """Rename one column in place."""

    def _transform(self, df: DataFrame) -> DataFrame:
        require_columns(df, [self.getInputCol()])
        return df.withColumnRenamed(self.getInputCol(), self.getOutputCol())


class Repartition(StageBase, Transformer):
    """Set the number of partitions: merge without a shuffle when shrinking, else shuffle."""

    n = param("n", "number of partitions, above 0", as_int)
    disable = param("disable", "pass the input through", as_bool)

    _defaults = {"disable": False}

    def setN(self, value: int):
        if value <= 0:
            raise ValueError("n must be positive")
        return self._set(n=value)

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.getDisable():
            return df
        if df.isStreaming or self.getN() > df.rdd.getNumPartitions():
            return df.repartition(self.getN())
        return df.coalesce(self.getN())


def union_copies(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs, columns matched by name, duplicates kept."""
    for other in others:
        first = first.unionByName(other)
    return first
