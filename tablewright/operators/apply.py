"""User functions over columns, one stage over many columns, vector helpers."""

from __future__ import annotations

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.base import (
    HasInputCol, HasInputCols, HasOutputCol, HasOutputCols, StageBase, require_columns,
)
from tablewright.functions.vectors import elements


class UDFTransformer(HasInputCol, HasInputCols, HasOutputCol, Transformer):
    """Apply a function of columns. ``udf`` takes one Column per input and returns a Column:
    a plain expression, a pandas UDF or a UDF all fit."""

    _function_names = ("udf",)

    def setInputCol(self, value: str):
        if self.isSet("inputCols"):
            raise ValueError("set either inputCol or inputCols")
        return self._set(inputCol=value)

    def setInputCols(self, value: list[str]):
        if self.isSet("inputCol"):
            raise ValueError("set either inputCol or inputCols")
        return self._set(inputCols=value)

    def setUDF(self, udf):
        self.udf = udf
        return self

    def getUDF(self):
        return self.udf

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.getInputCols() if self.isSet("inputCols") else [self.getInputCol()]
        require_columns(df, names)
        return df.withColumn(self.getOutputCol(), self.udf(*[F.col(f"`{n}`") for n in names]))


class MultiColumnAdapter(HasInputCols, HasOutputCols, Estimator):
    """Fit and apply one single-column stage to many columns.

    Spark stages that know ``inputCols`` are fitted once over all columns; others become a
    pipeline of copies.
    """

    _nested_names = ("baseStage",)

    def setBaseStage(self, value):
        if not (value.hasParam("inputCol") and value.hasParam("outputCol")):
            raise ValueError("baseStage must have the params inputCol and outputCol")
        self.baseStage = value
        return self

    def getBaseStage(self):
        return self.baseStage

    def stages(self) -> list:
        base = self.baseStage
        names = list(zip(self.getInputCols(), self.getOutputCols()))
        if base.hasParam("inputCols") and base.hasParam("outputCols"):
            one = base.copy()
            for single in ("inputCol", "outputCol"):
                one.clear(one.getParam(single))
            return [one._set(inputCols=self.getInputCols(), outputCols=self.getOutputCols())]
        out = []
        for source, target in names:
            stage = base.copy()
            stage._set(inputCol=source, outputCol=target)
            out.append(stage)
        return out

    def _fit(self, df: DataFrame) -> PipelineModel:
        require_columns(df, self.getInputCols())
        present = [c for c in self.getOutputCols() if c in df.columns]
        if present:
            raise ValueError(f"outputCols name columns of the table: {', '.join(present)}")
        return Pipeline(stages=self.stages()).fit(df)


class ColumnFunction(StageBase, Transformer):
    """A whole-table function as a stage, for use inside a Pipeline."""

    _function_names = ("function",)

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.function(df)


def get_value_at(vector: Column | str, index: int) -> Column:
    """Element of a vector column."""
    return elements(vector)[index]


def to_vector(array: Column | str) -> Column:
    """Vector from an array column."""
    return array_to_vector(array)
