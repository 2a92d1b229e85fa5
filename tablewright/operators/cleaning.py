"""Filling and dropping missing values."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.base import HasInputCols, HasOutputCols, as_str, param, require_columns
from tablewright.functions.missing import drop_missing, is_numeric, no_nan
from tablewright.plans.quantiles import sketch_accuracy

__all__ = ["CleanMissingData", "CleanMissingDataModel", "drop_missing"]

MODES = ("Mean", "Median", "Custom")


class CleanMissingData(HasInputCols, HasOutputCols, Estimator):
    """Learn one replacement per column: mean, approximate median or a given value.

    NaN counts as missing, so it is left out of the learned mean and median.
    """

    cleaningMode = param("cleaningMode", "Mean, Median or Custom", as_str)
    customValue = param("customValue", "replacement in Custom mode", as_str)

    _defaults = {"cleaningMode": "Mean"}

    def setCustomValue(self, value):
        return self._set(customValue=str(value))

    def _fit(self, df: DataFrame) -> "CleanMissingDataModel":
        names, mode = self.getInputCols(), self.getCleaningMode()
        require_columns(df, names)
        if mode not in MODES:
            raise ValueError(f"unknown cleaning mode {mode!r}")
        if mode == "Custom":
            values = [self.getCustomValue()] * len(names)
        else:
            for name in names:
                if not is_numeric(df.schema[name].dataType):
                    raise TypeError("means and medians need numeric columns: use mode Custom for others")
            clean = [no_nan(F.col(f"`{n}`"), df.schema[n].dataType) for n in names]
            if mode == "Mean":
                learned = [F.avg(c) for c in clean]
            else:
                accuracy = sketch_accuracy(len(names))
                learned = [F.percentile_approx(c, F.lit(0.5), F.lit(accuracy)) for c in clean]
            row = df.agg(*[e.cast("double").alias(f"v{i}") for i, e in enumerate(learned)]).first()
            values = list(row)
        return CleanMissingDataModel(inputCols=names, outputCols=self.getOutputCols(),
                                     replacements=values)


class CleanMissingDataModel(HasInputCols, HasOutputCols, Model):
    _state_names = ("replacements",)

    def _transform(self, df: DataFrame) -> DataFrame:
        filled = {}
        for source, target, value in zip(self.getInputCols(), self.getOutputCols(),
                                         self.replacements):
            dtype = df.schema[source].dataType
            filled[target] = F.coalesce(no_nan(F.col(f"`{source}`"), dtype), _literal(value, dtype))
        kept = [F.col(f"`{c}`") if c not in filled else filled[c].alias(c) for c in df.columns]
        return df.select(*kept, *[e.alias(n) for n, e in filled.items() if n not in df.columns])


def _literal(value, dtype: T.DataType):
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(value, str) and is_numeric(dtype):
        return F.lit(float(value)).cast(dtype)
    return F.lit(value).cast(dtype)
