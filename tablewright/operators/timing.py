"""Run time and row counts of a stage."""

from __future__ import annotations

import logging
import time

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame

from tablewright.base import StageBase, as_bool, param
from tablewright.plans.staging import stage_table

log = logging.getLogger("tablewright.timer")


class _TimerParams(StageBase):
    logToScala = param("logToScala", "print the report as well", as_bool)
    disableMaterialization = param(
        "disableMaterialization", "time only the call, without running a job", as_bool)

    _nested_names = ("stage",)
    _defaults = {"logToScala": False, "disableMaterialization": True}

    def setStage(self, stage):
        self.stage = stage
        return self

    def getStage(self):
        return self.stage

    def _report(self, verb: str, seconds: float, rows_in=None, rows_out=None) -> None:
        text = f"{self.stage} took {seconds:.3f}s to {verb}"
        if rows_in is not None:
            text += f", {rows_in} rows in"
        if rows_out is not None:
            text += f", {rows_out} rows out"
        self.lastReport = {"verb": verb, "seconds": seconds, "rows_in": rows_in,
                           "rows_out": rows_out}
        log.info(text)
        if self.getLogToScala():
            print(text)

    def _timed_transform(self, transformer, df: DataFrame) -> DataFrame:
        """The timed job writes the result; the rows are counted outside of the timing."""
        start = time.monotonic()
        if self.getDisableMaterialization() or df.isStreaming:
            out = transformer.transform(df)
            self._report("transform", time.monotonic() - start)
            return out
        staged = stage_table(transformer.transform(df), "timed")
        seconds = time.monotonic() - start
        self._report("transform", seconds, df.count(), staged.count())
        return staged


class Timer(_TimerParams, Estimator):
    """Wraps a transformer or an estimator and reports how long it takes."""

    def _fit(self, df: DataFrame) -> "TimerModel":
        inner = self.stage
        if isinstance(inner, Estimator):
            start = time.monotonic()
            inner = inner.fit(df)
            self._report("fit", time.monotonic() - start)
        return TimerModel(stage=inner, logToScala=self.getLogToScala(),
                          disableMaterialization=self.getDisableMaterialization())

    def fitTransform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def transform(self, df: DataFrame) -> DataFrame:
        if isinstance(self.stage, Estimator):
            return self.fitTransform(df)
        return self._timed_transform(self.stage, df)


class TimerModel(_TimerParams, Model):
    def _transform(self, df: DataFrame) -> DataFrame:
        return self._timed_transform(self.stage, df)
