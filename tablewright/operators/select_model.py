"""Choosing among fitted models and searching hyper-parameters."""

from __future__ import annotations

import random
from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    ClassificationModel, Classifier, DecisionTreeClassifier, GBTClassifier, LogisticRegression,
    MultilayerPerceptronClassifier, NaiveBayes, OneVsRest, OneVsRestModel, RandomForestClassifier,
)
from pyspark.ml.regression import RegressionModel, Regressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.base import StageBase, as_int, as_str, param, unused_name
from tablewright.functions import roles
from tablewright.operators.metrics import (
    ALL, ALL_CLASSIFICATION, ALL_REGRESSION, CLASSIFICATION_COLUMNS, REGRESSION_COLUMNS,
    ComputeModelStatistics, higher_is_better,
)
from tablewright.operators.sampling import fold_column
from tablewright.operators.train import (
    TrainClassifier, TrainedClassifierModel, TrainedRegressorModel, TrainRegressor,
)


def model_kind(model) -> str:
    if isinstance(model, (BestModel, TuneHyperparametersModel)):
        return model_kind(model.model)
    if isinstance(model, (TrainClassifier, TrainedClassifierModel, Classifier, ClassificationModel,
                          OneVsRest, OneVsRestModel)):
        return roles.CLASSIFICATION
    if isinstance(model, (TrainRegressor, TrainedRegressorModel, Regressor, RegressionModel)):
        return roles.REGRESSION
    raise TypeError("the model is neither a trained classifier nor a trained regressor")


def metric_column(kind: str, metric: str) -> str:
    names = REGRESSION_COLUMNS if kind == roles.REGRESSION else CLASSIFICATION_COLUMNS
    if metric not in names:
        raise ValueError(f"{metric} does not rank models of kind {kind}")
    return names[metric]


def params_text(model) -> str:
    """``name: value`` pairs of the learner, sorted."""
    if isinstance(model, (BestModel, TuneHyperparametersModel)):
        return params_text(model.model)
    pairs = (model.getParamMap() if hasattr(model, "getParamMap") else model.extractParamMap())
    return ", ".join(sorted(f"{p.name}: {v}" for p, v in pairs.items()))


def evaluator_for(model, metric: str) -> ComputeModelStatistics:
    """Evaluator of what ``model`` puts out."""
    out = ComputeModelStatistics(evaluationMetric=metric)
    if isinstance(model, (ClassificationModel, OneVsRestModel)):
        out.setParams(labelCol=model.getLabelCol(), scoredLabelsCol=model.getPredictionCol(),
                      scoresCol=model.getRawPredictionCol())
        if metric == ALL:
            out.setEvaluationMetric(ALL_CLASSIFICATION)
    elif isinstance(model, RegressionModel):
        out.setParams(labelCol=model.getLabelCol(), scoredLabelsCol=model.getPredictionCol())
        if metric == ALL:
            out.setEvaluationMetric(ALL_REGRESSION)
    return out


class _Evaluated(StageBase):
    evaluationMetric = param("evaluationMetric", "metric to compare models with", as_str)
    _defaults = {"evaluationMetric": "accuracy"}

    def setEvaluationMetric(self, value: str):
        if value not in REGRESSION_COLUMNS and value not in CLASSIFICATION_COLUMNS:
            raise ValueError(f"unknown metric {value!r}")
        return self._set(evaluationMetric=value)


class FindBestModel(_Evaluated, Estimator):
    """Score a table with every model of a list and keep the best one."""

    _nested_names = ("models",)

    def setModels(self, models: list):
        self.models = list(models)
        return self

    def getModels(self) -> list:
        return self.models

    def _fit(self, df: DataFrame) -> "BestModel":
        if not self.models:
            raise ValueError("give at least one trained model")
        metric = self.getEvaluationMetric()
        kind = model_kind(self.models[0])
        for m in self.models:
            if model_kind(m) != kind:
                raise ValueError("all models must be of one kind: "
                                 "classifiers or regressors")
        name = metric_column(kind, metric)
        data = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows, whole = [], {}
            for i, m in enumerate(self.models):
                value = None
                if name == CLASSIFICATION_COLUMNS["AUC"]:
                    # all metrics take the same passes as this one, and the best model's are asked for below
                    evaluator = evaluator_for(m, ALL)
                    table = evaluator.transform(m.transform(data))
                    if name in table.columns:
                        whole[i], value = (evaluator, table), table.first()[name]
                if value is None:
                    value = evaluator_for(m, metric).transform(m.transform(data)).first()[name]
                rows.append((m.uid, float(value), params_text(m)))
            at = _best([r[1] for r in rows], metric)
            best = self.models[at]
            scored = best.transform(df)
            if at in whole:
                final, metrics = whole[at]
            else:
                final = evaluator_for(best, ALL)
                metrics = final.transform(scored)
        finally:
            data.unpersist()
        table = df.sparkSession.createDataFrame(
            rows, "model_name string, metric double, parameters string")
        return BestModel(model=best, scoredDataset=scored, rocCurve=final.rocCurve,
                         bestModelMetrics=metrics, allModelMetrics=table)


def _best(values: list[float], metric: str) -> int:
    """First position of the best value; NaN never wins over a number."""
    order = max if higher_is_better(metric) else min
    numbers = [v for v in values if v == v]
    return values.index(order(numbers)) if numbers else 0


class BestModel(StageBase, Model):
    _nested_names = ("model", "scoredDataset", "rocCurve", "bestModelMetrics", "allModelMetrics")

    def getBestModel(self):
        return self.model

    def getScoredDataset(self) -> DataFrame:
        return self.scoredDataset

    def getEvaluationResults(self) -> DataFrame:
        return self.rocCurve

    def getBestModelMetrics(self) -> DataFrame:
        return self.bestModelMetrics

    def getAllModelMetrics(self) -> DataFrame:
        return self.allModelMetrics

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


# ---- hyper-parameter spaces ----

class RangeHyperParam:
    def __init__(self, min, max, seed: int = 0):
        self.min, self.max, self.random = min, max, random.Random(seed)


class IntRangeHyperParam(RangeHyperParam):
    def getNext(self) -> int:
        return self.random.randrange(self.min, self.max)


class LongRangeHyperParam(IntRangeHyperParam):
    pass


class DoubleRangeHyperParam(RangeHyperParam):
    def getNext(self) -> float:
        return self.min + self.random.random() * (self.max - self.min)


class FloatRangeHyperParam(DoubleRangeHyperParam):
    pass


class DiscreteHyperParam:
    def __init__(self, values: list, seed: int = 0):
        self.values, self.random = list(values), random.Random(seed)

    def getNext(self):
        return self.random.choice(self.values)


class HyperparamBuilder:
    """Collects (param, distribution) pairs."""

    def __init__(self):
        self.space: dict = {}

    def addHyperparam(self, param, values) -> "HyperparamBuilder":
        self.space[param] = values
        return self

    def build(self) -> list[tuple]:
        return list(self.space.items())


class GridSpace:
    """Parameter maps in the order given, as a grid builder makes them."""

    def __init__(self, paramValues: list[dict]):
        self.paramValues = list(paramValues)

    def paramMaps(self) -> Iterator[dict]:
        return iter(self.paramValues)


class RandomSpace:
    """Endless parameter maps, every value drawn from its distribution."""

    def __init__(self, paramDistributions: list[tuple]):
        self.paramDistributions = list(paramDistributions)

    def paramMaps(self) -> Iterator[dict]:
        while True:
            yield {p: d.getNext() for p, d in self.paramDistributions}


def default_range(learner) -> list[tuple]:
    """Default search ranges of the known classifiers."""
    # fixed values: ranges per learner
    trees = [("maxBins", IntRangeHyperParam(16, 32)), ("maxDepth", IntRangeHyperParam(2, 5)),
             ("minInfoGain", DoubleRangeHyperParam(0.0, 0.5)),
             ("minInstancesPerNode", IntRangeHyperParam(1, 8))]
    share = ("subsamplingRate", DoubleRangeHyperParam(0.01, 1.0))
    ranges = {
        LogisticRegression: [("regParam", DoubleRangeHyperParam(0.001, 1.0)),
                             ("elasticNetParam", DoubleRangeHyperParam(0.001, 1.0)),
                             ("maxIter", IntRangeHyperParam(5, 10))],
        DecisionTreeClassifier: trees,
        GBTClassifier: trees + [("maxIter", IntRangeHyperParam(10, 20)),
                                ("stepSize", DoubleRangeHyperParam(0.01, 1.0)), share],
        RandomForestClassifier: trees + [("numTrees", IntRangeHyperParam(10, 30)), share],
        MultilayerPerceptronClassifier: [
            ("blockSize", IntRangeHyperParam(10, 200)), ("maxIter", IntRangeHyperParam(1, 5)),
            ("tol", DoubleRangeHyperParam(1e-6, 1e-3)), ("layers", DiscreteHyperParam([[2, 5, 2]]))],
        NaiveBayes: [("smoothing", DoubleRangeHyperParam(0.0, 1.0))],
    }
    for kind, found in ranges.items():
        if isinstance(learner, kind):
            return [(learner.getParam(name), d) for name, d in found]
    raise TypeError(f"no default ranges for {type(learner).__name__}")


class TuneHyperparameters(_Evaluated, Estimator):
    """Cross-validated search: run ``numRuns`` parameter maps over the models in turn, take
    the mean metric over the folds and fit the best on all rows."""

    numFolds = param("numFolds", "number of folds", as_int)
    seed = param("seed", "random number generator seed", as_int)
    numRuns = param("numRuns", "number of parameter maps to try", as_int)
    parallelism = param("parallelism", "number of models to run in parallel", as_int)

    _nested_names = ("models",)
    _function_names = ("paramSpace",)
    _defaults = {"seed": 0, "numFolds": 3, "numRuns": 1, "parallelism": 1}

    def setModels(self, models: list):
        self.models = list(models)
        return self

    def getModels(self) -> list:
        return self.models

    def setParamSpace(self, space):
        self.paramSpace = space
        return self

    def getParamSpace(self):
        return self.paramSpace

    def _fit(self, df: DataFrame) -> "TuneHyperparametersModel":
        metric, folds = self.getEvaluationMetric(), self.getNumFolds()
        name = metric_column(model_kind(self.models[0]), metric)
        space = self.paramSpace.paramMaps()
        tries = [next(space) for _ in range(self.getNumRuns())]
        fold = unused_name("_fold", df.columns)
        folded = fold_column(df, folds, self.getSeed(), None, fold)
        sums = [0.0] * len(tries)
        pool = ThreadPool(max(1, min(self.getParallelism(), len(tries))))
        try:
            for k in range(folds):
                training = folded.filter(F.col(fold) != k).drop(fold).persist(
                    StorageLevel.MEMORY_AND_DISK)
                validation = folded.filter(F.col(fold) == k).drop(fold).persist(
                    StorageLevel.MEMORY_AND_DISK)

                @inheritable_thread_target(df.sparkSession)
                def run(i: int) -> float:
                    model = self.models[i % len(self.models)].fit(training, tries[i])
                    table = evaluator_for(model, metric).transform(model.transform(validation))
                    return float(table.first()[name])
                try:
                    for i, value in enumerate(pool.map(run, range(len(tries)), chunksize=1)):
                        sums[i] += value
                finally:
                    training.unpersist()
                    validation.unpersist()
        finally:
            pool.close()
        means = [s / folds for s in sums]
        best = _best(means, metric)
        model = self.models[best % len(self.models)].fit(df, tries[best])
        return TuneHyperparametersModel(model=model, bestMetric=means[best], metrics=means)


class TuneHyperparametersModel(StageBase, Model):
    _nested_names = ("model",)
    _state_names = ("bestMetric", "metrics")

    def getBestModel(self):
        return self.model

    def getBestMetric(self) -> float:
        return self.bestMetric

    def getBestModelInfo(self) -> str:
        return params_text(self.model)

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)
