"""Training with automatic featurization, and scoring (H1-H4)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.base import Predictor
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
    OneVsRest, RandomForestClassifier,
)
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.base import (
    HasFeaturesCol, HasLabelCol, as_bool, as_int, param, require_columns,
)
from tablewright.functions.vectors import elements
from tablewright.functions import roles
from tablewright.operators.categorical import LEVEL_TYPES, ValueIndexer, ValueIndexerModel
from tablewright.operators.featurize import DEFAULT_WIDTH, TREE_WIDTH, Featurize
from tablewright.operators.metrics import numbered_label

TREES = (DecisionTreeClassifier, GBTClassifier, RandomForestClassifier, DecisionTreeRegressor,
         GBTRegressor, RandomForestRegressor)

#: Rows that a learner meets in one task, at most. A boosted tree reads about 250 bytes a row of four features.
ROWS_PER_TASK = 1 << 20


def _dealt(data: DataFrame) -> DataFrame:
    """The persisted rows, dealt out evenly where a task has more than ``ROWS_PER_TASK``: large files
    are read in splits of a fixed size, whatever the number of rows in them."""
    rows = data.groupBy(F.spark_partition_id().alias("task")).count()
    most, total = rows.agg(F.max("count"), F.sum("count")).first()
    if (most or 0) <= ROWS_PER_TASK:
        return data
    dealt = data.repartition(max(-(-total // ROWS_PER_TASK), data.sparkSession.sparkContext.defaultParallelism))
    dealt.persist(StorageLevel.MEMORY_AND_DISK).count()
    data.unpersist()
    return dealt


class _Trainer(HasLabelCol, HasFeaturesCol, Estimator):
    numFeatures = param("numFeatures", "width to hash text to; 0 picks by learner", as_int)

    _nested_names = ("model",)

    def __init__(self, **values):
        super().__init__(**values)
        if not self.isDefined("featuresCol"):
            self._setDefault(featuresCol=self.uid + "_features")

    def setModel(self, model):
        self.model = model
        return self

    def getModel(self):
        return self.model

    def copy(self, extra=None):
        that = super().copy(extra)
        # search parameters belong to the learner inside
        that.model = self.model.copy(extra) if self.model is not None else None
        return that

    def _learner(self):
        if not isinstance(self.model, Estimator):
            raise TypeError(f"cannot train with a {type(self.model).__name__}: give a learner of the right kind")
        return self.model.copy()

    def _train(self, df: DataFrame, learner) -> PipelineModel:
        label, features = self.getLabelCol(), self.getFeaturesCol()
        if isinstance(learner, (Predictor, OneVsRest)):
            learner = learner.setParams(labelCol=label, featuresCol=features)
        tree = isinstance(self.model, TREES)
        narrow = tree or isinstance(self.model, MultilayerPerceptronClassifier)
        width = self.getNumFeatures() or (TREE_WIDTH if narrow else DEFAULT_WIDTH)
        featurizer = Featurize(
            featureColumns={features: [c for c in df.columns if c != label]},
            oneHotEncodeCategoricals=not tree, numberOfFeatures=width).fit(df)
        data = featurizer.transform(df).select(label, features).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            data = _dealt(data)
            if isinstance(learner, MultilayerPerceptronClassifier):
                size = data.select(F.size(elements(features)).alias("n")).first()["n"]
                learner = learner.setParams(layers=[size] + list(learner.getLayers())[1:])
            fitted = learner.fit(data)
        finally:
            data.unpersist()
        return PipelineModel(stages=[featurizer, fitted])


class TrainClassifier(_Trainer):
    """Featurize every column but the label, index the label and fit the learner."""

    reindexLabel = param("reindexLabel", "index the label values", as_bool)
    labels = param("labels", "label values in order")

    _defaults = {"numFeatures": 0, "reindexLabel": True}

    def _fit(self, df: DataFrame) -> "TrainedClassifierModel":
        label = self.getLabelCol()
        require_columns(df, [label])
        ready, levels = self._index_label(df, label)
        learner = self._learner()
        many = levels is not None and len(levels) > 2
        if isinstance(learner, LogisticRegression) and many:
            learner = OneVsRest(classifier=learner.setParams(
                labelCol=label, featuresCol=self.getFeaturesCol()))
        elif isinstance(learner, GBTClassifier) and many:
            raise ValueError("boosted trees separate two classes only: take another learner for this label")
        pipeline = self._train(ready, learner)
        return TrainedClassifierModel(labelCol=label, featuresCol=self.getFeaturesCol(),
                                      pipeline=pipeline, levels=levels)

    def _index_label(self, df: DataFrame, label: str) -> tuple[DataFrame, list | None]:
        given = self._get("labels")
        df = df.na.drop(subset=[label])
        if not self.getReindexLabel():
            return df, given
        if roles.is_categorical(df.schema, label):
            if given is not None:
                raise ValueError(f"labels cannot be given: column {label} carries levels of its own")
            return df, roles.get_levels(df.schema, label)
        if given is not None:
            kind = df.schema[label].dataType.simpleString()
            if kind not in LEVEL_TYPES:
                raise TypeError(f"labels of type {kind} cannot be listed")
            convert = {"int": int, "bigint": int, "double": float, "string": str,
                       "boolean": lambda v: str(v).lower() == "true"}[kind]
            levels = [convert(v) for v in given]
            model = ValueIndexerModel(inputCol=label, outputCol=label, levels=sorted(levels),
                                      dataType=kind)
            if levels != sorted(levels):
                return _index_in_order(df, label, levels), levels
        else:
            model = ValueIndexer(inputCol=label, outputCol=label).fit(df)
        indexed = model.transform(df)
        meta = indexed.schema[label].metadata
        # a classifier has numbers for every class on the driver and in every scored row; the list of
        # classes is no longer than these
        listed = model.levels if model.levels is not None else [
            r["level"] for r in model.levelTable.orderBy("position").select("level").collect()]
        # rows whose label is not among the given ones cannot be learned from
        known = len([v for v in listed if v is not None])
        numbered = indexed.filter(F.col(f"`{label}`") < known).withColumn(
            label, F.col(f"`{label}`").cast("double")).withMetadata(label, meta)
        return numbered, [v for v in listed if v is not None]


def _index_in_order(df: DataFrame, label: str, levels: list) -> DataFrame:
    """Label positions in an order other than ascending."""
    kind = df.schema[label].dataType
    numbered, number = numbered_label(df, label, levels)
    indexed = numbered.withColumn(label, number).select(*[F.col(f"`{c}`") for c in df.columns]).na.drop(subset=[label])
    return roles.set_levels(indexed, label, levels, kind)


class TrainedClassifierModel(HasLabelCol, HasFeaturesCol, Model):
    """Adds ``scores``, ``scored_probabilities`` and ``scored_labels``; the label column may
    be absent."""

    _nested_names = ("pipeline",)
    _state_names = ("levels",)

    def getLevels(self):
        return self.levels

    def getParamMap(self) -> dict:
        return self.pipeline.stages[-1].extractParamMap()

    def _transform(self, df: DataFrame) -> DataFrame:
        scored = self.pipeline.transform(df).drop(self.getFeaturesCol())
        model, label, kind = roles.new_model_name(), self.getLabelCol(), roles.CLASSIFICATION
        has_label = label in scored.columns
        if has_label:
            scored = roles.set_role(scored, label, model, roles.LABEL_ROLE, kind)
        for spark_name, name, role in (
                ("rawPrediction", roles.SCORES, roles.SCORES_ROLE),
                ("probability", roles.SCORED_PROBABILITIES, roles.PROBABILITIES_ROLE),
                ("prediction", roles.SCORED_LABELS, roles.SCORED_LABELS_ROLE)):
            if spark_name in scored.columns and spark_name not in df.columns:
                scored = roles.set_role(scored.withColumnRenamed(spark_name, name), name, model,
                                        role, kind)
        if self.levels:
            dtype = _level_dtype(self.levels)
            scored = roles.set_levels(scored, roles.SCORED_LABELS, self.levels, dtype)
            if has_label:
                scored = roles.set_levels(scored, label, self.levels, dtype)
        return scored


def _level_dtype(levels: list) -> T.DataType:
    sample = next((v for v in levels if v is not None), None)
    if isinstance(sample, bool):
        return T.BooleanType()
    if isinstance(sample, int):
        return T.LongType() if any(abs(v) >= 1 << 31 for v in levels if v is not None) \
            else T.IntegerType()
    return T.DoubleType() if isinstance(sample, float) else T.StringType()


class TrainRegressor(_Trainer):
    """Featurize every column but the label and fit the learner."""

    _defaults = {"numFeatures": 0}

    def _fit(self, df: DataFrame) -> "TrainedRegressorModel":
        label = self.getLabelCol()
        require_columns(df, [label])
        dtype = df.schema[label].dataType
        if isinstance(dtype, T.StringType):
            raise TypeError(f"label {label} holds text: a regressor needs numbers, "
                            "convert the column first")
        if not isinstance(dtype, (T.IntegerType, T.BooleanType, T.FloatType, T.ByteType,
                                  T.LongType, T.ShortType, T.DoubleType)):
            raise TypeError(f"label {label} is {dtype.simpleString()}: a regressor needs numbers")
        ready = df.withColumn(label, F.col(f"`{label}`").cast("double")).na.drop(subset=[label])
        pipeline = self._train(ready, self._learner())
        return TrainedRegressorModel(labelCol=label, featuresCol=self.getFeaturesCol(),
                                     pipeline=pipeline)


class TrainedRegressorModel(HasLabelCol, HasFeaturesCol, Model):
    """Adds ``scores``."""

    _nested_names = ("pipeline",)

    def getParamMap(self) -> dict:
        return self.pipeline.stages[-1].extractParamMap()

    def _transform(self, df: DataFrame) -> DataFrame:
        scored = self.pipeline.transform(df).drop(self.getFeaturesCol())
        model, kind = roles.new_model_name(), roles.REGRESSION
        if self.getLabelCol() in scored.columns:
            scored = roles.set_role(scored, self.getLabelCol(), model, roles.LABEL_ROLE, kind)
        return roles.set_role(scored.withColumnRenamed("prediction", roles.SCORES), roles.SCORES,
                              model, roles.SCORES_ROLE, kind)
