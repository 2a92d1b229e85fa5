"""Training, scoring, metrics and model selection."""

import math
from collections import Counter

import pytest
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
    NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from tablewright.functions import roles
from tablewright.operators.categorical import ValueIndexer
from tablewright.operators.instance import ComputePerInstanceStatistics
from tablewright.operators.metrics import (
    ComputeModelStatistics, ConfusionMatrix, area_under_roc, regression_metrics, roc_curve, roc_points,
)
from tablewright.operators.select_model import (
    BestModel, DiscreteHyperParam, DoubleRangeHyperParam, FindBestModel, GridSpace, HyperparamBuilder,
    IntRangeHyperParam, RandomSpace, TuneHyperparameters, default_range,
)
from tablewright.operators.train import (
    TrainClassifier, TrainedClassifierModel, TrainedRegressorModel, TrainRegressor,
)

# twelve days of weather: it rains when the air is damp
ROWS = [(1, 88, 9.5, 2.25, 11), (1, 92, 7.0, 1.5, 3), (0, 41, 15.5, 3.75, 6), (0, 35, 21.25, 0.5, 7),
        (1, 84, 12.0, 4.0, 9), (0, 52, 18.5, 2.0, 5), (0, 47, 24.0, 1.25, 8), (1, 95, 5.75, 3.0, 12),
        (0, 38, 19.75, 2.75, 6), (1, 81, 10.25, 0.75, 10), (0, 44, 16.0, 1.0, 4), (1, 90, 8.5, 2.5, 2)]


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame(ROWS, "rain int, damp int, warmth double, wind double, month int").cache()


@pytest.fixture(scope="module")
def flowers(spark):
    rows = [(("rose", "tulip", "daisy")[i % 3], float(i % 3) + (i % 5) * 0.1, float(i)) for i in range(60)]
    return spark.createDataFrame(rows, "kind string, size double, n double").cache()


def metric(scored, name="accuracy"):
    return ComputeModelStatistics(evaluationMetric=name).transform(scored).first()[name]


# made inside the test: learners need a running session
LEARNERS = {
    "logistic": lambda: LogisticRegression(maxIter=5),
    "tree": lambda: DecisionTreeClassifier(),
    "forest": lambda: RandomForestClassifier(numTrees=3, seed=1),
    "boosted": lambda: GBTClassifier(maxIter=2),
    "perceptron": lambda: MultilayerPerceptronClassifier(layers=[1, 3, 2], maxIter=3, seed=1),
}


@pytest.mark.parametrize("kind", sorted(LEARNERS))
def test_binary_learners(numbers, kind, tmp_path):
    learner = LEARNERS[kind]()
    model = TrainClassifier(model=learner, labelCol="rain").fit(numbers)
    scored = model.transform(numbers)
    assert scored.columns[:5] == numbers.columns and "scored_labels" in scored.columns
    assert scored.count() == 12
    assert roles.get_levels(scored.schema, "scored_labels") == [0, 1]
    assert model.transform(numbers.drop("rain")).columns[-1] == "scored_labels"
    if not isinstance(learner, MultilayerPerceptronClassifier):
        assert metric(scored) >= 0.9
    model.save(str(tmp_path / "m"))
    again = TrainedClassifierModel.load(str(tmp_path / "m"))
    assert again.uid == model.uid and [r["scored_labels"] for r in again.transform(numbers).collect()] == [
        r["scored_labels"] for r in scored.collect()]


def test_many_classes(flowers):
    model = TrainClassifier(model=LogisticRegression(maxIter=5), labelCol="kind").fit(flowers)
    assert type(model.pipeline.stages[-1]).__name__ == "OneVsRestModel"
    scored = model.transform(flowers)
    assert roles.get_levels(scored.schema, "kind") == ["daisy", "rose", "tulip"]
    row = ComputeModelStatistics().transform(scored).first().asDict()
    assert row["evaluation_type"] == "Classification" and "macro_averaged_recall" in row
    assert sum(v for k, v in row.items() if k.startswith("predicted_class_as")) == 60
    with pytest.raises(ValueError, match="boosted"):
        TrainClassifier(model=GBTClassifier(), labelCol="kind").fit(flowers)
    with pytest.raises(ValueError, match="two classes"):
        ComputeModelStatistics(evaluationMetric="AUC").transform(scored)
    tree = TrainClassifier(model=DecisionTreeClassifier(), labelCol="kind").fit(flowers)
    assert metric(tree.transform(flowers)) == 1.0


def test_given_labels(flowers, spark):
    order = ["tulip", "daisy", "rose"]
    model = TrainClassifier(model=DecisionTreeClassifier(), labelCol="kind", labels=order).fit(flowers)
    scored = model.transform(flowers)
    assert roles.get_levels(scored.schema, "scored_labels") == order and metric(scored) == 1.0
    plain = TrainClassifier(model=DecisionTreeClassifier(), labelCol="y", reindexLabel=False).fit(
        flowers.withColumn("y", F.col("size").cast("int").cast("double")).drop("kind"))
    assert plain.levels is None


def test_null_labels_and_categorical_columns(spark, flowers):
    df = ValueIndexer(inputCol="kind", outputCol="kind").fit(flowers).transform(flowers).withColumn(
        "y", F.when(F.col("n") % 7 != 0, (F.col("size") > 1.15).cast("int")))
    model = TrainClassifier(model=LogisticRegression(maxIter=5), labelCol="y").fit(df)
    # two indicator slots and two numbers
    assert model.pipeline.stages[-1].numFeatures == 4
    forest = TrainClassifier(model=RandomForestClassifier(numTrees=2, seed=1), labelCol="y").fit(df)
    assert forest.pipeline.stages[-1].numFeatures == 3


def test_regressor(spark, numbers, tmp_path):
    df = spark.createDataFrame([(float(3 * i + 1), i) for i in range(30)] + [(None, 5)], "y double, x int")
    model = TrainRegressor(model=LinearRegression(solver="normal"), labelCol="y").fit(df)
    scored = model.transform(df)
    assert scored.columns == ["y", "x", "scores"]
    row = ComputeModelStatistics().transform(scored).first()
    assert row["mean_squared_error"] < 1e-12 and row["R^2"] == pytest.approx(1.0)
    losses = ComputePerInstanceStatistics().transform(scored.filter("y is not null"))
    assert losses.agg(F.max("L1_loss")).first()[0] < 1e-6 and losses.columns[-1] == "L2_loss"
    model.save(str(tmp_path / "m"))
    assert TrainedRegressorModel.load(str(tmp_path / "m")).transform(df).count() == 31
    with pytest.raises(TypeError):
        TrainRegressor(model=LinearRegression(), labelCol="s").fit(
            spark.createDataFrame([("a", 1)], "s string, x int"))
    assert TrainRegressor(model=DecisionTreeRegressor(), labelCol="rain").fit(numbers).transform(
        numbers).count() == 12


# ---- metrics ----

def test_regression_metrics_of_perfect_and_missing(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (None, 3.0), (4.0, None), (5.0, float("nan")), (7.0, 7.0)],
                               "y double, prediction double")
    row = regression_metrics(df, "y", "prediction").first()
    assert tuple(row) == (0.0, 0.0, 1.0, 0.0)
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "y double, p double")
    assert regression_metrics(flat, "y", "p").first()["R^2"] is None


MULTI = [(0.0, 0.0), (0.0, 0.0), (0.0, 1.0), (0.0, 2.0), (1.0, 0.0), (1.0, 1.0), (1.0, 1.0), (1.0, 1.0), (2.0, 2.0)]


def test_multiclass_metrics(spark):
    df = spark.createDataFrame(MULTI, "label double, prediction double")
    row = ComputeModelStatistics(evaluationMetric="classification", labelCol="label",
                                 scoredLabelsCol="prediction").transform(df).first()
    assert row["accuracy"] == row["precision"] == row["recall"] == pytest.approx(6 / 9)
    assert row["average_accuracy"] == pytest.approx((6 / 9 + 7 / 9 + 8 / 9) / 3)
    assert row["macro_averaged_precision"] == pytest.approx((2 / 3 + 3 / 4 + 1 / 2) / 3)
    assert row["macro_averaged_recall"] == pytest.approx((2 / 4 + 3 / 4 + 1) / 3)
    assert row["predicted_class_as_2.0_actual_is_0.0"] == 1.0


def test_confusion_of_one_class_and_of_unknown_predictions():
    one = ConfusionMatrix([(1.0, 1.0, 5)])
    assert one.binary()["accuracy"] == 1.0 and one.at(1.0, 1.0) == 5 and one.classes == [0.0, 1.0]
    never = ConfusionMatrix([(0.0, 0.0, 2), (1.0, 0.0, 2), (2.0, 2.0, 1)])
    assert math.isnan(never.multiclass()["macro_averaged_precision"])
    outside = ConfusionMatrix([(0.0, 9.0, 1), (0.0, 0.0, 1), (1.0, 1.0, 1), (2.0, 2.0, 1)])
    assert outside.multiclass()["accuracy"] == 3 / 4


@pytest.mark.parametrize("share", [0.0, 0.4])
def test_auc_against_the_evaluator(spark, share):
    """Also when two fifths of all rows have the same score."""
    df = spark.range(4000).select(
        (F.rand(3) < 0.3).cast("double").alias("y"),
        F.when(F.rand(5) < share, F.lit(0.25)).otherwise(F.round(F.rand(4), 3)).alias("s"))
    df = df.withColumn("s", F.col("s") + F.col("y") * 0.2).persist()
    points = roc_points(df, F.col("y"), F.col("s"))
    want = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(df)
    assert area_under_roc(points).first()["AUC"] == pytest.approx(want, abs=1e-12)
    curve = sorted(tuple(r) for r in roc_curve(points).collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:]))
    assert area == pytest.approx(want, abs=1e-9) and curve[0] == (0.0, 0.0) and curve[-1] == (1.0, 1.0)


def test_metric_errors(spark, numbers):
    df = spark.createDataFrame(MULTI, "label double, prediction double")
    with pytest.raises(ValueError, match="no scored columns"):
        ComputeModelStatistics().transform(df)
    with pytest.raises(ValueError):
        ComputeModelStatistics(evaluationMetric="nonsense", labelCol="label").transform(df)
    scored = TrainClassifier(model=DecisionTreeClassifier(), labelCol="rain").fit(numbers).transform(numbers)
    with pytest.raises(ValueError, match="measures no classifier"):
        ComputeModelStatistics(evaluationMetric="mse").transform(scored)
    with pytest.raises(ValueError):
        ComputePerInstanceStatistics().transform(df)


def test_log_loss(numbers):
    scored = TrainClassifier(model=LogisticRegression(maxIter=5), labelCol="rain").fit(numbers).transform(numbers)
    out = ComputePerInstanceStatistics().transform(scored)
    for r in out.collect():
        assert r["log_loss"] == pytest.approx(-math.log(r["scored_probabilities"][int(r["scored_labels"])]))


def test_plain_spark_model(numbers):
    data = VectorAssembler(inputCols=["damp", "warmth"], outputCol="features").transform(
        numbers.withColumnRenamed("rain", "label"))
    scored = LogisticRegression(maxIter=5).fit(data).transform(data)
    row = ComputeModelStatistics(evaluationMetric="classification", labelCol="label",
                                 scoredLabelsCol="prediction", scoresCol="rawPrediction").transform(scored).first()
    want = BinaryClassificationEvaluator(numBins=0).evaluate(scored)
    assert row["AUC"] == pytest.approx(want)


# ---- selection ----

@pytest.mark.parametrize("kind", ["logistic", "forest"])
def test_two_class_models_score_after_components(spark, numbers, kind):
    """The summary of such a model holds its session, which has to stay serializable."""
    from tablewright.llm.components import components
    links = spark.createDataFrame([(1, 2), (2, 3), (7, 8)], "a long, b long")
    assert sorted(tuple(r) for r in components(links).select("node", "root").collect()) == [
        (1, 1), (2, 1), (3, 1), (7, 7), (8, 7)]
    model = TrainClassifier(model=LEARNERS[kind](), labelCol="rain").fit(numbers)
    assert len(model.transform(numbers).select("scored_labels").collect()) == len(ROWS)
    plain = VectorAssembler(inputCols=["damp", "wind"], outputCol="v").transform(numbers)
    fitted = LogisticRegression(featuresCol="v", labelCol="rain", maxIter=3).fit(plain)
    assert len(fitted.transform(plain).select("prediction").collect()) == len(ROWS)


def test_best_model_is_measured_once(numbers, monkeypatch):
    """All metrics take the passes that the area under the curve takes, so the best model's are kept."""
    from tablewright.operators import select_model
    measured, evaluator = [], select_model.evaluator_for
    monkeypatch.setattr(select_model, "evaluator_for", lambda m, metric: measured.append(m) or evaluator(m, metric))
    models = [TrainClassifier(model=DecisionTreeClassifier(maxDepth=d), labelCol="rain").fit(numbers)
              for d in (0, 3)]
    best = FindBestModel(models=models, evaluationMetric="AUC").fit(numbers)
    assert measured == models and best.getBestModel() is models[1]
    assert best.getBestModelMetrics().first()["AUC"] == best.getAllModelMetrics().collect()[1]["metric"]
    assert best.getEvaluationResults().count() >= 3


def test_best_model(numbers, tmp_path):
    models = [TrainClassifier(model=DecisionTreeClassifier(maxDepth=d), labelCol="rain").fit(numbers)
              for d in (0, 3)]
    best = FindBestModel(models=models, evaluationMetric="AUC").fit(numbers)
    assert best.getBestModel() is models[1]
    table = best.getAllModelMetrics().collect()
    assert [r["model_name"] for r in table] == [m.uid for m in models] and "maxDepth: 3" in table[1]["parameters"]
    assert best.getEvaluationResults().count() >= 3 and best.transform(numbers).count() == 12
    assert best.getBestModelMetrics().first()["accuracy"] == 1.0
    best.save(str(tmp_path / "b"))
    assert BestModel.load(str(tmp_path / "b")).getAllModelMetrics().count() == 2
    regressor = TrainRegressor(model=LinearRegression(), labelCol="rain").fit(numbers)
    with pytest.raises(ValueError, match="one kind"):
        FindBestModel(models=[models[0], regressor]).fit(numbers)
    with pytest.raises(ValueError):
        FindBestModel(models=[]).fit(numbers)
    with pytest.raises(ValueError):
        FindBestModel(models=models, evaluationMetric="rmse").fit(numbers)
    lowest = FindBestModel(models=[regressor, TrainRegressor(model=DecisionTreeRegressor(), labelCol="rain").fit(
        numbers)], evaluationMetric="mse").fit(numbers)
    assert lowest.getBestModelMetrics().first()["mean_squared_error"] < 0.01


def test_tuning(flowers):
    learner = DecisionTreeClassifier()
    trainer = TrainClassifier(model=learner, labelCol="kind")
    grid = GridSpace([{learner.maxDepth: 0}, {learner.maxDepth: 4}])
    tuned = TuneHyperparameters(models=[trainer], paramSpace=grid, numFolds=2, numRuns=2, parallelism=2,
                                seed=7, evaluationMetric="accuracy").fit(flowers)
    assert tuned.getBestMetric() > 0.9 and "maxDepth: 4" in tuned.getBestModelInfo()
    assert learner.getMaxDepth() == 5 and tuned.transform(flowers).count() == 60


def test_parameter_spaces(spark):
    learner = LogisticRegression()
    space = RandomSpace(HyperparamBuilder().addHyperparam(learner.regParam, DoubleRangeHyperParam(0.1, 0.2))
                        .addHyperparam(learner.maxIter, IntRangeHyperParam(5, 10))
                        .addHyperparam(learner.family, DiscreteHyperParam(["auto", "binomial"])).build())
    maps = space.paramMaps()
    for _ in range(20):
        m = next(maps)
        assert 0.1 <= m[learner.regParam] < 0.2 and 5 <= m[learner.maxIter] < 10
    assert len(default_range(RandomForestClassifier())) == 6
    with pytest.raises(TypeError):
        default_range(LinearRegression())


def test_metrics_of_many_classes(spark):
    """A label like a key: no cap, no matrix in columns, the same numbers as by the matrix."""
    rows = [(float(i % 3000), float((i * 7) % 3000 if i % 4 else i % 3000)) for i in range(9000)] + [(5.0, 99999.0), (2999.5, 1.0)]
    df = spark.createDataFrame(rows, "label double, scored_labels double")
    stats = ComputeModelStatistics(labelCol="label", scoredLabelsCol="scored_labels", evaluationMetric="classification")
    out = stats.transform(df)
    assert len(out.columns) == 7 and stats.confusionTable.agg({"count": "sum"}).first()[0] == len(rows)
    counts = Counter(rows)
    expected = ConfusionMatrix([(a, p, n) for (a, p), n in counts.items()]).multiclass()
    found = out.first().asDict()
    for name, value in expected.items():
        assert found[name] == pytest.approx(value, nan_ok=True) or math.isnan(found[name]) and math.isnan(value)


def test_sixty_thousand_labels_train_and_score(spark):
    """More labels than are kept in column metadata: positions by a table, a learner that needs one
    number per label and feature."""
    n = 60000
    df = spark.range(n).select(F.concat(F.lit("label-"), F.format_string("%06d", F.col("id"))).alias("label"),
                               (F.col("id") % 2).cast("double").alias("x"))
    model = TrainClassifier(model=NaiveBayes(), labelCol="label").fit(df)
    assert len(model.getLevels()) == n and model.getLevels() == sorted(model.getLevels())
    scored = model.transform(df.limit(3))
    assert {r["scored_labels"] for r in scored.collect()} <= {float(i) for i in range(n)}
    given = [f"label-{i:06d}" for i in range(5000)][::-1]
    ordered = TrainClassifier(model=NaiveBayes(), labelCol="label", labels=given).fit(df.limit(5000))
    assert ordered.getLevels() == given


@pytest.mark.parametrize("most, dealt", [(100, True), (2000, False)])
def test_no_task_trains_on_more_than_its_share(spark, monkeypatch, most, dealt):
    from tablewright.operators import train
    monkeypatch.setattr(train, "ROWS_PER_TASK", most)
    seen, fit = [], DecisionTreeClassifier._fit

    def fit_and_look(self, data):
        seen.extend(r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect())
        return fit(self, data)
    monkeypatch.setattr(DecisionTreeClassifier, "_fit", fit_and_look)
    rows = spark.range(0, 1000, 1, 1).select((F.col("id") % 10 > 4).cast("int").alias("high"), (F.col("id") % 10).cast("double").alias("x"))
    model = TrainClassifier(model=DecisionTreeClassifier(), labelCol="high").fit(rows)
    assert sum(seen) == 1000 and (max(seen) <= most if dealt else seen == [1000])
    assert metric(model.transform(rows)) == 1.0
