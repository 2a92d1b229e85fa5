"""Queries H and I: training, metrics, model selection, stages over streams."""

from __future__ import annotations

from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
    NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from tablewright.catalog import prepare
from tablewright.catalog.common import (
    CHANNELS, SIDE, image_sql, joined, pixel_values, query, table,
)
from tablewright.catalog.images import DENSE_SQL, _layer
from tablewright.catalog.prepare import GAPS_SQL, WORDS, _with_gaps
from tablewright.functions import roles
from tablewright.functions.images import pixel_image
from tablewright.operators.apply import get_value_at
from tablewright.operators.balance import ClassBalancer
from tablewright.operators.categorical import ValueIndexer
from tablewright.operators.cleaning import CleanMissingData
from tablewright.operators.featurize import AssembleFeatures
from tablewright.operators.images import ImageTransformer
from tablewright.operators.instance import ComputePerInstanceStatistics
from tablewright.operators.metrics import (
    ComputeModelStatistics, area_under_roc, confusion_table, regression_metrics, roc_curve,
    roc_points,
)
from tablewright.operators.scoring import BatchScorer, dense_model
from tablewright.operators.select_model import (
    DoubleRangeHyperParam, FindBestModel, HyperparamBuilder, IntRangeHyperParam, RandomSpace,
    TuneHyperparameters,
)
from tablewright.operators.text_replace import TextPreprocessor
from tablewright.operators.train import TrainClassifier, TrainRegressor
from tablewright.plans.staging import new_path
from tablewright.streaming.stages import apply_to_stream, run_to_table, stream_table


def _flags(spark, sf):
    """Return flag of a line from its numbers."""
    return table(spark, sf, "lineitem").select(
        "l_returnflag", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _status(spark, sf):
    """Open or finished line, two classes."""
    return table(spark, sf, "lineitem").select(
        "l_linestatus", "l_quantity", "l_discount", F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"))


def _fitted(spark, sf, learner, df=None, label="l_linestatus"):
    df = _status(spark, sf) if df is None else df
    return TrainClassifier(model=learner, labelCol=label).fit(df), df


def _scored_counts(scored, label):
    return scored.groupBy(F.col(label).alias("actual"), "scored_labels").agg(
        F.count(F.lit(1)).alias("n"))


@query("h1_train_logistic")
def h1_train_logistic(spark, sf):
    model, df = _fitted(spark, sf, LogisticRegression(maxIter=5))
    return _scored_counts(model.transform(df), "l_linestatus")


@query("h1_train_one_vs_rest")
def h1_train_one_vs_rest(spark, sf):
    model, df = _fitted(spark, sf, LogisticRegression(maxIter=3), _flags(spark, sf), "l_returnflag")
    return _scored_counts(model.transform(df), "l_returnflag")


@query("h1_train_tree")
def h1_train_tree(spark, sf):
    model, df = _fitted(spark, sf, DecisionTreeClassifier(maxDepth=4), _flags(spark, sf), "l_returnflag")
    return _scored_counts(model.transform(df), "l_returnflag")


@query("h1_train_boosted_trees")
def h1_train_boosted_trees(spark, sf):
    model, df = _fitted(spark, sf, GBTClassifier(maxIter=3, maxDepth=3))
    return _scored_counts(model.transform(df), "l_linestatus")


@query("h1_train_perceptron")
def h1_train_perceptron(spark, sf):
    model, df = _fitted(spark, sf, MultilayerPerceptronClassifier(layers=[1, 4, 2], maxIter=5, seed=1))
    return _scored_counts(model.transform(df), "l_linestatus")


@query("h1_train_on_text")
def h1_train_on_text(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    df = table(spark, sf, "labels").join(docs, "doc_id").select("quality", "text")
    model = TrainClassifier(model=NaiveBayes(), labelCol="quality", numFeatures=4096).fit(df)
    return _scored_counts(model.transform(df), "quality")


@query("h2_score_classifier", """
SELECT CAST(count(*) AS BIGINT) AS scored, CAST(count(*) AS BIGINT) AS with_probability FROM lineitem""")
def h2_score_classifier(spark, sf):
    """Scoring needs no label column."""
    model, df = _fitted(spark, sf, RandomForestClassifier(numTrees=3, maxDepth=3, seed=1))
    scored = model.transform(df.drop("l_linestatus"))
    return scored.agg(F.count("scored_labels").alias("scored"),
                      F.count("scored_probabilities").alias("with_probability"))


def _line(spark, sf):
    return table(spark, sf, "lineitem").select("l_extendedprice", "l_quantity")


def _linear(spark, sf):
    learner = LinearRegression(solver="normal", regParam=0.0)
    return TrainRegressor(model=learner, labelCol="l_extendedprice").fit(_line(spark, sf))


@query("h3_train_regressor", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem""")
def h3_train_regressor(spark, sf):
    fitted = _linear(spark, sf).pipeline.stages[-1]
    rows = table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.round(F.lit(float(fitted.coefficients[0])), 4).alias("slope"),
                       F.round(F.lit(float(fitted.intercept)), 3).alias("intercept"))


@query("h4_score_regressor", """
WITH fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a,
                    regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)
SELECT l_quantity, CAST(count(*) AS BIGINT) AS n, round(max(a * l_quantity + b), 3) AS scores
FROM lineitem, fit GROUP BY l_quantity""")
def h4_score_regressor(spark, sf):
    scored = _linear(spark, sf).transform(_line(spark, sf))
    return scored.groupBy("l_quantity").agg(F.count(F.lit(1)).alias("n"),
                                            F.round(F.max("scores"), 3).alias("scores"))


# ---- metrics ----

_GUESS_SQL = "(l_quantity * 1500 + l_partkey)"


def _guess(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_extendedprice", (F.col("l_quantity") * 1500 + F.col("l_partkey")).alias("guess"))


@query("h6_regression_metrics", f"""
WITH e AS (SELECT l_extendedprice AS y, {_GUESS_SQL} AS p FROM lineitem)
SELECT round(avg((y - p) ** 2), 2) AS mean_squared_error,
       round(sqrt(avg((y - p) ** 2)), 5) AS root_mean_squared_error,
       round(1 - avg((y - p) ** 2) / var_pop(y), 9) AS "R^2",
       round(avg(abs(y - p)), 5) AS mean_absolute_error FROM e""")
def h6_regression_metrics(spark, sf):
    out = regression_metrics(_guess(spark, sf), "l_extendedprice", "guess")
    for name, digits in (("mean_squared_error", 2), ("root_mean_squared_error", 5), ("R^2", 9),
                         ("mean_absolute_error", 5)):
        out = out.withColumn(name, F.round(f"`{name}`", digits))
    return out


def _judged(spark, sf):
    """Labels with a guess from the document length."""
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    return table(spark, sf, "labels").join(docs, "doc_id").select(
        F.col("quality").cast("double").alias("quality"),
        (F.col("n_chars") > 1500).cast("double").alias("guess"),
        F.col("n_chars").cast("double").alias("score"))


JUDGED_SQL = """judged AS (SELECT CAST(quality AS DOUBLE) AS y, CAST(n_chars > 1500 AS DOUBLE) AS p,
    CAST(n_chars AS DOUBLE) AS s FROM labels JOIN documents USING (doc_id))"""


@query("h7_confusion_table", f"""WITH {JUDGED_SQL}
SELECT y AS label, p AS prediction, CAST(count(*) AS BIGINT) AS count FROM judged GROUP BY y, p""")
def h7_confusion_table(spark, sf):
    return confusion_table(_judged(spark, sf), "quality", "guess")


AUC_SQL = """per_score AS (SELECT s, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg
              FROM judged GROUP BY s),
running AS (SELECT *, sum(pos) OVER (ORDER BY s DESC) AS cum_pos,
            sum(neg) OVER (ORDER BY s DESC) AS cum_neg FROM per_score),
area AS (SELECT sum(neg * (2.0 * cum_pos - pos)) / (2.0 * sum(pos) * sum(neg)) AS auc FROM running)"""


@query("h7_binary_metrics", f"""WITH {JUDGED_SQL},
c AS (SELECT CAST(count(*) FILTER (y = 1 AND p = 1) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (y = 0 AND p = 1) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (y = 1 AND p = 0) AS DOUBLE) AS fn,
             CAST(count(*) FILTER (y = 0 AND p = 0) AS DOUBLE) AS tn FROM judged),
{AUC_SQL}
SELECT 'Classification' AS evaluation_type,
       tn AS "predicted_class_as_0.0_actual_is_0.0", fn AS "predicted_class_as_0.0_actual_is_1.0",
       fp AS "predicted_class_as_1.0_actual_is_0.0", tp AS "predicted_class_as_1.0_actual_is_1.0",
       round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy, round(tp / (tp + fp), 9) AS precision,
       round(tp / (tp + fn), 9) AS recall, round(auc, 9) AS "AUC" FROM c, area""")
def h7_binary_metrics(spark, sf):
    out = ComputeModelStatistics(evaluationMetric="classification", labelCol="quality",
                                 scoredLabelsCol="guess", scoresCol="score").transform(
        _judged(spark, sf))
    for name in ("accuracy", "precision", "recall", "AUC"):
        out = out.withColumn(name, F.round(name, 9))
    return out


@query("h8_multiclass_metrics", """
WITH s AS (SELECT dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS y,
                  CASE WHEN o_totalprice < 100000 THEN 0 WHEN o_totalprice < 300000 THEN 1 ELSE 2 END AS p
           FROM orders),
cells AS (SELECT y, p, count(*) AS n FROM s GROUP BY y, p),
classes AS (SELECT c.y AS k, (SELECT sum(n) FROM cells WHERE y = c.y) AS actual,
                   (SELECT sum(n) FROM cells WHERE p = c.y) AS predicted,
                   (SELECT sum(n) FROM cells WHERE y = c.y AND p = c.y) AS hit
            FROM (SELECT DISTINCT y FROM cells) c),
t AS (SELECT CAST(count(*) AS DOUBLE) AS total FROM s)
SELECT round(sum(hit) / max(total), 9) AS accuracy, round(sum(hit) / max(total), 9) AS precision,
       round(sum(hit) / max(total), 9) AS recall,
       round(avg((2 * hit + total - actual - predicted) / total), 9) AS average_accuracy,
       round(avg(CAST(hit AS DOUBLE) / predicted), 9) AS macro_averaged_precision,
       round(avg(CAST(hit AS DOUBLE) / actual), 9) AS macro_averaged_recall FROM classes, t""")
def h8_multiclass_metrics(spark, sf):
    df = table(spark, sf, "orders").select("o_orderstatus", F.when(F.col("o_totalprice") < 100000, 0.0)
                                           .when(F.col("o_totalprice") < 300000, 1.0)
                                           .otherwise(2.0).alias("p"))
    coded = ValueIndexer(inputCol="o_orderstatus", outputCol="y").fit(df).transform(df)
    plain = coded.select(F.col("y").cast("double").alias("y"), "p")
    out = ComputeModelStatistics(evaluationMetric="classification", labelCol="y",
                                 scoredLabelsCol="p").transform(plain.withMetadata("y", {}))
    names = ["accuracy", "precision", "recall", "average_accuracy", "macro_averaged_precision",
             "macro_averaged_recall"]
    return out.select(*[F.round(n, 9).alias(n) for n in names])


@query("h8_many_classes", """
WITH s AS (SELECT l_partkey AS y, CASE WHEN l_linenumber % 4 = 0 THEN l_suppkey ELSE l_partkey END AS p FROM lineitem),
a AS (SELECT y AS k, count(*) AS actual, count(*) FILTER (p IN (SELECT y FROM s)) AS counted,
             count(*) FILTER (p = y) AS hit FROM s GROUP BY y),
b AS (SELECT p AS k, count(*) AS predicted FROM s GROUP BY p),
t AS (SELECT CAST(count(*) AS DOUBLE) AS total FROM s)
SELECT round(sum(hit) / max(total), 9) AS accuracy,
       round(avg((2 * hit + total - counted - predicted) / total), 9) AS average_accuracy,
       round(avg(CAST(hit AS DOUBLE) / predicted), 9) AS macro_averaged_precision,
       round(avg(CAST(hit AS DOUBLE) / counted), 9) AS macro_averaged_recall FROM a JOIN b USING (k), t""")
def h8_many_classes(spark, sf):
    """A label with as many classes as there are parts."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("double").alias("y"),
        F.when(F.col("l_linenumber") % 4 == 0, F.col("l_suppkey")).otherwise(F.col("l_partkey")).cast("double").alias("p"))
    out = ComputeModelStatistics(evaluationMetric="classification", labelCol="y", scoredLabelsCol="p").transform(lines)
    names = ["accuracy", "average_accuracy", "macro_averaged_precision", "macro_averaged_recall"]
    return out.select(*[F.round(n, 9).alias(n) for n in names])


@query("h9_roc_curve", f"""WITH {JUDGED_SQL}, {AUC_SQL},
totals AS (SELECT CAST(sum(pos) AS DOUBLE) AS p, CAST(sum(neg) AS DOUBLE) AS n FROM per_score)
SELECT round(cum_neg / n, 9) AS false_positive_rate, round(cum_pos / p, 9) AS true_positive_rate
FROM running, totals UNION ALL SELECT 0.0::DOUBLE, 0.0::DOUBLE UNION ALL SELECT 1.0::DOUBLE, 1.0::DOUBLE""")
def h9_roc_curve(spark, sf):
    curve = roc_curve(roc_points(_judged(spark, sf), F.col("quality"), F.col("score")))
    return curve.select(F.round("false_positive_rate", 9).alias("false_positive_rate"),
                        F.round("true_positive_rate", 9).alias("true_positive_rate"))


@query("h9_area_under_roc", """
WITH judged AS (SELECT CAST(l_linestatus = 'F' AS DOUBLE) AS y, l_extendedprice AS s FROM lineitem),
""" + AUC_SQL + """ SELECT round(auc, 9) AS "AUC" FROM area""")
def h9_area_under_roc(spark, sf):
    lines = table(spark, sf, "lineitem")
    points = roc_points(lines, (F.col("l_linestatus") == "F").cast("double"), F.col("l_extendedprice"))
    return area_under_roc(points).select(F.round("AUC", 9).alias("AUC"))


@query("h10_single_metric_recall", f"""WITH {JUDGED_SQL}
SELECT 'Classification' AS evaluation_type, round(CAST(count(*) FILTER (y = 1 AND p = 1) AS DOUBLE)
       / count(*) FILTER (y = 1), 9) AS recall FROM judged""")
def h10_single_metric_recall(spark, sf):
    return ComputeModelStatistics(evaluationMetric="recall", labelCol="quality",
                                  scoredLabelsCol="guess").transform(_judged(spark, sf)).withColumn(
        "recall", F.round("recall", 9))


@query("h10_single_metric_mae", f"""
SELECT round(avg(abs(l_extendedprice - {_GUESS_SQL})), 5) AS mean_absolute_error FROM lineitem""")
def h10_single_metric_mae(spark, sf):
    return ComputeModelStatistics(evaluationMetric="mae", labelCol="l_extendedprice",
                                  scoresCol="guess").transform(_guess(spark, sf)).select(
        F.round("mean_absolute_error", 5).alias("mean_absolute_error"))


@query("h11_instance_regression_loss", """
SELECT l_orderkey, l_linenumber, round(abs(l_extendedprice - l_quantity * 1500), 4) AS "L1_loss",
       round((l_extendedprice - l_quantity * 1500) ** 2, 2) AS "L2_loss" FROM lineitem""")
def h11_instance_regression_loss(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_quantity") * 1500).alias("scores"))
    model = roles.new_model_name()
    df = roles.set_role(df, "l_extendedprice", model, roles.LABEL_ROLE, roles.REGRESSION)
    df = roles.set_role(df, "scores", model, roles.SCORES_ROLE, roles.REGRESSION)
    return ComputePerInstanceStatistics().transform(df).select(
        "l_orderkey", "l_linenumber", F.round("L1_loss", 4).alias("L1_loss"),
        F.round("L2_loss", 2).alias("L2_loss"))


@query("h12_instance_log_loss", """
SELECT event_id, round(-ln(least(1.0, greatest(1e-15, CASE user_id % 3 WHEN 0 THEN value / 1000
       WHEN 1 THEN 1 - value / 1000 ELSE 1e-15 END))), 9) AS log_loss FROM events""")
def h12_instance_log_loss(spark, sf):
    share = F.col("value") / 1000
    df = table(spark, sf, "events").select(
        "event_id", (F.col("user_id") % 2).cast("double").alias("label"),
        array_to_vector(F.array(share, 1 - share)).alias("scored_probabilities"),
        (F.col("user_id") % 3).cast("double").alias("scored_labels"))
    model, kind = roles.new_model_name(), roles.CLASSIFICATION
    for column, role in (("label", roles.LABEL_ROLE), ("scored_labels", roles.SCORED_LABELS_ROLE),
                         ("scored_probabilities", roles.PROBABILITIES_ROLE)):
        df = roles.set_role(df, column, model, role, kind)
    return ComputePerInstanceStatistics().transform(df).select(
        "event_id", F.round("log_loss", 9).alias("log_loss"))


@query("h13_best_of_models")
def h13_best_of_models(spark, sf):
    df = _status(spark, sf)
    models = [TrainClassifier(model=learner, labelCol="l_linestatus").fit(df) for learner in (
        DecisionTreeClassifier(maxDepth=2), LogisticRegression(maxIter=3))]
    best = FindBestModel(models=models, evaluationMetric="AUC").fit(df)
    return best.getAllModelMetrics().select("metric", "parameters")


@query("h13_best_regressor")
def h13_best_regressor(spark, sf):
    df = _line(spark, sf)
    models = [TrainRegressor(model=learner, labelCol="l_extendedprice").fit(df) for learner in (
        LinearRegression(solver="normal"), DecisionTreeRegressor(maxDepth=2))]
    best = FindBestModel(models=models, evaluationMetric="rmse").fit(df)
    return best.getBestModelMetrics()


@query("h14_tune_hyperparameters")
def h14_tune_hyperparameters(spark, sf):
    learner = DecisionTreeClassifier()
    space = HyperparamBuilder().addHyperparam(learner.maxDepth, IntRangeHyperParam(2, 4)).addHyperparam(
        learner.minInfoGain, DoubleRangeHyperParam(0.0, 0.1)).build()
    trainer = TrainClassifier(model=learner, labelCol="l_linestatus")
    df = _status(spark, sf)
    tuned = TuneHyperparameters(models=[trainer], paramSpace=RandomSpace(space), numFolds=2, numRuns=2,
                                parallelism=2, seed=1, evaluationMetric="accuracy").fit(df)
    return _scored_counts(tuned.transform(df), "l_linestatus")


# ---- streams ----

def _streamed(spark, stream):
    return run_to_table(stream, new_path(spark, "out"), new_path(spark, "progress"))


@query("i1_stream_imputed", f"""WITH {GAPS_SQL}
SELECT event_id, round(coalesce(v, (SELECT avg(v) FROM gaps)), 6) AS v FROM gaps""")
def i1_stream_imputed(spark, sf):
    model = CleanMissingData(inputCols=["v"], outputCols=["v"]).fit(_with_gaps(spark, sf))
    e = stream_table(spark, sf, "events")
    gone = F.when(F.col("user_id") % 2 == 0, F.lit(float("nan")))
    stream = e.select("event_id", F.when(F.col("event_type") != "error", F.col("value"))
                      .otherwise(gone).alias("v"))
    return _streamed(spark, apply_to_stream([model], stream)).withColumn("v", F.round("v", 6))


@query("i1_stream_indexed_and_weighted", """
WITH counts AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority)
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS coded,
       round((SELECT max(n) FROM counts) / CAST(n AS DOUBLE), 9) AS weight
FROM orders JOIN counts USING (o_orderpriority)""")
def i1_stream_indexed_and_weighted(spark, sf):
    static = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    stages = [ValueIndexer(inputCol="o_orderpriority", outputCol="coded").fit(static),
              ClassBalancer(inputCol="o_orderpriority").fit(static)]
    stream = stream_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return _streamed(spark, apply_to_stream(stages, stream)).select(
        "o_orderkey", "coded", F.round("weight", 9).alias("weight"))


@query("i1_stream_replaced_words", f"""
SELECT doc_id, array_to_string([coalesce({prepare._MAP}[regexp_extract(p, '{prepare._START}')], p)
       for p in regexp_extract_all(text, '{prepare._PIECES}')], '') AS replaced FROM documents""")
def i1_stream_replaced_words(spark, sf):
    stage = TextPreprocessor(inputCol="text", outputCol="replaced", map=WORDS)
    stream = stream_table(spark, sf, "documents").select("doc_id", "text")
    return _streamed(spark, apply_to_stream([stage], stream)).select("doc_id", "replaced")


@query("i1_stream_scored", """
WITH fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a,
                    regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)
SELECT l_quantity, CAST(count(*) AS BIGINT) AS n, round(max(a * l_quantity + b), 3) AS scores
FROM lineitem, fit GROUP BY l_quantity""")
def i1_stream_scored(spark, sf):
    model = _linear(spark, sf)
    stream = stream_table(spark, sf, "lineitem").select("l_extendedprice", "l_quantity")
    scored = _streamed(spark, apply_to_stream([model], stream))
    return scored.groupBy("l_quantity").agg(F.count(F.lit(1)).alias("n"),
                                            F.round(F.max("scores"), 3).alias("scores"))


@query("i1_stream_images", image_sql("px[((i // 24) * 8 + 7 - (i // 3) % 8) * 3 + i % 3 + 1]", 192))
def i1_stream_images(spark, sf):
    stream = stream_table(spark, sf, "embeddings").select("vec_id", pixel_image(
        F.lit(SIDE), F.lit(SIDE), F.lit(CHANNELS), pixel_values(F.col("embedding"))).alias("image"))
    stage = ImageTransformer(inputCol="image", outputCol="out").flip(1)
    out = apply_to_stream([stage], stream).select("vec_id", joined(F.col("out.pixels")).alias("pixels"))
    return _streamed(spark, out)


@query("i1_stream_features", """
SELECT event_id, CAST(epoch_us(ts) // 1000 AS DOUBLE) AS ms, CAST(isodow(ts) AS DOUBLE) AS weekday,
       value FROM events""")
def i1_stream_features(spark, sf):
    columns = ["event_id", "ts", "value"]
    model = AssembleFeatures(columnsToFeaturize=["ts", "value"]).fit(table(spark, sf, "events").select(*columns))
    stream = stream_table(spark, sf, "events").select(*columns)
    out = _streamed(spark, apply_to_stream([model], stream).select("event_id", "features"))
    return out.select("event_id", get_value_at("features", 0).alias("ms"),
                      get_value_at("features", 2).alias("weekday"), get_value_at("features", 8).alias("value"))


@query("i1_stream_batch_scored", f"""WITH {DENSE_SQL}
SELECT vec_id, round(h[1], 6) AS s0, round(h[6], 6) AS s5 FROM dense""")
def i1_stream_batch_scored(spark, sf):
    model = dense_model([_layer("hidden", 64, 6, "identity")])
    scorer = BatchScorer(inputCol="embedding", outputCol="s", model=model, outputNodeIndex=0, miniBatchSize=100)
    stream = stream_table(spark, sf, "embeddings").select("vec_id", "embedding")
    out = _streamed(spark, apply_to_stream([scorer], stream).select("vec_id", "s"))
    return out.select("vec_id", F.round(get_value_at("s", 0), 6).alias("s0"),
                      F.round(get_value_at("s", 5), 6).alias("s5"))


@query("i1_stream_classified", """
SELECT CAST(count(*) AS BIGINT) AS scored, CAST(0 AS BIGINT) AS different FROM lineitem""")
def i1_stream_classified(spark, sf):
    """A stream gets the same labels as the table."""
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_quantity",
                                             F.year("l_shipdate").alias("year"))
    learner = DecisionTreeClassifier(maxDepth=3)
    model = TrainClassifier(model=learner, labelCol="l_linestatus").fit(df)
    stream = stream_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus", "l_quantity", F.year("l_shipdate").alias("year"))
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "year", "scored_labels"]
    streamed = _streamed(spark, apply_to_stream([model], stream).select(*columns))
    batch = model.transform(df).select(*columns)
    votes = streamed.withColumn("v", F.lit(1)).unionByName(batch.withColumn("v", F.lit(-1)))
    sums = votes.groupBy(*columns).agg(F.sum("v").alias("v"), F.count_if(F.col("v") > 0).alias("n"))
    return sums.agg(F.sum("n").alias("scored"), F.count_if(F.col("v") != 0).alias("different"))
