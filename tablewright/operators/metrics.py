"""Model metrics as plain aggregates."""

from __future__ import annotations

import math

from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.base import HasLabelCol, as_str, param, unused_name
from tablewright.functions.vectors import elements
from tablewright.functions import roles
from tablewright.functions.missing import drop_missing
from tablewright.plans.ordering import running_totals
from tablewright.plans.staging import stage_table

# fixed values: metric names and the result columns they stand for
REGRESSION_COLUMNS = {"mse": "mean_squared_error", "rmse": "root_mean_squared_error",
                      "r2": "R^2", "mae": "mean_absolute_error"}
CLASSIFICATION_COLUMNS = {"accuracy": "accuracy", "precision": "precision", "recall": "recall",
                          "AUC": "AUC"}
MULTICLASS_COLUMNS = ["average_accuracy", "macro_averaged_precision", "macro_averaged_recall"]
ALL, ALL_REGRESSION, ALL_CLASSIFICATION = "all", "regression", "classification"
EVALUATION_TYPE = "evaluation_type"
FPR, TPR = "false_positive_rate", "true_positive_rate"
# the matrix has named columns up to so many classes; its long table has all cells of any label
NAMED_CLASSES = 100
# levels up to which a label is numbered by a choice inside the row instead of by a join
CHOSEN_LEVELS = 200


def metric_kind(metric: str) -> str:
    if metric in REGRESSION_COLUMNS or metric == ALL_REGRESSION:
        return roles.REGRESSION
    if metric in CLASSIFICATION_COLUMNS or metric in (ALL_CLASSIFICATION, "areaUnderROC"):
        return roles.CLASSIFICATION
    raise ValueError(f"unknown metric {metric!r}")


def higher_is_better(metric: str) -> bool:
    return metric not in ("mse", "rmse", "mae")


def regression_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row, one pass. R^2 is null when the label is constant."""
    y, p = F.col("y"), F.col("p")
    pairs = drop_missing(df.select(F.col(f"`{label}`").cast("double").alias("y"),
                                   F.col(f"`{score}`").cast("double").alias("p")), ["y", "p"])
    sums = pairs.agg(F.avg((y - p) * (y - p)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"),
                     F.var_pop(y).alias("spread"))
    return sums.select(
        F.col("mse").alias("mean_squared_error"),
        F.sqrt("mse").alias("root_mean_squared_error"),
        (F.lit(1.0) - F.col("mse") / F.nullif(F.col("spread"), F.lit(0.0))).alias("R^2"),
        F.col("mae").alias("mean_absolute_error"))


def confusion_table(df: DataFrame, label: str, prediction: str,
                    levels: list | None = None) -> DataFrame:
    """(label, prediction, count), both as class numbers. ``levels`` turns label values into
    their positions."""
    numbered, number = numbered_label(df, label, levels)
    pairs = numbered.select(number.alias("label"), F.col(f"`{prediction}`").cast("double").alias("prediction"))
    return (drop_missing(pairs, ["label", "prediction"])
            .groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("count")))


def numbered_label(df: DataFrame, label: str, levels: list | None) -> tuple[DataFrame, Column]:
    """``df`` and the label's class number in it. Many levels are looked up in a table of the list
    that the model holds; no row is shuffled for it."""
    known = [v for v in levels or [] if v is not None]
    if levels is None or len(known) <= CHOSEN_LEVELS:
        return df, class_number(F.col(f"`{label}`"), levels)
    level, number = unused_name("_level", df.columns), unused_name("_number", df.columns)
    kind = df.schema[label].dataType
    schema = T.StructType([T.StructField(level, kind), T.StructField(number, T.DoubleType())])
    table = df.sparkSession.createDataFrame([(v, float(i)) for i, v in enumerate(known)], schema)
    return df.join(F.broadcast(table), F.col(f"`{label}`") == F.col(level), "left"), F.col(number)


def class_number(label: Column, levels: list | None) -> Column:
    if levels is None:
        return label.cast("double")
    out = None  # one flat choice: nested ones are as deep as the number of levels
    for i, level in enumerate(v for v in levels if v is not None):
        this = label == F.lit(level)
        out = F.when(this, float(i)) if out is None else out.when(this, float(i))
    return F.lit(None).cast("double") if out is None else out


def class_sums(confusion: DataFrame) -> DataFrame:
    """(class, hits, actual, predicted) of every class that occurs as an actual label. Predictions
    of no such class count for neither sum."""
    classes = confusion.select(F.col("label").alias("class")).distinct()
    inside = confusion.join(classes, F.col("prediction") == F.col("class"), "left_semi")
    hit = F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)
    actual = inside.groupBy(F.col("label").alias("class")).agg(F.sum("count").alias("actual"), F.sum(hit).alias("hits"))
    predicted = inside.groupBy(F.col("prediction").alias("class")).agg(F.sum("count").alias("predicted"))
    none = F.lit(0).cast("long")
    return classes.join(actual, "class", "left").join(predicted, "class", "left").select(
        "class", *[F.coalesce(c, none).alias(c) for c in ("hits", "actual", "predicted")])


def multiclass_metrics(confusion: DataFrame) -> dict[str, float]:
    """The metrics of a label with any number of classes, by sums per class; ``confusion`` is written."""
    total = confusion.agg(F.sum("count").alias("n")).first()["n"] or 0

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole == 0, F.lit(math.nan)).otherwise(part.cast("double") / whole)

    hits, actual, predicted, all_rows = F.col("hits"), F.col("actual"), F.col("predicted"), F.lit(total)
    row = class_sums(confusion).agg(
        F.sum(hits).alias("hits"), F.avg(share(2 * hits + all_rows - actual - predicted, all_rows)).alias("a"),
        F.avg(share(hits, predicted)).alias("p"), F.avg(share(hits, actual)).alias("r")).first()
    micro = ratio(row["hits"] or 0, total)
    means = [math.nan if row[k] is None else row[k] for k in "apr"]
    return {"accuracy": micro, "precision": micro, "recall": micro, **dict(zip(MULTICLASS_COLUMNS, means))}


def named_matrix(confusion: DataFrame) -> "ConfusionMatrix | None":
    """The matrix of a written table, or None if it has more than ``NAMED_CLASSES`` classes."""
    classes = confusion.select("label").distinct()
    if classes.limit(NAMED_CLASSES + 1).count() > NAMED_CLASSES:
        return None
    # predictions of classes that never occur may be many; they are one cell per class here
    known = classes.select(F.col("label").alias("class"))
    outside = F.when(F.col("class").isNotNull(), F.col("prediction")).otherwise(F.lit(float("nan")))
    cells = (confusion.join(known, F.col("prediction") == F.col("class"), "left")
             .groupBy("label", outside.alias("prediction")).agg(F.sum("count").alias("count")).collect())
    return ConfusionMatrix([(r["label"], r["prediction"], r["count"]) for r in cells])


class ConfusionMatrix:
    """Counts per (actual, predicted) class over the classes that occur as actual labels."""

    def __init__(self, cells: list[tuple[float, float, int]]):
        self.total = sum(n for _, _, n in cells)
        self.classes = sorted({a for a, _, _ in cells})
        self.count = {(a, p): n for a, p, n in cells if p in set(self.classes)}
        if len(self.classes) == 1:
            # one class only: show it inside a 0/1 matrix
            n = self.count.get((self.classes[0], self.classes[0]), 0)
            one = 1.0 if self.classes[0] > 0 else 0.0
            self.classes, self.count = [0.0, 1.0], {(one, one): n}

    def at(self, actual: float, predicted: float) -> int:
        return self.count.get((actual, predicted), 0)

    def named_cells(self) -> list[tuple[str, float]]:
        return [(f"predicted_class_as_{p}_actual_is_{a}", float(self.at(a, p)))
                for p in self.classes for a in self.classes]

    def binary(self) -> dict[str, float]:
        no, yes = self.classes
        tp, tn = self.at(yes, yes), self.at(no, no)
        fp, fn = self.at(no, yes), self.at(yes, no)
        return {"accuracy": ratio(tp + tn, tp + tn + fp + fn), "precision": ratio(tp, tp + fp),
                "recall": ratio(tp, tp + fn)}

    def multiclass(self) -> dict[str, float]:
        n, k = self.total, len(self.classes)
        hits = [self.at(c, c) for c in self.classes]
        actual = [sum(self.at(c, p) for p in self.classes) for c in self.classes]
        predicted = [sum(self.at(a, c) for a in self.classes) for c in self.classes]
        micro = ratio(sum(hits), n)
        per_class = [(ratio(2 * h + n - a - p, n), ratio(h, p), ratio(h, a))
                     for h, a, p in zip(hits, actual, predicted)]
        means = [sum(column) / k for column in zip(*per_class)] if k else [math.nan] * 3
        return {"accuracy": micro, "precision": micro, "recall": micro,
                **dict(zip(MULTICLASS_COLUMNS, means))}


def ratio(a: float, b: float) -> float:
    """Quotient as floating arithmetic gives it: nothing over nothing is NaN."""
    return a / b if b else math.nan


def roc_points(df: DataFrame, label: Column, score: Column) -> DataFrame:
    """One row per distinct score from the highest down: positives and negatives at the
    score and the running totals. Rows are first added up per score."""
    pairs = drop_missing(df.select(label.cast("double").alias("y"), score.cast("double").alias("s")),
                         ["y", "s"])
    per_score = pairs.groupBy("s").agg(F.count(F.when(F.col("y") > 0.5, 1)).alias("pos"),
                                       F.count(F.when(F.col("y") <= 0.5, 1)).alias("neg"))
    staged = stage_table(per_score, "scores")
    return running_totals(staged, "s", {"pos": "cum_pos", "neg": "cum_neg"}, descending=True)


def roc_curve(points: DataFrame) -> DataFrame:
    """(false_positive_rate, true_positive_rate) per score, with both corners."""
    totals = points.agg(F.max("cum_pos").alias("p"), F.max("cum_neg").alias("n")).first()
    rates = points.select(_rate("cum_neg", totals["n"]).alias(FPR),
                          _rate("cum_pos", totals["p"]).alias(TPR))
    corners = points.sparkSession.createDataFrame([(0.0, 0.0), (1.0, 1.0)], rates.schema)
    return rates.unionByName(corners)


def _rate(part: str, whole: int | None) -> Column:
    return F.col(part) / F.lit(float(whole)) if whole else F.lit(0.0)


def area_under_roc(points: DataFrame) -> DataFrame:
    """Exact area: every score adds a trapezoid over its own negatives."""
    sums = points.agg(
        F.sum(F.col("neg") * (F.col("cum_pos") * 2.0 - F.col("pos"))).alias("twice"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("p"), F.coalesce(F.sum("neg"), F.lit(0)).alias("n"))
    p, n = F.col("p").cast("double"), F.col("n").cast("double")
    return sums.select(F.when(n == 0, F.lit(1.0)).when(p == 0, F.lit(0.0))
                       .otherwise(F.col("twice") / (F.lit(2.0) * p * n)).alias("AUC"))


class ComputeModelStatistics(HasLabelCol, Transformer):
    """Metrics of a scored table, one row. Roles come from column metadata; for tables scored
    elsewhere name the columns and a metric (or "classification" / "regression").

    Labels may have any number of classes. The cells of the confusion matrix are columns of the
    result up to ``NAMED_CLASSES`` classes; ``confusionTable`` has them as rows in every case.
    """

    evaluationMetric = param("evaluationMetric", "metric to evaluate models with", as_str)
    scoredLabelsCol = param("scoredLabelsCol", "predicted label column", as_str)
    scoresCol = param("scoresCol", "score or raw prediction column", as_str)

    _defaults = {"evaluationMetric": ALL}

    def __init__(self, **values):
        super().__init__(**values)
        self.rocCurve: DataFrame | None = None
        self.confusionTable: DataFrame | None = None

    def _roles(self, schema: T.StructType) -> tuple[str | None, str, str]:
        model = roles.first_model(schema)
        if model:
            label = roles.column_in_role(schema, model, roles.LABEL_ROLE)
            return model, label or self._get("labelCol"), roles.score_kind(schema, model)
        if not self.isDefined("labelCol") or self.getEvaluationMetric() == ALL:
            raise ValueError("the table has no scored columns: transform it with a model, or name label and metric")
        return None, self.getLabelCol(), metric_kind(self.getEvaluationMetric())

    def _column(self, schema, model, own: str, role: str) -> str | None:
        if self.isSet(own):
            return self.getOrDefault(own)
        return roles.column_in_role(schema, model, role) if model else None

    def _transform(self, df: DataFrame) -> DataFrame:
        model, label, kind = self._roles(df.schema)
        if label is None:
            raise ValueError("the scored table has no label column")
        metric = self.getEvaluationMetric()
        if kind == roles.REGRESSION:
            return self._regression(df, model, label, metric)
        return self._classification(df, model, label, metric)

    def _regression(self, df, model, label, metric):
        if metric not in (ALL, ALL_REGRESSION) and metric not in REGRESSION_COLUMNS:
            raise ValueError(f"{metric} measures no regressor")
        scores = (self._column(df.schema, model, "scoresCol", roles.SCORES_ROLE)
                  or self._get("scoredLabelsCol"))
        table = regression_metrics(df, label, scores)
        return table if metric not in REGRESSION_COLUMNS else table.select(
            f"`{REGRESSION_COLUMNS[metric]}`")

    def _classification(self, df, model, label, metric):
        metric = "AUC" if metric == "areaUnderROC" else metric
        everything = metric in (ALL, ALL_CLASSIFICATION)
        if not everything and metric not in CLASSIFICATION_COLUMNS:
            raise ValueError(f"{metric} measures no classifier")
        predicted = self._column(df.schema, model, "scoredLabelsCol", roles.SCORED_LABELS_ROLE)
        scores = self._column(df.schema, model, "scoresCol", roles.SCORES_ROLE)
        levels = roles.get_levels(df.schema, label)
        if levels is not None and not _holds_values(df.schema[label].dataType, levels):
            levels = None                     # the column holds positions already
        self.confusionTable = stage_table(confusion_table(df, label, predicted, levels), "confusion")
        matrix = named_matrix(self.confusionTable)
        binary = matrix is not None and len(matrix.classes) == 2
        cells: list[tuple[str, object]] = [(EVALUATION_TYPE, roles.CLASSIFICATION)]
        if metric == "AUC":
            known = levels if levels is not None else matrix.classes if matrix else None
            if known is None or len(known) > 2:
                raise ValueError("AUC needs a label of two classes")
            cells.append(("AUC", self._auc(df, label, levels, scores, predicted)))
        else:
            values = (matrix.binary() if binary else matrix.multiclass() if matrix
                      else multiclass_metrics(self.confusionTable))
            if everything:
                cells += (matrix.named_cells() if matrix else []) + list(values.items())
                if binary:
                    cells.append(("AUC", self._auc(df, label, levels, scores, predicted)))
            else:
                cells.append((metric, values[metric]))
        schema = T.StructType([
            T.StructField(n, T.StringType() if isinstance(v, str) else T.DoubleType())
            for n, v in cells])
        return df.sparkSession.createDataFrame([tuple(v for _, v in cells)], schema)

    def _auc(self, df, label, levels, scores, predicted) -> float:
        name = scores or predicted
        column = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, VectorUDT):
            column = elements(column)[1]
        numbered, number = numbered_label(df, label, levels)
        points = roc_points(numbered, number, column)
        self.rocCurve = roc_curve(points)
        return area_under_roc(points).first()["AUC"]


def _holds_values(dtype: T.DataType, levels: list) -> bool:
    """Whether the label column holds level values; a column that was indexed before the
    training holds their positions."""
    text_levels = any(isinstance(v, str) for v in levels)
    return isinstance(dtype, T.StringType) or not text_levels
