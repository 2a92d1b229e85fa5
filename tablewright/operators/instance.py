"""Loss of every scored row."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.base import StageBase
from tablewright.functions.vectors import elements
from tablewright.functions import roles

EPSILON = 1e-15


def l1_loss(label: Column, score: Column) -> Column:
    return F.abs(label.cast("double") - score)


def l2_loss(label: Column, score: Column) -> Column:
    return l1_loss(label, score) * l1_loss(label, score)


def log_loss(class_index: Column, probabilities: Column, classes: int) -> Column:
    """-ln of the probability at the class, kept within [EPSILON, 1]; a class beyond the
    known ones costs -ln(EPSILON)."""
    p = F.try_element_at(probabilities, class_index.cast("int") + 1)
    return F.when(class_index < F.lit(classes),
                  -F.log(F.least(F.lit(1.0), F.greatest(F.lit(EPSILON), p)))
                  ).otherwise(-F.log(F.lit(EPSILON)))


class ComputePerInstanceStatistics(StageBase, Transformer):
    """Adds ``L1_loss`` and ``L2_loss``, or ``log_loss``, by the kind of the scored table."""

    def _transform(self, df: DataFrame) -> DataFrame:
        model = roles.first_model(df.schema)
        if model is None:
            raise ValueError("the table has no scored columns: transform it with a model first")
        label = roles.column_in_role(df.schema, model, roles.LABEL_ROLE)
        if roles.score_kind(df.schema, model) == roles.REGRESSION:
            score = F.col(roles.column_in_role(df.schema, model, roles.SCORES_ROLE))
            y = F.col(f"`{label}`")
            return df.withColumns({"L1_loss": l1_loss(y, score), "L2_loss": l2_loss(y, score)})
        levels = roles.get_levels(df.schema, label)
        if levels:
            classes = max(2, len(levels))
        else:
            classes = df.agg(F.count_distinct(F.col(f"`{label}`").cast("double")).alias("n")
                             ).first()["n"]
        predicted = roles.column_in_role(df.schema, model, roles.SCORED_LABELS_ROLE)
        probabilities = roles.column_in_role(df.schema, model, roles.PROBABILITIES_ROLE)
        return df.withColumn("log_loss", log_loss(
            F.col(predicted), elements(F.col(probabilities)), classes))
