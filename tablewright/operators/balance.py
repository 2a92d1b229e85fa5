"""Class weights."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.base import HasInputCol, HasOutputCol, as_bool, param, require_columns
from tablewright.plans.lookup import is_small, lookup_join
from tablewright.plans.staging import stage_table

COUNT = "_count"


class ClassBalancer(HasInputCol, HasOutputCol, Estimator):
    """Learn weight = rows of the largest class / rows of the class."""

    broadcastJoin = param("broadcastJoin", "broadcast the weights when they are few", as_bool)

    _defaults = {"outputCol": "weight", "broadcastJoin": True}

    def _fit(self, df: DataFrame) -> "ClassBalancerModel":
        name = self.getInputCol()
        require_columns(df, [name])
        counts = stage_table(df.groupBy(f"`{name}`").agg(F.count(F.lit(1)).alias(COUNT)), "weights")
        top = counts.agg(F.max(COUNT).alias("m")).first()["m"]
        weights = counts.select(
            name, (F.lit(float(top or 0)) / F.col(COUNT)).alias(self.getOutputCol()), COUNT)
        return ClassBalancerModel(inputCol=name, outputCol=self.getOutputCol(),
                                  broadcastJoin=self.getBroadcastJoin(), weights=weights)


class ClassBalancerModel(HasInputCol, HasOutputCol, Model):
    broadcastJoin = param("broadcastJoin", "broadcast the weights when they are few", as_bool)

    _nested_names = ("weights",)
    _defaults = {"outputCol": "weight", "broadcastJoin": True}

    def _transform(self, df: DataFrame) -> DataFrame:
        """Inner join: rows without a label drop out."""
        name = self.getInputCol()
        require_columns(df, [name])
        small = self.getBroadcastJoin() and is_small(self.weights)
        joined = lookup_join(df, self.weights, [name], "inner", count_col=COUNT, small=small)
        return joined.select(*[f"`{c}`" for c in df.columns], f"`{self.getOutputCol()}`")
