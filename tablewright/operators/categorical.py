"""Value indexing, the way back, and indicator columns."""

from __future__ import annotations

import json
import math

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.base import HasInputCol, HasOutputCol, require_columns, unused_name
from tablewright.functions import roles
from tablewright.plans.lookup import lookup_join
from tablewright.plans.ordering import dense_positions
from tablewright.plans.staging import stage_table

LEVEL_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
               "string": T.StringType(), "boolean": T.BooleanType()}
# up to this many levels are kept in the model and the metadata; more live in a table
KEPT_LEVELS = 50_000
# up to this many levels the index is an expression; more are looked up by a join
EXPRESSION_LEVELS = 32


def _level_type(dtype: T.DataType) -> T.DataType:
    if dtype.simpleString() not in LEVEL_TYPES:
        raise TypeError(f"a {dtype.simpleString()} column cannot be indexed")
    return LEVEL_TYPES[dtype.simpleString()]


def _is_nan(value) -> bool:
    return isinstance(value, float) and math.isnan(value)


def sort_levels(values: list) -> list:
    """Ascending with null first and NaN last."""
    plain = sorted(v for v in values if v is not None and not _is_nan(v))
    return ([None] * any(v is None for v in values) + plain
            + [float("nan")] * any(_is_nan(v) for v in values))


class ValueIndexer(HasInputCol, HasOutputCol, Estimator):
    """Learn the sorted distinct values of a column."""

    def _fit(self, df: DataFrame) -> "ValueIndexerModel":
        name = self.getInputCol()
        require_columns(df, [name])
        dtype = _level_type(df.schema[name].dataType)
        counts = df.groupBy(F.col(f"`{name}`").alias("level")).agg(F.count(F.lit(1)).alias("n"))
        first = counts.select("level").limit(KEPT_LEVELS + 1).collect()
        model = ValueIndexerModel(inputCol=name, outputCol=self.getOutputCol(),
                                  dataType=dtype.simpleString())
        if len(first) <= KEPT_LEVELS:
            return model.setLevels(sort_levels([r[0] for r in first]))
        staged = stage_table(counts, "levels")
        known = staged.filter(F.col("level").isNotNull())
        model.levelTable = stage_table(dense_positions(known, "level", "position"), "level-index")
        model.tableCount = known.count()
        model.nullExists = staged.filter(F.col("level").isNull()).limit(1).count() > 0
        return model


class ValueIndexerModel(HasInputCol, HasOutputCol, Model):
    """Value to index. Null and NaN get the number of levels; unseen values get the same,
    or one more when there was a null level."""

    _state_names = ("levels", "dataType", "tableCount", "nullExists")
    # saved with the model
    _nested_names = ("levelTable",)

    def setLevels(self, levels: list) -> "ValueIndexerModel":
        self.levels = list(levels)
        return self

    def getLevels(self) -> list | None:
        return self.levels

    def setDataType(self, dtype) -> "ValueIndexerModel":
        self.dataType = dtype if isinstance(dtype, str) else dtype.simpleString()
        return self

    def table_folder(self) -> str:
        """Where the level table lies: inside the saved model once it was loaded from there."""
        return self.levelTable.inputFiles()[0].rsplit("/", 1)[0]

    def level_table(self, spark) -> DataFrame:
        """Levels and positions as a table."""
        if self.levelTable is not None:
            return self.levelTable.select("level", "position")
        known = [(v, i) for i, v in enumerate(v for v in self.levels if v is not None)]
        schema = T.StructType([T.StructField("level", LEVEL_TYPES[self.dataType]),
                               T.StructField("position", T.LongType())])
        return spark.createDataFrame(known, schema)

    def _transform(self, df: DataFrame) -> DataFrame:
        name, target = self.getInputCol(), self.getOutputCol()
        require_columns(df, [name])
        dtype = LEVEL_TYPES[self.dataType]
        source = F.col(f"`{name}`").cast(dtype)
        if self.levels is not None:
            known = [v for v in self.levels if v is not None]
            count, has_null = len(known), len(known) != len(self.levels)
        else:
            count, has_null = self.tableCount, self.nullExists
        unseen = count + 1 if has_null else count
        missing = source.isNull()
        if self.dataType == "double":
            missing = missing | F.isnan(source)
        if self.levels is not None and count <= EXPRESSION_LEVELS:
            plain = [v for v in known if not _is_nan(v)]
            index = F.when(missing, F.lit(count)).otherwise(_index_tree(source, plain, unseen))
            out = df.withColumn(target, index.cast("int"))
        else:
            key = unused_name("_level", df.columns)
            position = unused_name("_position", df.columns)
            rows = unused_name("_rows", df.columns)
            if self.levels is not None:
                table, count_col, small = self.level_table(df.sparkSession), None, True
            else:
                table, count_col, small = self.levelTable, rows, False
                table = table.withColumnRenamed("n", rows)
            table = table.withColumnsRenamed({"level": key, "position": position})
            joined = lookup_join(df.withColumn(key, source), table, [key], "left",
                                 count_col=count_col, small=small)
            missing_key = F.col(key).isNull()
            if self.dataType == "double":
                missing_key = missing_key | F.isnan(key)
            index = F.when(missing_key, F.lit(count)).otherwise(
                F.coalesce(F.col(position), F.lit(unseen)))
            kept = [c for c in df.columns if c != target]
            order = df.columns if target in df.columns else df.columns + [target]
            out = joined.withColumn(target, index.cast("int")).select(
                *[f"`{c}`" for c in order if c in kept or c == target])
        if self.levels is not None:
            return roles.set_levels(out, target, self.levels, dtype)
        return roles.set_level_table(out, target, self.table_folder(), count, has_null, dtype)


def _index_tree(column: Column, levels: list, unseen: int) -> Column:
    """Search over sorted levels as nested conditions."""
    def build(lo: int, hi: int) -> Column:
        if lo > hi:
            return F.lit(unseen)
        mid = (lo + hi) // 2
        if lo == hi:
            return F.when(column == F.lit(levels[mid]), F.lit(mid)).otherwise(F.lit(unseen))
        return (F.when(column == F.lit(levels[mid]), F.lit(mid))
                .when(column < F.lit(levels[mid]), build(lo, mid - 1))
                .otherwise(build(mid + 1, hi)))
    if len(levels) and isinstance(levels[0], bool):
        out = F.lit(unseen)
        for i, v in enumerate(levels):
            out = F.when(column == F.lit(v), F.lit(i)).otherwise(out)
        return out
    return build(0, len(levels) - 1)


class IndexToValue(HasInputCol, HasOutputCol, Transformer):
    """Index back to value from the levels in the column's metadata. The null index gives
    null; any other index outside the levels is an error."""

    def _transform(self, df: DataFrame) -> DataFrame:
        name, target = self.getInputCol(), self.getOutputCol()
        require_columns(df, [name])
        info = roles.categorical_info(df.schema, name)
        if info is None:
            raise ValueError(f"column {name} has no levels to turn indexes back with")
        dtype, count = LEVEL_TYPES[info["type"]], info["count"]
        index = F.col(f"`{name}`").cast("int")
        wrong = F.raise_error(F.concat(
            F.lit("no value for index "), index.cast("string"),
            F.lit(f": the column has {count} levels")))
        if info["levels"] is not None:
            values = _level_array(info["levels"], dtype)
            value = F.element_at(values, index + 1)
            source = df
        else:
            position, level = unused_name("_position", df.columns), unused_name("_level", df.columns)
            rows = unused_name("_rows", df.columns)
            table = df.sparkSession.read.parquet(info["table"]).select(
                F.col("position").cast("int").alias(position), F.col("level").alias(level),
                F.col("n").alias(rows))
            source = lookup_join(df.withColumn(position, index), table, [position], "left",
                                 count_col=rows, small=False)
            value = F.col(level)
        result = F.when((index >= 0) & (index < count), value).when(index.isNull(), F.lit(None))
        if info["null_exists"]:
            result = result.when(index == count, F.lit(None))
        out = source.withColumn(target, result.otherwise(wrong).cast(dtype))
        order = df.columns if target in df.columns else df.columns + [target]
        meta = {k: v for k, v in (df.schema[target].metadata or {}).items()
                if k not in (roles.TAG, "ml_attr")} if target in df.columns else {}
        return out.select(*[f"`{c}`" for c in order]).withMetadata(target, meta)


def _level_array(levels: list, dtype: T.DataType) -> Column:
    """The levels as one constant array."""
    if any(_is_nan(v) for v in levels):
        return F.array(*[F.lit(v).cast(dtype) for v in levels])
    return F.from_json(F.lit(json.dumps(levels)), T.ArrayType(dtype))


def category_count(df: DataFrame, column: str) -> int:
    """Number of categories from the metadata, else the largest index plus one."""
    info = roles.categorical_info(df.schema, column)
    if info:
        return info["count"]
    top = df.agg(F.max(F.col(f"`{column}`")).alias("m")).first()["m"]
    return int(top) + 1 if top is not None else 0


def one_hot(df: DataFrame, columns: dict[str, str], counts: dict[str, int],
            drop_last: bool = True) -> DataFrame:
    """Indicator vectors for index columns. With ``drop_last`` the last category, and any
    index beyond the categories (null, unseen), is the zero vector."""
    clipped, work = {}, df
    for name in columns:
        tmp = unused_name(f"_clip_{name}", work.columns)
        size = max(1, counts[name])
        top = size - 1 if drop_last else size
        attribute = {"ml_attr": {"name": tmp, "type": "nominal",
                                 "vals": [str(i) for i in range(max(2, size + (not drop_last)))]}}
        work = work.withColumn(tmp, F.least(F.col(f"`{name}`").cast("double"), F.lit(float(top)))
                               ).withMetadata(tmp, attribute)
        clipped[name] = tmp
    encoder = OneHotEncoder(inputCols=list(clipped.values()), outputCols=list(columns.values()),
                            dropLast=True)
    return encoder.fit(work).transform(work).drop(*clipped.values())
