"""Feature vectors from columns of mixed types."""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import CountVectorizerModel, HashingTF, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.base import (
    HasFeaturesCol, StageBase, as_bool, as_int, as_str_list, param, require_columns, unused_name,
)
from tablewright.functions.vectors import elements
from tablewright.functions import roles
from tablewright.functions.images import unsigned_bytes
from tablewright.functions.missing import TIMESTAMPS, drop_missing
from tablewright.operators.categorical import category_count, one_hot
from tablewright.sources.images import IMAGE_TYPE

# fixed values: hashing widths by learner family
DEFAULT_WIDTH, TREE_WIDTH = 262144, 4096
TIMESTAMP_SLOTS, DATE_SLOTS = 8, 5
# the characters that \\s stands for
WHITE_SPACE = " \t\n\x0b\f\r"
NUMBERS = (T.IntegerType, T.BooleanType, T.LongType, T.ByteType, T.ShortType, T.FloatType,
           T.DoubleType, T.DecimalType)


def timestamp_features(column: Column) -> Column:
    """Epoch milliseconds, year, day of week (Monday is 1), month, day, hour, minute, second."""
    t = column.cast("timestamp")
    parts = [F.unix_millis(t), F.year(t), F.weekday(t) + 1, F.month(t), F.dayofmonth(t),
             F.hour(t), F.minute(t), F.second(t)]
    return F.array(*[p.cast("double") for p in parts])


def date_features(column: Column) -> Column:
    """The first five of :func:`timestamp_features`."""
    return F.slice(timestamp_features(column), 1, DATE_SLOTS)


def text_tokens(columns: list[Column]) -> Column:
    """Tokens of several text columns in turn: lower case, cut at each white-space
    character; empty tokens at the end of a text do not count."""
    def one(text: Column) -> Column:
        trimmed = F.rtrim(F.lower(text), F.lit(WHITE_SPACE))
        return F.when(trimmed.isNull() | (trimmed == ""), F.array().cast("array<string>")
                      ).otherwise(F.split(trimmed, r"\s"))
    return one(columns[0]) if len(columns) == 1 else F.concat(*[one(c) for c in columns])


def image_features(image: Column) -> Column:
    """Height, width, then the stored bytes."""
    return F.concat(F.array(image["height"].cast("double"), image["width"].cast("double")),
                    F.transform(unsigned_bytes(image["bytes"]), lambda b: F.when(
                        b > 127, b - 256).otherwise(b).cast("double")))


def fast_vector_assemble(df: DataFrame, inputCols: list[str], outputCol: str) -> DataFrame:
    """Concatenate number and vector columns. Index columns must come first; of all slot
    attributes only theirs are kept, so that wide vectors stay light."""
    nominal, seen_other = [], None
    for name in inputCols:
        attribute = (df.schema[name].metadata or {}).get("ml_attr", {})
        if attribute.get("type") == "nominal" and not isinstance(df.schema[name].dataType, VectorUDT):
            if seen_other:
                raise ValueError(f"categorical column {name} must precede {seen_other}")
            nominal.append({**attribute, "name": name, "idx": len(nominal)})
        else:
            seen_other = seen_other or name
    assembled = VectorAssembler(inputCols=inputCols, outputCol=outputCol,
                                handleInvalid="error").transform(df)
    # the size follows from the inputs; the attribute list of a wide result is not read back
    meta: dict = {"num_attrs": sum(_width(df, name) for name in inputCols)}
    if nominal:
        meta["attrs"] = {"nominal": nominal}
    return assembled.withMetadata(outputCol, {"ml_attr": meta})


def _width(df: DataFrame, name: str) -> int:
    if not isinstance(df.schema[name].dataType, VectorUDT):
        return 1
    attributes = (df.schema[name].metadata or {}).get("ml_attr", {})
    return int(attributes["num_attrs"]) if "num_attrs" in attributes else _vector_size(df, name)


def _is_image(dtype: T.DataType) -> bool:
    return (isinstance(dtype, T.StructType)
            and [(f.name, f.dataType) for f in dtype] == [(f.name, f.dataType) for f in IMAGE_TYPE])


class AssembleFeatures(HasFeaturesCol, Estimator):
    """Turn columns into one vector by their types. Slots: index columns, then the other
    columns in table order, then the hashed words of all text columns together."""

    columnsToFeaturize = param("columnsToFeaturize", "columns to featurize", as_str_list)
    oneHotEncodeCategoricals = param("oneHotEncodeCategoricals", "one-hot encode categoricals",
                                     as_bool)
    numberOfFeatures = param("numberOfFeatures", "width to hash text columns to", as_int)
    allowImages = param("allowImages", "allow featurization of images", as_bool)

    _defaults = {"featuresCol": "features", "oneHotEncodeCategoricals": True,
                 "numberOfFeatures": DEFAULT_WIDTH, "allowImages": False}

    def _fit(self, df: DataFrame) -> "AssembleFeaturesModel":
        wanted = self.getColumnsToFeaturize()
        require_columns(df, wanted)
        texts, indexes, others = [], [], []
        for field in df.schema:
            if field.name not in wanted:
                continue
            dtype = field.dataType
            if roles.is_categorical(df.schema, field.name):
                indexes.append({"name": field.name, "kind": "index",
                                "type": dtype.simpleString(),
                                "count": category_count(df, field.name)})
                continue
            if isinstance(dtype, T.StringType):
                texts.append(field.name)
                continue
            entry = {"name": field.name, "type": dtype.simpleString()}
            if isinstance(dtype, NUMBERS):
                entry["kind"] = "number"
            elif isinstance(dtype, VectorUDT):
                entry.update(kind="vector", dims=_vector_size(df, field.name))
            elif isinstance(dtype, TIMESTAMPS):
                entry["kind"] = "timestamp"
            elif isinstance(dtype, T.DateType):
                entry["kind"] = "date"
            elif _is_image(dtype):
                if not self.getAllowImages():
                    raise TypeError(f"column {field.name} holds images: set allowImages to use them")
                entry.update(kind="image", dims=_image_size(df, field.name))
            else:
                raise TypeError(f"column {field.name} of type {dtype.simpleString()} has no numeric form")
            others.append(entry)
        width = self.getNumberOfFeatures()
        slots = _used_slots(df, texts, width) if texts else None
        return AssembleFeaturesModel(
            featuresCol=self.getFeaturesCol(), entries=indexes + others, texts=texts, width=width,
            slots=slots, counter=_slot_counter(slots) if slots else None,
            oneHot=self.getOneHotEncodeCategoricals())


def _vector_size(df: DataFrame, name: str) -> int:
    known = (df.schema[name].metadata or {}).get("ml_attr", {}).get("num_attrs")
    if known:
        return int(known)
    row = df.select(F.size(elements(F.col(f"`{name}`"))).alias("n")).filter("n >= 0").first()
    return row["n"] if row else 0


def _image_size(df: DataFrame, name: str) -> int:
    row = df.select(F.octet_length(F.col(f"`{name}`.bytes")).alias("n")).filter("n >= 0").first()
    return 2 + row["n"] if row else 2


def _used_slots(df: DataFrame, texts: list[str], width: int) -> list[int]:
    """Hash slots that occur: at most ``width`` numbers, found from the distinct words."""
    words = df.select(F.explode(text_tokens([F.col(f"`{t}`") for t in texts])).alias("w")).distinct()
    hashed = HashingTF(inputCol="t", outputCol="h", numFeatures=width).transform(
        words.select(F.array("w").alias("t")))
    found = hashed.select(F.explode(F.unwrap_udt("h")["indices"]).alias("i")).distinct()
    return sorted(r["i"] for r in found.collect())


def _slot_counter(slots: list[int]) -> CountVectorizerModel:
    """Counts the kept slot numbers as words of a fixed vocabulary."""
    return CountVectorizerModel.from_vocabulary([str(s) for s in slots], inputCol="slots",
                                                outputCol="selected")


def _keep_slots(df: DataFrame, hashed: str, selected: str, counter: CountVectorizerModel,
                size: int) -> DataFrame:
    """Hashed counts renumbered to the kept slots. The work per row follows the words of the
    row, not the number of kept slots."""
    names = unused_name("_slot_names", df.columns + [selected])
    pairs = F.arrays_zip(F.unwrap_udt(hashed)["indices"].alias("i"),
                         F.unwrap_udt(hashed)["values"].alias("n"))
    repeated = F.flatten(F.transform(pairs, lambda p: F.array_repeat(
        p["i"].cast("string"), p["n"].cast("int"))))
    out = counter.transform(df.withColumn(names, repeated), {
        counter.inputCol: names, counter.outputCol: selected})
    return out.withMetadata(selected, {"ml_attr": {"num_attrs": size}}).drop(names)


class AssembleFeaturesModel(HasFeaturesCol, Model):
    _nested_names = ("counter",)
    _state_names = ("entries", "texts", "width", "slots", "oneHot")
    _defaults = {"featuresCol": "features"}

    def _transform(self, df: DataFrame) -> DataFrame:
        for name in self.texts:
            if not isinstance(df.schema[name].dataType, T.StringType):
                raise TypeError(f"column {name} was text when the model was fitted "
                                "and is not now")
        temp, added = {}, {}
        taken = set(df.columns)
        for e in self.entries:
            if df.schema[e["name"]].dataType.simpleString() != e["type"]:
                raise TypeError(f"column {e['name']} was {e['type']} when the model was fitted "
                                "and is not now")
            tmp = unused_name(e["name"], taken)
            taken.add(tmp)
            temp[e["name"]] = tmp
            added[tmp] = _numeric_form(F.col(f"`{e['name']}`"), e["kind"])
        work = df.withColumns(added) if added else df
        work = drop_missing(work, [temp[e["name"]] for e in self.entries])
        inputs, dropped = [], list(temp.values())
        encode = {}
        for e in self.entries:
            tmp = temp[e["name"]]
            if e["kind"] == "index":
                meta = df.schema[e["name"]].metadata or {}
                work = work.withMetadata(tmp, {"ml_attr": meta.get("ml_attr", {"type": "nominal"})})
                if self.oneHot:
                    target = unused_name(f"indicators_{e['name']}", taken)
                    taken.add(target)
                    encode[tmp] = target
                    dropped.append(target)
                    inputs.append(target)
                    continue
            elif e["kind"] != "number":
                dims = e.get("dims") or (TIMESTAMP_SLOTS if e["kind"] == "timestamp" else DATE_SLOTS)
                work = work.withMetadata(tmp, {"ml_attr": {"num_attrs": dims}})
            inputs.append(tmp)
        if encode:
            counts = {temp[e["name"]]: e["count"] for e in self.entries if e["kind"] == "index"}
            work = one_hot(work, encode, counts)
        if self.texts and self.slots:
            names = []
            for prefix in ("tokens", "hashed", "selected"):
                names.append(unused_name(prefix, taken))
                taken.add(names[-1])
            tokens, hashed, selected = names
            work = work.withColumn(tokens, text_tokens([F.col(f"`{t}`") for t in self.texts]))
            work = HashingTF(inputCol=tokens, outputCol=hashed, numFeatures=self.width).transform(work)
            work = _keep_slots(work, hashed, selected, self.counter, len(self.slots)).drop(tokens, hashed)
            inputs.append(selected)
            dropped.append(selected)
        return fast_vector_assemble(work, inputs, self.getFeaturesCol()).drop(*dropped)


def _numeric_form(column: Column, kind: str) -> Column:
    if kind in ("number", "index"):
        return column.cast("double")
    if kind == "vector":
        return column
    forms = {"timestamp": timestamp_features, "date": date_features, "image": image_features}
    # null stays null, so that the row is dropped with the other missing ones
    return F.when(column.isNotNull(), array_to_vector(forms[kind](column)))


class Featurize(StageBase, Estimator):
    """One :class:`AssembleFeatures` per output column."""

    featureColumns = param("featureColumns", "map of output column to input columns")
    oneHotEncodeCategoricals = param("oneHotEncodeCategoricals", "one-hot encode categoricals",
                                     as_bool)
    numberOfFeatures = param("numberOfFeatures", "width to hash text columns to", as_int)
    allowImages = param("allowImages", "allow featurization of images", as_bool)

    _defaults = {"oneHotEncodeCategoricals": True, "numberOfFeatures": DEFAULT_WIDTH,
                 "allowImages": False}

    def _fit(self, df: DataFrame) -> PipelineModel:
        return Pipeline(stages=[
            AssembleFeatures(columnsToFeaturize=list(columns), featuresCol=target,
                             oneHotEncodeCategoricals=self.getOneHotEncodeCategoricals(),
                             numberOfFeatures=self.getNumberOfFeatures(),
                             allowImages=self.getAllowImages())
            for target, columns in self.getFeatureColumns().items()]).fit(df)
