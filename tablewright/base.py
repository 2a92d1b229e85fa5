"""Common ground of all stages: declared params, keyword construction and save/load.

A stage declares its params with :func:`param`; getters and setters come for free.
Three kinds of content are saved: params and ``_state_names`` as JSON, and
``_nested_names`` (stages, lists of stages, DataFrames) in sub-folders.
"""

from __future__ import annotations

import base64

from pyspark import cloudpickle
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame, SparkSession

as_str = TypeConverters.toString
as_int = TypeConverters.toInt
as_float = TypeConverters.toFloat
as_bool = TypeConverters.toBoolean
as_str_list = TypeConverters.toListString


def param(name: str, doc: str, converter=None) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=converter)


class _Contents:
    """Names kept on the instance that hold content which is not a JSON value."""

    _nested_names: tuple[str, ...] = ()
    _state_names: tuple[str, ...] = ()
    _function_names: tuple[str, ...] = ()


class StageBase(Params, _Contents, MLReadable, MLWritable):
    """Params with keyword construction, generated accessors and persistence."""

    _defaults: dict = {}

    def __init_subclass__(cls, **kwargs):
        super().__init_subclass__(**kwargs)
        for name, value in list(vars(cls).items()):
            if isinstance(value, Param):
                cap = name[0].upper() + name[1:]
                if not hasattr(cls, "set" + cap):
                    setattr(cls, "set" + cap, _setter(name))
                if not hasattr(cls, "get" + cap):
                    setattr(cls, "get" + cap, _getter(name))

    def __init__(self, **values):
        super().__init__()
        for name in self._nested_names + self._state_names + self._function_names:
            setattr(self, name, None)
        defaults = {}
        for klass in reversed(type(self).__mro__):
            defaults.update(vars(klass).get("_defaults", {}))
        if "outputCol" not in defaults and self.hasParam("outputCol"):
            defaults["outputCol"] = self.uid + "_output"
        self._setDefault(**defaults)
        self.setParams(**values)

    def setParams(self, **values):
        free = self._nested_names + self._state_names + self._function_names
        for name, value in values.items():
            setter = getattr(self, "set" + name[0].upper() + name[1:], None)
            if name in free:
                setter(value) if setter and value is not None else setattr(self, name, value)
            elif self.hasParam(name):
                if value is not None:
                    setter(value) if setter else self._set(**{name: value})
            else:
                raise TypeError(f"{type(self).__name__} has no parameter {name!r}")
        return self

    def _get(self, name):
        return self.getOrDefault(name) if self.isDefined(self.getParam(name)) else None

    def write(self) -> MLWriter:
        return _StageWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StageReader(cls)


def _setter(name):
    def set_value(self, value):
        self._set(**{name: value})
        return self
    return set_value


def _getter(name):
    def get_value(self):
        return self.getOrDefault(name)
    return get_value


class _StageWriter(MLWriter):
    def __init__(self, stage: StageBase):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        stage = self.stage
        layout: dict[str, object] = {}
        for name in stage._nested_names:
            value = getattr(stage, name)
            if value is None:
                layout[name] = None
            elif isinstance(value, DataFrame):
                layout[name] = "table"
                value.write.parquet(f"{path}/nested/{name}")
            elif isinstance(value, (list, tuple)):
                layout[name] = len(value)
                for i, item in enumerate(value):
                    item.write().save(f"{path}/nested/{name}/{i}")
            else:
                layout[name] = "stage"
                value.write().save(f"{path}/nested/{name}")
        functions = {
            name: base64.b64encode(cloudpickle.dumps(getattr(stage, name))).decode("ascii")
            for name in stage._function_names
        }
        state = {name: getattr(stage, name) for name in stage._state_names}
        DefaultParamsWriter.saveMetadata(
            stage, path, self.sparkSession,
            extraMetadata={"nested": layout, "state": state, "functions": functions},
        )


class _StageReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        spark: SparkSession = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        stage = self.cls()
        stage._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(stage, meta)
        load = DefaultParamsReader.loadParamsInstance
        for name, kind in meta["nested"].items():
            where = f"{path}/nested/{name}"
            if kind is None:
                value = None
            elif kind == "table":
                value = spark.read.parquet(where)
            elif kind == "stage":
                value = load(where, spark)
            else:
                value = [load(f"{where}/{i}", spark) for i in range(kind)]
            setattr(stage, name, value)
        for name, value in meta["state"].items():
            setattr(stage, name, value)
        for name, text in meta["functions"].items():
            setattr(stage, name, cloudpickle.loads(base64.b64decode(text)))
        return stage


class HasInputCol(StageBase):
    inputCol = param("inputCol", "name of the input column", as_str)


class HasOutputCol(StageBase):
    outputCol = param("outputCol", "name of the output column", as_str)


class HasInputCols(StageBase):
    inputCols = param("inputCols", "names of the input columns", as_str_list)


class HasOutputCols(StageBase):
    outputCols = param("outputCols", "names of the output columns", as_str_list)


class HasLabelCol(StageBase):
    labelCol = param("labelCol", "name of the label column", as_str)


class HasFeaturesCol(StageBase):
    featuresCol = param("featuresCol", "name of the features column", as_str)


def require_columns(df: DataFrame, names) -> None:
    """Raise when a requested column is absent, naming all of the absent ones."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"DataFrame does not contain specified columns: {', '.join(missing)}")


def unused_name(prefix: str, taken) -> str:
    """A column name that is not taken: prefix, prefix_2, prefix_3 and so on."""
    name, n = prefix, 1
    while name in taken:
        n += 1
        name = f"{prefix}_{n}"
    return name
