"""Batched model scoring."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, predict_batch_udf
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.base import (
    HasInputCol, HasOutputCol, as_int, as_str, as_str_list, param, require_columns, unused_name,
)
from tablewright.functions.vectors import elements
from tablewright.operators.images import ImageTransformer, UnrollImage

ACTIVATIONS = {
    "identity": lambda x: x,
    "relu": lambda x: np.maximum(x, 0.0),
    "sigmoid": lambda x: 1.0 / (1.0 + np.exp(-x)),
    "softmax": lambda x: (lambda e: e / e.sum(axis=1, keepdims=True))(
        np.exp(x - x.max(axis=1, keepdims=True))),
}


def dense_model(layers: list[dict], imageSize: list[int] | None = None) -> dict:
    """A feed-forward model as plain values. A layer has ``name``, ``weights`` (outputs x
    inputs), ``bias`` and ``activation``; ``imageSize`` is the (height, width) it takes."""
    out = []
    for layer in layers:
        activation = layer.get("activation", "identity")
        if activation not in ACTIVATIONS:
            raise ValueError(f"unknown activation {activation!r}")
        weights = np.asarray(layer["weights"], dtype=float)
        bias = np.asarray(layer.get("bias", np.zeros(len(weights))), dtype=float)
        out.append({"name": layer["name"], "weights": weights.tolist(), "bias": bias.tolist(),
                    "activation": activation})
    return {"layers": out, "imageSize": list(imageSize) if imageSize else None}


def _cut(model: dict, name: str | None, index: int | None) -> list[dict]:
    """Layers up to and with the wanted output."""
    names = [layer["name"] for layer in model["layers"]]
    if (name is None) == (index is None):
        raise ValueError("name the output node either by outputNodeName or by outputNodeIndex")
    if name is not None:
        if name not in names:
            raise ValueError(f"model has no node {name!r}, only {names}")
        return model["layers"][:names.index(name) + 1]
    if not 0 <= index < len(names):
        raise ValueError(f"node index {index} is outside the model's {len(names)} nodes")
    return model["layers"][:index + 1]


class BatchScorer(HasInputCol, HasOutputCol, Transformer):
    """Apply a model to arrays or vectors of numbers, ``miniBatchSize`` rows per call.

    The model reaches each executor once as a broadcast value; it must fit one executor's
    memory, as any model that is evaluated there.
    """

    outputNodeName = param("outputNodeName", "name of the output node", as_str)
    outputNodeIndex = param("outputNodeIndex", "index of the output node", as_int)
    miniBatchSize = param("miniBatchSize", "rows per model call", as_int)

    _state_names = ("model",)
    _defaults = {"miniBatchSize": 10}

    def setModel(self, model: dict):
        self.model = model
        return self

    def getModel(self) -> dict:
        return self.model

    def _values(self, df: DataFrame) -> Column:
        name = self.getInputCol()
        require_columns(df, [name])
        dtype, column = df.schema[name].dataType, F.col(f"`{name}`")
        if isinstance(dtype, VectorUDT):
            return elements(column, "float32")
        if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, (T.FloatType, T.DoubleType)):
            return column.cast("array<float>")
        raise TypeError(f"input column {name} must be an array of float or double, or a vector, "
                        f"not {dtype.simpleString()}")

    def _transform(self, df: DataFrame) -> DataFrame:
        values = self._values(df)
        layers = _cut(self.model, self._get("outputNodeName"), self._get("outputNodeIndex"))
        size = len(layers[0]["weights"][0])
        shared = df.sparkSession.sparkContext.broadcast(layers)

        def make_predict():
            ready = [(np.asarray(layer["weights"]).T, np.asarray(layer["bias"]),
                      ACTIVATIONS[layer["activation"]]) for layer in shared.value]

            def predict(inputs: np.ndarray) -> np.ndarray:
                x = np.asarray(inputs, dtype=np.float64)
                for weights, bias, activation in ready:
                    x = activation(x @ weights + bias)
                return x
            return predict

        scored = predict_batch_udf(
            make_predict, return_type=T.ArrayType(T.DoubleType()),
            batch_size=self.getMiniBatchSize(), input_tensor_shapes=[[size]])
        # a null input keeps its row and gets a null output
        given, scores = unused_name("_given", df.columns), unused_name("_scores", df.columns)
        # The always-true condition keeps the optimizer from merging a large input
        # expression into the function call, where lambda variables stop Spark from
        # recognizing the call again.
        work = df.withColumn(given, F.when(F.spark_partition_id() >= 0, values))
        filled = F.coalesce(F.col(given), F.array_repeat(F.lit(0.0).cast("float"), size))
        work = work.withColumn(scores, scored(filled))
        out = work.withColumn(self.getOutputCol(), array_to_vector(F.col(scores)))
        out = out.withColumn(self.getOutputCol(), F.when(
            F.col(given).isNotNull(), F.col(self.getOutputCol())))
        return out.drop(given, scores)


class ImageFeaturizer(HasInputCol, HasOutputCol, Transformer):
    """Resize to the model's input, unroll, and take the output ``cutOutputLayers`` nodes from
    the end. ``layerNames`` lists nodes from the output backwards; by default all of them."""

    cutOutputLayers = param("cutOutputLayers", "layers to cut off the end", as_int)
    layerNames = param("layerNames", "nodes to choose from, output first", as_str_list)
    miniBatchSize = param("miniBatchSize", "rows per model call", as_int)

    _state_names = ("model",)
    _defaults = {"inputCol": "image", "cutOutputLayers": 1, "miniBatchSize": 10}

    def setModel(self, model: dict):
        self.model = model
        return self

    def getModel(self) -> dict:
        return self.model

    def setCutOutputLayers(self, value: int):
        if value < 0:
            raise ValueError("cutOutputLayers must not be negative")
        return self._set(cutOutputLayers=value)

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self._get("layerNames") or [layer["name"] for layer in reversed(self.model["layers"])]
        height, width = self.model["imageSize"]
        resized = unused_name("resized", df.columns)
        unrolled = unused_name("unrolled", df.columns + [resized])
        work = ImageTransformer(inputCol=self.getInputCol(), outputCol=resized).resize(
            height, width).transform(df)
        work = UnrollImage(inputCol=resized, outputCol=unrolled).transform(work).drop(resized)
        scorer = BatchScorer(inputCol=unrolled, outputCol=self.getOutputCol(), model=self.model,
                             outputNodeName=names[self.getCutOutputLayers()],
                             miniBatchSize=self.getMiniBatchSize())
        return scorer.transform(work).drop(unrolled)


def arg_max(scores: Column) -> Column:
    """Zero-based position of the largest score, the first of equals."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")
