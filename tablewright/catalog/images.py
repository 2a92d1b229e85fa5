"""Queries G: image stages and batched scoring, on a picture per embedding."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablewright.catalog.common import (
    IMAGES_SQL, embedding_images, image_sql, joined, query, table,
)
from tablewright.functions import images as K
from tablewright.operators.apply import UDFTransformer
from tablewright.operators.images import ImageSetAugmenter, ImageTransformer, UnrollImage
from tablewright.operators.scoring import BatchScorer, ImageFeaturizer, arg_max, dense_model


def _run(spark, sf, stage):
    out = stage.setParams(inputCol="image", outputCol="out").transform(embedding_images(spark, sf))
    return out.select("vec_id", joined(F.col("out.pixels")).alias("pixels"))


# position i of an 8 x 8 x 3 picture: row i//24, column (i//3)%8, channel i%3
@query("g1_stage_chain", image_sql(
    "px[((7 - (i // 12 + 2)) * 8 + (i // 3) % 4 + 1) * 3 + i % 3 + 1]", 48))
def g1_stage_chain(spark, sf):
    return _run(spark, sf, ImageTransformer().flip(0).crop(1, 2, 4, 4))


@query("g2_crop", image_sql("px[(((i // 15) + 1) * 8 + (i // 3) % 5 + 2) * 3 + i % 3 + 1]", 90))
def g2_crop(spark, sf):
    return _run(spark, sf, ImageTransformer().crop(2, 1, 6, 5))


def _bilinear(height: int, width: int) -> str:
    """Position i of the resized picture."""
    def axis(out, wanted):
        s = f"((({out}) + 0.5) * (8.0::DOUBLE / {wanted}.0::DOUBLE) - 0.5)"
        low = f"CAST(floor({s}) AS BIGINT)"
        return low, f"({s} - floor({s}))"
    y, fy = axis(f"i // {width * 3}", height)
    x, fx = axis(f"(i // 3) % {width}", width)

    def p(dy, dx):
        return (f"px[(greatest(0, least({y} + {dy}, 7)) * 8 + greatest(0, least({x} + {dx}, 7))) * 3"
                f" + i % 3 + 1]")
    return (f"CAST(floor((1 - {fy}) * ((1 - {fx}) * {p(0, 0)} + {fx} * {p(0, 1)})"
            f" + {fy} * ((1 - {fx}) * {p(1, 0)} + {fx} * {p(1, 1)}) + 0.5) AS BIGINT)")


@query("g2_resize_down", image_sql(_bilinear(4, 5), 60))
def g2_resize_down(spark, sf):
    return _run(spark, sf, ImageTransformer().resize(4, 5))


@query("g2_resize_up", image_sql(_bilinear(11, 13), 429))
def g2_resize_up(spark, sf):
    return _run(spark, sf, ImageTransformer().resize(11, 13))


@query("g3_gray", image_sql(
    "(px[i * 3 + 1] * 1868 + px[i * 3 + 2] * 9617 + px[i * 3 + 3] * 4899 + 8192) >> 14", 64))
def g3_gray(spark, sf):
    return _run(spark, sf, ImageTransformer().colorFormat(K.BGR_TO_GRAY))


@query("g4_flip_up_down", image_sql("px[((7 - i // 24) * 8 + (i // 3) % 8) * 3 + i % 3 + 1]", 192))
def g4_flip_up_down(spark, sf):
    return _run(spark, sf, ImageTransformer().flip(0))


@query("g4_flip_left_right", image_sql("px[((i // 24) * 8 + 7 - (i // 3) % 8) * 3 + i % 3 + 1]", 192))
def g4_flip_left_right(spark, sf):
    return _run(spark, sf, ImageTransformer().flip(1))


@query("g4_flip_both", image_sql("px[((7 - i // 24) * 8 + 7 - (i // 3) % 8) * 3 + i % 3 + 1]", 192))
def g4_flip_both(spark, sf):
    return _run(spark, sf, ImageTransformer().flip(-1))


def _mirror(e: str) -> str:
    """Position within 0..7, reflected at the borders (for steps of up to 7)."""
    return f"(7 - abs(7 - abs({e})))"


def _neighbour(dy: str, dx: str) -> str:
    return (f"px[({_mirror(f'(i // 24) + {dy}')} * 8 + {_mirror(f'((i // 3) % 8) + {dx}')}) * 3"
            f" + i % 3 + 1]")


# the box is 3 wide and 2 high
@query("g5_box_blur", image_sql("CAST(round_even((" + " + ".join(
    _neighbour(str(a - 1), str(b - 1)) for a in range(2) for b in range(3)) + ") / 6.0::DOUBLE, 0) AS BIGINT)", 192))
def g5_box_blur(spark, sf):
    return _run(spark, sf, ImageTransformer().blur(3, 2))


_GAUSS = K.gaussian_weights(5, 1.5)


@query("g5_gaussian", image_sql("CAST(round_even(" + " + ".join(
    f"{_neighbour(str(a - 2), '0')} * {w!r}::DOUBLE" for a, w in enumerate(_GAUSS)) + ", 0) AS BIGINT)", 192))
def g5_gaussian(spark, sf):
    return _run(spark, sf, ImageTransformer().gaussianKernel(5, 1.5))


_THRESHOLDS = {
    "g6_threshold_binary": (K.BINARY, "CASE WHEN px[i + 1] > 99 THEN 200 ELSE 0 END"),
    "g6_threshold_inverted": (K.BINARY_INVERTED, "CASE WHEN px[i + 1] > 99 THEN 0 ELSE 200 END"),
    "g6_threshold_truncate": (K.TRUNCATE, "least(px[i + 1], 99)"),
    "g6_threshold_to_zero": (K.TO_ZERO, "CASE WHEN px[i + 1] > 99 THEN px[i + 1] ELSE 0 END"),
    "g6_threshold_to_zero_inverted": (K.TO_ZERO_INVERTED, "CASE WHEN px[i + 1] > 99 THEN 0 ELSE px[i + 1] END"),
}


def _threshold(kind):
    return lambda spark, sf: _run(spark, sf, ImageTransformer().threshold(99.0, 200.0, kind))


for _name, (_kind, _sql) in _THRESHOLDS.items():
    query(_name, image_sql(_sql, 192))(_threshold(_kind))


@query("g7_unroll", image_sql("px[(i % 64) * 3 + i // 64 + 1]", 192))
def g7_unroll(spark, sf):
    out = UnrollImage(inputCol="image", outputCol="v").transform(embedding_images(spark, sf))
    return out.select("vec_id", joined(vector_to_array("v")).alias("pixels"))


@query("g8_augment", f"""WITH {IMAGES_SQL}
SELECT vec_id, array_to_string(px, ',') AS pixels FROM img
UNION ALL
SELECT vec_id, array_to_string([px[((i // 24) * 8 + 7 - (i // 3) % 8) * 3 + i % 3 + 1] for i in range(192)], ',')
FROM img
UNION ALL
SELECT vec_id, array_to_string([px[((7 - i // 24) * 8 + (i // 3) % 8) * 3 + i % 3 + 1] for i in range(192)], ',')
FROM img""")
def g8_augment(spark, sf):
    return _run(spark, sf, ImageSetAugmenter(flipUpDown=True))


@query("g9_image_function", image_sql("255 - px[i + 1]", 192))
def g9_image_function(spark, sf):
    @F.pandas_udf("array<int>")
    def negative(pixels: pd.Series) -> pd.Series:
        return pixels.map(lambda p: 255 - np.asarray(p))
    df = embedding_images(spark, sf).select("vec_id", F.col("image.pixels").alias("p"))
    out = UDFTransformer(inputCol="p", outputCol="out", udf=negative).transform(df)
    return out.select("vec_id", joined(F.col("out")).alias("pixels"))


# ---- scoring: weights in eighths, so that sums are exact in any order ----

def _weight(i, j):
    return ((i * 7 + j * 3) % 11 - 5) / 8.0


def _layer(name, inputs, outputs, activation):
    return {"name": name, "activation": activation, "bias": [j / 4.0 for j in range(outputs)],
            "weights": [[_weight(i, j) for i in range(inputs)] for j in range(outputs)]}


def _layer_sql(values: str, inputs: int, outputs: int) -> str:
    return (f"[list_sum([{values}[i + 1] * (((i * 7 + j * 3) % 11 - 5) / 8.0::DOUBLE) "
            f"for i in range({inputs})]) + j / 4.0::DOUBLE for j in range({outputs})]")


DENSE_SQL = f"""dense AS (SELECT vec_id, {_layer_sql('e', 64, 6)} AS h
  FROM (SELECT vec_id, [CAST(x AS DOUBLE) for x in embedding] AS e FROM embeddings))"""


def _model():
    return dense_model([_layer("hidden", 64, 6, "relu"), _layer("out", 6, 3, "identity")])


@query("g10_batch_score", f"""WITH {DENSE_SQL},
active AS (SELECT vec_id, [greatest(v, 0.0) for v in h] AS h FROM dense),
scored AS (SELECT vec_id, {_layer_sql('h', 6, 3)} AS s FROM active)
SELECT vec_id, round(s[1], 6) AS s0, round(s[2], 6) AS s1, round(s[3], 6) AS s2 FROM scored""")
def g10_batch_score(spark, sf):
    df = table(spark, sf, "embeddings").select("vec_id", "embedding")
    out = BatchScorer(inputCol="embedding", outputCol="s", model=_model(), outputNodeIndex=1,
                      miniBatchSize=100).transform(df)
    s = vector_to_array("s")
    return out.select("vec_id", *[F.round(s[i], 6).alias(f"s{i}") for i in range(3)])


@query("g11_image_featurizer", f"""WITH {IMAGES_SQL},
small AS (SELECT vec_id, [{_bilinear(4, 4)} for i in range(48)] AS r FROM img),
flat AS (SELECT vec_id, [CAST(r[(i % 16) * 3 + i // 16 + 1] AS DOUBLE) for i in range(48)] AS e FROM small),
hidden AS (SELECT vec_id, [greatest(v, 0.0) for v in {_layer_sql('e', 48, 5)}] AS h FROM flat)
SELECT vec_id, round(h[1], 6) AS f0, round(h[3], 6) AS f2, round(h[5], 6) AS f4 FROM hidden""")
def g11_image_featurizer(spark, sf):
    model = dense_model([_layer("hidden", 48, 5, "relu"), _layer("out", 5, 2, "softmax")],
                        imageSize=[4, 4])
    out = ImageFeaturizer(inputCol="image", outputCol="f", model=model, cutOutputLayers=1,
                          miniBatchSize=100).transform(embedding_images(spark, sf))
    f = vector_to_array("f")
    return out.select("vec_id", *[F.round(f[i], 6).alias(f"f{i}") for i in (0, 2, 4)])


@query("g12_arg_max", f"""WITH {DENSE_SQL}
SELECT vec_id, CAST(list_position(h, list_max(h)) - 1 AS INTEGER) AS class FROM dense""")
def g12_arg_max(spark, sf):
    df = table(spark, sf, "embeddings").select("vec_id", "embedding")
    model = dense_model([_layer("hidden", 64, 6, "identity")])
    out = BatchScorer(inputCol="embedding", outputCol="s", model=model, outputNodeName="hidden",
                      miniBatchSize=100).transform(df)
    return out.select("vec_id", arg_max(vector_to_array("s")).alias("class"))
