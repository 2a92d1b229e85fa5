"""Image stages."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.base import HasInputCol, HasOutputCol, as_bool, param, require_columns
from tablewright.functions import images as K
from tablewright.functions.arrays import bind

STEPS = {
    "resize": lambda m, p: K.resize(m, p["height"], p["width"]),
    "crop": lambda m, p: K.crop(m, p["x"], p["y"], p["height"], p["width"]),
    "colorformat": lambda m, p: K.color_format(m, p["format"]),
    "flip": lambda m, p: K.flip(m, p["flipCode"]),
    "blur": lambda m, p: K.blur(m, p["height"], p["width"]),
    "threshold": lambda m, p: K.threshold(m, p["threshold"], p["maxVal"], p["type"]),
    "gaussiankernel": lambda m, p: K.gaussian(m, p["appertureSize"], p["sigma"]),
}


def _is_pixels(df: DataFrame, name: str) -> bool:
    dtype = df.schema[name].dataType
    if not isinstance(dtype, T.StructType):
        raise TypeError("the input column holds no images")
    if "pixels" in dtype.fieldNames():
        return True
    if "bytes" in dtype.fieldNames() and "type" in dtype.fieldNames():
        return False
    raise TypeError("the input column holds no images")


def pixels_of(df: DataFrame, name: str) -> Column:
    """Pixel form of an image column of either shape."""
    column = F.col(f"`{name}`")
    return column if _is_pixels(df, name) else K.from_image_struct(column)


class ImageTransformer(HasInputCol, HasOutputCol, Transformer):
    """Ordered image steps on one column; the output has the shape of the input column
    (pixels or bytes). A null image stays null."""

    stages = param("stages", "image transformation steps")

    _defaults = {"inputCol": "image", "stages": []}

    def setStages(self, value: list[dict]):
        for step in value:
            if step.get("action") not in STEPS:
                raise ValueError(f"unsupported transformation {step.get('action')!r}")
        return self._set(stages=[dict(s) for s in value])

    def _add(self, action: str, **values):
        return self.setStages(self.getStages() + [{"action": action, **values}])

    def resize(self, height: int, width: int):
        if height < 0 or width < 0:
            raise ValueError("a size must not be negative")
        return self._add("resize", height=height, width=width)

    def crop(self, x: int, y: int, height: int, width: int):
        if min(x, y, height, width) < 0:
            raise ValueError("a cut must not have negative values")
        return self._add("crop", x=x, y=y, height=height, width=width)

    def colorFormat(self, format: int):
        return self._add("colorformat", format=format)

    def blur(self, height: float, width: float):
        return self._add("blur", height=height, width=width)

    def threshold(self, threshold: float, maxVal: float, thresholdType: int):
        return self._add("threshold", threshold=threshold, maxVal=maxVal, type=thresholdType)

    def flip(self, flipCode: int):
        return self._add("flip", flipCode=flipCode)

    def gaussianKernel(self, appertureSize: int, sigma: float):
        return self._add("gaussiankernel", appertureSize=appertureSize, sigma=float(sigma))

    def _transform(self, df: DataFrame) -> DataFrame:
        name = self.getInputCol()
        require_columns(df, [name])
        source = F.col(f"`{name}`")
        image = pixels_of(df, name)
        for step in self.getStages():
            image = STEPS[step["action"]](image, step)
        if not _is_pixels(df, name):
            image = bind(image, lambda m: K.to_image_struct(source["path"], m))
        return df.withColumn(self.getOutputCol(), F.when(source.isNotNull(), image))


class UnrollImage(HasInputCol, HasOutputCol, Transformer):
    """Image to a vector, channel by channel."""

    _defaults = {"inputCol": "image"}

    def _transform(self, df: DataFrame) -> DataFrame:
        require_columns(df, [self.getInputCol()])
        return df.withColumn(self.getOutputCol(), F.when(
            F.col(f"`{self.getInputCol()}`").isNotNull(),
            array_to_vector(K.unroll(pixels_of(df, self.getInputCol())))))


class ImageSetAugmenter(HasInputCol, HasOutputCol, Transformer):
    """Every row, plus a copy per flip that is switched on. One scan: the variants of a row
    are made next to it."""

    flipLeftRight = param("flipLeftRight", "add left-right flipped copies", as_bool)
    flipUpDown = param("flipUpDown", "add up-down flipped copies", as_bool)

    _defaults = {"inputCol": "image", "flipLeftRight": True, "flipUpDown": False}

    def _transform(self, df: DataFrame) -> DataFrame:
        name, target = self.getInputCol(), self.getOutputCol()
        require_columns(df, [name])
        source = F.col(f"`{name}`")
        codes = [1] * self.getFlipLeftRight() + [0] * self.getFlipUpDown()

        def flipped(code: int) -> Column:
            image = K.flip(pixels_of(df, name), code)
            if not _is_pixels(df, name):
                image = bind(image, lambda m: K.to_image_struct(source["path"], m))
            return F.when(source.isNotNull(), image)

        same = source if not _is_pixels(df, name) else K.pixel_image(
            source["height"], source["width"], source["channels"], source["pixels"])
        variants = F.array(F.when(source.isNotNull(), same), *[flipped(c) for c in codes])
        if target in df.columns:
            others = [F.col(f"`{c}`") for c in df.columns if c != target]
            return df.select(*others, F.explode(variants).alias(target)).select(
                *[f"`{c}`" for c in df.columns])
        return df.select("*", F.explode(variants).alias(target))
