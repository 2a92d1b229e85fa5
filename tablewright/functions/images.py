"""Image kernels as array expressions.

An image is a struct ``height, width, channels, pixels``: pixels are unsigned numbers, row by
row, channels of a pixel next to each other in blue-green-red order. Every kernel maps output
positions to input positions inside one expression: no shuffle, no Python.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablewright.functions.arrays import bind

# fixed values: channel weights (out of 2^14) of the blue-green-red to gray conversion,
# color codes, threshold types, and the small Gaussian kernels used when sigma is not positive
GRAY_BLUE, GRAY_GREEN, GRAY_RED, GRAY_SHIFT = 1868, 9617, 4899, 14
BGR_TO_RGB, BGR_TO_GRAY, RGB_TO_GRAY = 4, 6, 7
BINARY, BINARY_INVERTED, TRUNCATE, TO_ZERO, TO_ZERO_INVERTED = 0, 1, 2, 3, 4
SMALL_GAUSSIAN = {
    1: [1.0],
    3: [0.25, 0.5, 0.25],
    5: [0.0625, 0.25, 0.375, 0.25, 0.0625],
    7: [0.03125, 0.109375, 0.21875, 0.28125, 0.21875, 0.109375, 0.03125],
}


def unsigned_bytes(data: Column) -> Column:
    """Bytes as numbers 0 to 255."""
    text = F.decode(data, "ISO-8859-1")
    return F.when(F.octet_length(data) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(F.split(text, ""), lambda c: F.ascii(c)))


def to_bytes(numbers: Column) -> Column:
    """Numbers 0 to 255 as bytes."""
    return F.encode(F.array_join(F.transform(numbers, lambda n: F.char(n.cast("long"))), ""),
                    "ISO-8859-1")


def pixel_image(height: Column, width: Column, channels: Column, pixels: Column) -> Column:
    return F.struct(height.cast("int").alias("height"), width.cast("int").alias("width"),
                    channels.cast("int").alias("channels"),
                    pixels.cast("array<int>").alias("pixels"))


def from_image_struct(image: Column) -> Column:
    """Image row (path, height, width, type, bytes) to pixels; the type code counts channels
    in steps of eight."""
    return pixel_image(image["height"], image["width"], F.floor(image["type"] / 8) + 1,
                       unsigned_bytes(image["bytes"]))


def to_image_struct(path: Column, pixel: Column) -> Column:
    return F.struct(path.alias("path"), pixel["height"].alias("height"),
                    pixel["width"].alias("width"),
                    ((pixel["channels"] - 1) * 8).alias("type"),
                    to_bytes(pixel["pixels"]).alias("bytes"))


def _positions(count: Column) -> Column:
    return F.when(count > 0, F.sequence(F.lit(0), count.cast("int") - 1)
                  ).otherwise(F.array().cast("array<int>"))


def _render(image: Column, height: Column, width: Column, channels: Column,
            value: Callable[[Column, Column, Column], Column]) -> Column:
    """New pixels from ``value(row, column, channel)``."""
    def at(i: Column) -> Column:
        return value(F.floor(i / (width * channels)).cast("int"),
                     F.floor(i / channels).cast("int") % width, i % channels)
    return pixel_image(height, width, channels,
                       F.transform(_positions(height * width * channels), at))


def _pixel(image: Column, y: Column, x: Column, c: Column) -> Column:
    return F.element_at(image["pixels"],
                        ((y * image["width"] + x) * image["channels"] + c + 1).cast("int"))


def _clamp(v: Column, top: Column) -> Column:
    return F.greatest(F.lit(0), F.least(v, top))


def resize(image: Column, height: int, width: int) -> Column:
    """Bilinear: centers of output pixels are mapped onto the input. Which rows and columns an output
    pixel mixes, and their shares, are worked out once per row and column of the output."""
    def axis(size: Column, wanted: int) -> Column:
        def place(out: Column) -> Column:
            s = (out + 0.5) * (size.cast("double") / F.lit(float(wanted))) - 0.5
            low = F.floor(s).cast("int")
            return F.struct(_clamp(low, size - 1).alias("low"), _clamp(low + 1, size - 1).alias("high"),
                            (s - low).alias("share"))
        return F.transform(_positions(F.lit(wanted)), place)

    def body(m: Column) -> Column:
        def rendered(rows: Column, columns: Column) -> Column:
            def value(y, x, c):
                ya, yb, fy = (rows[y][f] for f in ("low", "high", "share"))
                xa, xb, fx = (columns[x][f] for f in ("low", "high", "share"))
                mixed = ((1 - fy) * ((1 - fx) * _pixel(m, ya, xa, c) + fx * _pixel(m, ya, xb, c))
                         + fy * ((1 - fx) * _pixel(m, yb, xa, c) + fx * _pixel(m, yb, xb, c)))
                return F.floor(mixed + 0.5).cast("int")
            return _render(m, F.lit(height), F.lit(width), m["channels"], value)
        return bind(axis(m["height"], height), lambda rows: bind(
            axis(m["width"], width), lambda columns: rendered(rows, columns)))
    if height < 0 or width < 0:
        raise ValueError("width and height should be nonnegative")
    return bind(image, body)


def crop(image: Column, x: int, y: int, height: int, width: int) -> Column:
    """A window of the image; a window that leaves the image is an error."""
    if min(x, y, height, width) < 0:
        raise ValueError("crop values should be nonnegative")

    def body(m: Column) -> Column:
        fits = (F.lit(y + height) <= m["height"]) & (F.lit(x + width) <= m["width"])
        cut = _render(m, F.lit(height), F.lit(width), m["channels"],
                      lambda r, k, c: _pixel(m, r + y, k + x, c))
        return F.when(fits, cut).otherwise(F.raise_error(F.lit("crop window leaves the image")))
    return bind(image, body)


def color_format(image: Column, code: int) -> Column:
    """Gray from blue-green-red (or red-green-blue) pixels, or swapped channels."""
    if code not in (BGR_TO_RGB, BGR_TO_GRAY, RGB_TO_GRAY):
        raise ValueError(f"unsupported color code {code}")

    def body(m: Column) -> Column:
        if code == BGR_TO_RGB:
            return _render(m, m["height"], m["width"], m["channels"],
                           lambda y, x, c: _pixel(m, y, x, 2 - c))
        first, last = (GRAY_BLUE, GRAY_RED) if code == BGR_TO_GRAY else (GRAY_RED, GRAY_BLUE)

        def gray(y, x, c):
            total = (_pixel(m, y, x, F.lit(0)) * first + _pixel(m, y, x, F.lit(1)) * GRAY_GREEN
                     + _pixel(m, y, x, F.lit(2)) * last + (1 << (GRAY_SHIFT - 1)))
            return F.shiftright(total, GRAY_SHIFT)
        return _render(m, m["height"], m["width"], F.lit(1), gray)
    return bind(image, body)


def flip(image: Column, code: int) -> Column:
    """0 up-down, above 0 left-right, below 0 both."""
    def body(m: Column) -> Column:
        def value(y, x, c):
            row = m["height"] - 1 - y if code <= 0 else y
            col = m["width"] - 1 - x if code != 0 else x
            return _pixel(m, row, col, c)
        return _render(m, m["height"], m["width"], m["channels"], value)
    return bind(image, body)


def _mirror(i: Column, n: Column) -> Column:
    """Reflect a position beyond the border without repeating the border pixel."""
    period = F.greatest(F.lit(1), (n - 1) * 2)
    j = F.pmod(i, period)
    return F.when(n == 1, F.lit(0)).when(j >= n, period - j).otherwise(j)


def _weighted(image: Column, row_weights: list[float], column_weights: list[float]) -> Column:
    """Separable filter around each pixel, rounded half to even and kept in 0..255."""
    dy, dx = len(row_weights) // 2, len(column_weights) // 2

    def body(m: Column) -> Column:
        def value(y, x, c):
            terms = []
            for a, wa in enumerate(row_weights):
                for b, wb in enumerate(column_weights):
                    terms.append(_pixel(m, _mirror(y + (a - dy), m["height"]),
                                        _mirror(x + (b - dx), m["width"]), c) * F.lit(wa * wb))
            total = terms[0]
            for t in terms[1:]:
                total = total + t
            return _clamp(F.rint(total).cast("int"), F.lit(255))
        return _render(m, m["height"], m["width"], m["channels"], value)
    return bind(image, body)


def blur(image: Column, height: float, width: float) -> Column:
    """Box filter. The box is as wide as ``height`` and as high as ``width``, the order in
    which the sizes are taken by the stage this follows."""
    box_width, box_height = int(height), int(width)
    if box_width < 1 or box_height < 1:
        raise ValueError("the box must be at least one pixel")
    dy, dx = box_height // 2, box_width // 2

    def along(size: int, pixel: Callable[[Column], Column]) -> Column:
        """Sum over the box's cells along one axis."""
        return F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), F.lit(0), lambda total, k: total + pixel(k))

    def body(m: Column) -> Column:
        # sums along the rows first, then along the columns of these
        flat = _render(m, m["height"], m["width"], m["channels"], lambda y, x, c: along(
            box_width, lambda k: _pixel(m, y, _mirror(x + k - dx, m["width"]), c)))
        return bind(flat, lambda f: _render(m, m["height"], m["width"], m["channels"], lambda y, x, c: F.rint(along(
            box_height, lambda k: _pixel(f, _mirror(y + k - dy, m["height"]), x, c))
            / F.lit(float(box_height * box_width))).cast("int")))
    return bind(image, body)


def gaussian_weights(size: int, sigma: float) -> list[float]:
    if sigma <= 0 and size in SMALL_GAUSSIAN:
        return SMALL_GAUSSIAN[size]
    spread = sigma if sigma > 0 else 0.3 * ((size - 1) * 0.5 - 1) + 0.8
    raw = [math.exp(-((i - (size - 1) / 2) ** 2) / (2 * spread * spread)) for i in range(size)]
    return [r / sum(raw) for r in raw]


def gaussian(image: Column, size: int, sigma: float) -> Column:
    """Gaussian weights along the vertical axis."""
    if size < 1 or size % 2 == 0:
        raise ValueError("the aperture must be a positive odd number")
    return _weighted(image, gaussian_weights(size, sigma), [1.0])


def threshold(image: Column, limit: float, max_value: float, kind: int) -> Column:
    high = F.lit(max(0, min(255, int(round(max_value)))))
    cut = F.lit(math.floor(limit))

    def one(v: Column) -> Column:
        above = v > cut
        return {BINARY: F.when(above, high).otherwise(0),
                BINARY_INVERTED: F.when(above, F.lit(0)).otherwise(high),
                TRUNCATE: F.when(above, _clamp(cut, F.lit(255))).otherwise(v),
                TO_ZERO: F.when(above, v).otherwise(0),
                TO_ZERO_INVERTED: F.when(above, F.lit(0)).otherwise(v)}[kind]
    if kind not in (BINARY, BINARY_INVERTED, TRUNCATE, TO_ZERO, TO_ZERO_INVERTED):
        raise ValueError(f"unknown threshold type {kind}")
    return bind(image, lambda m: pixel_image(m["height"], m["width"], m["channels"],
                                             F.transform(m["pixels"], one)))


def unroll(image: Column) -> Column:
    """Channel by channel, each row by row, as an array of doubles."""
    def body(m: Column) -> Column:
        area = m["height"] * m["width"]
        ok = (area >= 0) & (area < 100_000_000) & (F.size(m["pixels"]) == area * m["channels"])
        values = F.transform(_positions(area * m["channels"]), lambda i: F.element_at(
            m["pixels"], ((i % area) * m["channels"] + F.floor(i / area) + 1).cast("int")
        ).cast("double"))
        return F.when(ok, values).otherwise(
            F.raise_error(F.lit("image has incorrect dimensions or number of bytes")))
    return bind(image, body)
