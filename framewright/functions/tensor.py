"""Tensor arithmetic on array columns, flattened in row-major order, inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Channel means and deviations of the usual image standardisation.
IMAGE_MEAN = (0.485, 0.456, 0.406)
IMAGE_STD = (0.229, 0.224, 0.225)


def _div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("int")


def _by_index(size: int, value) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), value)


def hwc_to_chw(x: Column, h: int, w: int, c: int) -> Column:
    return _by_index(h * w * c, lambda p: F.get(x, (p % (h * w)) * c + _div(p, h * w)))


def flip_channels(x: Column, h: int, w: int, c: int = 3) -> Column:
    """BGR to RGB and back, HWC."""
    return _by_index(h * w * c, lambda p: F.get(x, p - p % c + (c - 1) - p % c))


def to_unit_range(x: Column, kind: str = "double") -> Column:
    """0..255 to -1..1, in doubles, or with every step rounded to `kind` "float" or "bfloat16"."""
    to = {"double": lambda v: v, "float": lambda v: v.cast("float"), "bfloat16": to_bfloat16}[kind]
    return F.transform(x, lambda v: to(to(to(to(v.cast("double")) / F.lit(255.0)) * F.lit(2.0)) - F.lit(1.0)))


def to_bfloat16(v: Column) -> Column:
    """A number rounded to eight significant bits, halves to even, as a double; Spark has no such type."""
    scale = F.pow(F.lit(2.0), 7 - F.floor(F.log2(F.abs(v))))
    return F.when(v == 0, F.lit(0.0)).otherwise(F.rint(v * scale) / scale)


def unsqueeze(shape: Column, axis: int) -> Column:
    """A shape with an axis of one more at `axis`; the flat values stay as they are."""
    return F.concat(F.slice(shape, 1, axis), F.array(F.lit(1)), F.slice(shape, axis + 1, F.size(shape)))


def standardise(x: Column, h: int, w: int, mean=IMAGE_MEAN, std=IMAGE_STD) -> Column:
    """-1..1, CHW, to 0..1 and then to each channel's deviations from its mean."""
    means, stds = F.array(*map(F.lit, mean)), F.array(*map(F.lit, std))
    return F.transform(x, lambda v, p: ((v + 1) / 2 - F.get(means, _div(p, h * w))) / F.get(stds, _div(p, h * w)))


def concat_channels(*tensors: Column) -> Column:
    """Channels after channels; CHW makes this a plain concatenation."""
    return F.concat(*tensors)


def crop_size(height: int, width: int, ratio: tuple[int, int] = (16, 9)) -> tuple[int, int]:
    """The largest centred part of the ratio, each side cut down to whole pixels."""
    a, b = ratio
    return (height, int(height * a / b)) if width * b > height * a else (int(width / (a / b)), width)


def centre_crop(x: Column, h: int, w: int, to_h: int, to_w: int) -> Column:
    """One channel; the offset is rounded, halves to even."""
    top, left = round((h - to_h) / 2), round((w - to_w) / 2)
    return _by_index(to_h * to_w, lambda p: F.get(x, (_div(p, to_w) + top) * w + p % to_w + left))


def resize(x: Column, h: int, w: int, to_h: int, to_w: int, align_corners: bool = False) -> Column:
    """Bilinear, one channel, no antialiasing: pixel centres at halves, or corners aligned."""

    def source(at: Column, size: int, to: int) -> Column:
        if align_corners:
            return at * F.lit((size - 1) / (to - 1) if to > 1 else 0.0)
        return F.greatest(F.lit(0.0), (at + 0.5) * F.lit(size / to) - 0.5)

    def pixel(p: Column) -> Column:
        y, z = source(_div(p, to_w), h, to_h), source(p % to_w, w, to_w)
        y0, z0 = F.least(F.floor(y).cast("int"), F.lit(h - 1)), F.least(F.floor(z).cast("int"), F.lit(w - 1))
        y1, z1 = F.least(y0 + 1, F.lit(h - 1)), F.least(z0 + 1, F.lit(w - 1))
        dy, dz = y - y0, z - z0
        top = F.get(x, y0 * w + z0) * (1 - dz) + F.get(x, y0 * w + z1) * dz
        low = F.get(x, y1 * w + z0) * (1 - dz) + F.get(x, y1 * w + z1) * dz
        return top * (1 - dy) + low * dy

    return _by_index(to_h * to_w, pixel)


def weighted(x: Column, rows: Sequence[Sequence[float]], columns: Sequence[Sequence[float]]) -> Column:
    """A resize, one channel, by stated weights: those of the source's rows for each new row, and of its columns."""
    h, w, to_w = len(rows[0]), len(columns[0]), len(columns)
    by_row, by_column = (F.array(*[F.lit(float(v)) for line in m for v in line]) for m in (rows, columns))

    def pixel(p: Column) -> Column:
        def along(y: Column) -> Column:
            return F.aggregate(F.sequence(F.lit(0), F.lit(w - 1)), F.lit(0.0), lambda a, j: a + F.get(by_column, p % to_w * w + j) * F.get(x, y * w + j))

        return F.aggregate(F.sequence(F.lit(0), F.lit(h - 1)), F.lit(0.0), lambda a, i: a + F.get(by_row, _div(p, to_w) * h + i) * along(i))

    return _by_index(len(rows) * to_w, pixel)


#: Fixed values of the fixed-point kernel: bits of a weight, and what its two roundings take off.
WEIGHT_BITS, ROW_SHIFT, COLUMN_SHIFT = 11, 4, 16


def fixed_point(x: Column, h: int, w: int, to_h: int, to_w: int) -> Column:
    """Bilinear resize of bytes, one channel, in whole numbers: weights of WEIGHT_BITS bits, halves of a pixel as centres."""
    def source(at: Column, size: int, to: int) -> tuple[Column, Column, Column]:
        place = ((at + 0.5) * F.lit(size / to) - 0.5).cast("float")
        low = F.floor(place).cast("int")
        part = F.when((low < 0) | (low >= size - 1), F.lit(0.0)).otherwise((place - low).cast("float").cast("double"))
        low = F.greatest(F.lit(0), F.least(low, F.lit(size - 1)))
        return low, F.least(low + 1, F.lit(size - 1)), part

    def share(part: Column) -> Column:
        return F.rint(part * (1 << WEIGHT_BITS)).cast("int")

    def pixel(p: Column) -> Column:
        y0, y1, dy = source(_div(p, to_w), h, to_h)
        z0, z1, dz = source(p % to_w, w, to_w)

        def line(y: Column) -> Column:
            return F.get(x, y * w + z0) * share(1 - dz) + F.get(x, y * w + z1) * share(dz)

        def part(y: Column, weight: Column) -> Column:
            return F.shiftright(share(weight) * F.shiftright(line(y), ROW_SHIFT), COLUMN_SHIFT)

        return F.shiftright(part(y0, 1 - dy) + part(y1, dy) + 2, 2)

    return _by_index(to_h * to_w, pixel)


def depth_to_bytes(x: Column) -> Column:
    """One image's depth to 0..255: deviations from the median over their mean size, then min-max, truncated.

    An image whose pixels are all alike gives zeros.
    """
    def let(value: Column, body) -> Column:
        return F.transform(F.array(value), body)[0]

    def median(s: Column) -> Column:
        n = F.size(s)
        return (F.get(s, _div(n - 1, 2)) + F.get(s, _div(n, 2))) / 2

    def spread(m: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda a, v: a + F.abs(v - m)) / F.size(x)

    def scaled(d: Column) -> Column:
        return let(F.array_min(d), lambda low: let(F.array_max(d), lambda high: F.transform(
            d, lambda v: F.floor((v - low) / (high - low + F.lit(1e-8)) * 255).cast("long"))))

    return let(median(F.sort_array(x)), lambda m: let(spread(m), lambda s: let(
        F.transform(x, lambda v: F.when(s > 0, (v - m) / s).otherwise(F.lit(0.0))), scaled)))


def frame_seconds(frame: Column, fps: int, stride: int = 1, exact: bool = False) -> Column:
    """Frame number over the effective whole rate ``fps // stride``; `exact` divides by the true rate."""
    if stride < 1 or fps // stride < 1:
        raise ValueError("the stride leaves less than one frame a second")
    return frame.cast("double") / F.lit(float(fps if exact else fps // stride))
