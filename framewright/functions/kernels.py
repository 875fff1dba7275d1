"""Image kernels on byte arrays, for frames whose pixels are binary."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .tensor import COLUMN_SHIFT, ROW_SHIFT, WEIGHT_BITS, crop_size


def bilinear_weights(size: int, to: int, mode: str) -> np.ndarray:
    """to x size weights of a one-dimensional bilinear resize."""
    at = np.arange(to)
    if mode == "antialias" and to < size:  # a triangle as wide as the step between results
        scale = size / to
        centre = (at + 0.5) * scale
        w = np.clip(1 - np.abs((np.arange(size)[None, :] + 0.5 - centre[:, None]) / scale), 0, None)
        return w / w.sum(axis=1, keepdims=True)
    if mode == "corners":
        x = at * ((size - 1) / (to - 1) if to > 1 else 0.0)
    else:
        x = np.clip((at + 0.5) * (size / to) - 0.5, 0, size - 1)
    low = np.minimum(x.astype(int), size - 1)
    w = np.zeros((to, size))
    np.add.at(w, (at, low), 1 - (x - low))
    np.add.at(w, (at, np.minimum(low + 1, size - 1)), x - low)
    return w


def _fixed(frame: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bytes in whole numbers, as `tensor.fixed_point`."""
    def source(size: int, to: int):
        place = ((np.arange(to) + 0.5) * (size / to) - 0.5).astype(np.float32)
        low = np.floor(place).astype(int)
        part = np.where((low < 0) | (low >= size - 1), 0, (place - low).astype(np.float32)).astype(np.float64)
        low = np.clip(low, 0, size - 1)
        return low, np.minimum(low + 1, size - 1), np.rint((1 - part) * (1 << WEIGHT_BITS)).astype(int), np.rint(part * (1 << WEIGHT_BITS)).astype(int)

    y0, y1, up, down = source(frame.shape[0], height)
    x0, x1, left, right = source(frame.shape[1], width)
    lines = frame.astype(int)[:, x0] * left[:, None] + frame.astype(int)[:, x1] * right[:, None] >> ROW_SHIFT
    out = (up[:, None, None] * lines[y0] >> COLUMN_SHIFT) + (down[:, None, None] * lines[y1] >> COLUMN_SHIFT) + 2 >> 2
    return out.astype(np.uint8)


def resize(frame: np.ndarray, height: int, width: int, mode: str = "half") -> np.ndarray:
    """Bilinear resize of (h, w, c): `half` pixel centres, aligned `corners`, `antialias` when shrinking, or `fixed` point."""
    if mode == "fixed":
        return _fixed(frame, height, width)
    out = np.einsum("yh,hwc->ywc", bilinear_weights(frame.shape[0], height, mode), frame.astype(np.float64))
    out = np.einsum("xw,ywc->yxc", bilinear_weights(frame.shape[1], width, mode), out)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8) if frame.dtype == np.uint8 else out


def crop_centre(frame: np.ndarray, height: int, width: int) -> np.ndarray:
    top, left = round((frame.shape[0] - height) / 2), round((frame.shape[1] - width) / 2)
    return frame[top : top + height, left : left + width]


def resized_pixels(pixels: Column, height: Column, width: Column, channels: Column, to: tuple[int, int], mode: str = "half", crop: tuple[int, int] | None = None) -> Column:
    """Binary frames resized, after a centred crop to the ratio `crop` if there is one."""
    @F.arrow_udf("binary")
    def run(data: pa.Array, h: pa.Array, w: pa.Array, c: pa.Array) -> pa.Array:
        def one(d, a, b, n):
            if d is None:
                return None
            frame = np.frombuffer(d, np.uint8).reshape(a, b, n)
            if crop:
                frame = crop_centre(frame, *crop_size(a, b, crop))
            return resize(frame, *to, mode).tobytes()

        return pa.array([one(*x) for x in zip(*(v.to_pylist() for v in (data, h, w, c)), strict=True)], pa.binary())

    return run(pixels, height, width, channels)


def frames_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The frames of a batch with columns height, width, channels, pixels."""
    for row in batch.to_pylist():
        yield np.frombuffer(row["pixels"], np.uint8).reshape(row["height"], row["width"], row["channels"])


def to_bfloat16(x: np.ndarray) -> np.ndarray:
    """float32 values with the low 16 bits rounded away, halves to even."""
    bits = np.ascontiguousarray(x, np.float32).view(np.uint32)
    rounded = bits + np.uint32(0x7FFF) + (bits >> np.uint32(16) & np.uint32(1))
    return (rounded & np.uint32(0xFFFF0000)).view(np.float32)


def depth_bytes(depth: np.ndarray) -> np.ndarray:
    """One image's depth to bytes, as `tensor.depth_to_bytes`."""
    away = depth.astype(np.float64) - np.median(depth)
    spread = np.abs(away).mean()
    scaled = away / spread if spread > 0 else np.zeros_like(away)
    return np.floor((scaled - scaled.min()) / (scaled.max() - scaled.min() + 1e-8) * 255).astype(np.uint8)


def bytes_to_array(data: Column) -> Column:
    """The bytes of a binary column as whole numbers."""

    @F.arrow_udf("array<int>")
    def run(data: pa.Array) -> pa.Array:
        return pa.array([None if d is None else np.frombuffer(d, np.uint8).astype(np.int32) for d in data.to_pylist()], pa.list_(pa.int32()))

    return run(data)
