"""Ordered frame sequences: strides, chunks, windows, addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.paths import padded
from ..functions.tensor import frame_seconds


def with_index(df: DataFrame, video: list[str], order: list[str], name: str = "i") -> DataFrame:
    """Number the frames of each video from 0; `order` must be total within a video."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*video).orderBy(*order)) - 1).cast("long"))


def keep_stride(df: DataFrame, stride: int, index: str = "i") -> DataFrame:
    """Every `stride`-th frame from 0 (1 keeps all); `j` is the number among those kept."""
    if stride < 1:
        raise ValueError("stride is 1 at least")
    return df.where(F.col(index) % stride == 0).withColumn("j", F.expr(f"{index} div {stride}"))


def keep_after_skip(df: DataFrame, skip: int, index: str = "i") -> DataFrame:
    """A frame, then `skip` frames left out (0 keeps all)."""
    return keep_stride(df, skip + 1, index)


def seeded_offset(key: Column, most: int, seed: int) -> Column:
    """A uniform whole number from 0 to `most`, both included, that `key` and `seed` fix."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % (most + 1)


def start_at(df: DataFrame, offset: Column, index: str = "j") -> DataFrame:
    """Drop the first frames of each video and number the rest anew as `k`."""
    return df.where(F.col(index) >= offset).withColumn("k", F.col(index) - offset)


def chunks(df: DataFrame, video: list[str], size: int, index: str = "j") -> DataFrame:
    """Chunks of `size` frames, the last one short: chunk, n_frames, first and last number."""
    at = df.withColumn("chunk", F.expr(f"{index} div {size}"))
    return at.groupBy(*video, "chunk").agg(
        F.count("*").alias("n_frames"), F.min(index).alias("first_frame"), F.max(index).alias("last_frame"))


def windows(
    df: DataFrame, video: list[str], size: int, stride: int, fps: int, index: str = "j", exact_times: bool = False, frame: str | None = None
) -> DataFrame:
    """Whole windows of `size` kept frames with their metadata; a short tail is dropped.

    `index` numbers the frames that windows are cut from. `frame` numbers all kept frames of the video, if that
    differs: with a start offset, windows begin at the offset but frame numbers count from the video's first.
    Frame numbers are those of the last frame before the window and of its last one, in frames of the
    video: the first window of a video starts at minus `stride`. Times divide by the whole effective rate.
    """
    at = df.withColumn("chunk", F.expr(f"{index} div {size}"))
    found = at.groupBy(*video, "chunk").agg(F.count("*").alias("n_frames"), F.max(frame or index).alias("last_frame"))
    found = found.where(F.col("n_frames") == size)
    end = F.col("last_frame") * stride
    start = end - size * stride
    return found.select(
        *video, F.col("chunk").alias("idx_in_vid"), start.alias("start_frame"), end.alias("end_frame"),
        frame_seconds(start, fps, stride, exact_times).alias("start_ts"), frame_seconds(end, fps, stride, exact_times).alias("end_ts"))


def gather(df: DataFrame, by: list[str], index: str, value: str, name: str) -> DataFrame:
    """The values of each group in the order of `index`, as an array."""
    got = df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(index, value))).alias("_all"))
    return got.select(*by, F.transform("_all", lambda x: x[value]).alias(name))


def address(df: DataFrame, position: Column, per_folder: int, widths: tuple[int, int] = (6, 4), suffix: str = ".jpg") -> DataFrame:
    """Two-level names from a running number."""
    subdir, slot = F.floor(position / per_folder).cast("long"), position % per_folder
    return df.withColumn("subdir", padded(subdir, widths[0])).withColumn("name", F.concat(padded(slot, widths[1]), F.lit(suffix)))
