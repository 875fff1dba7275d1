"""Model batches: padding, batch-wide ranges, collation, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tensor import concat_channels, hwc_to_chw, to_bfloat16, to_unit_range


def batch_sizes(df: DataFrame, size: int, position: str = "pos") -> DataFrame:
    """Of each batch its number of rows and of rows to pad."""
    got = df.groupBy(F.floor(F.col(position) / size).cast("long").alias("batch_id")).agg(F.count("*").alias("n_rows"))
    return got.withColumn("n_pad", F.lit(size) - F.col("n_rows"))


def batch_to_bytes(df: DataFrame, values: str, size: int, position: str = "pos", include_padding: bool = False, name: str = "scaled") -> DataFrame:
    """Depth to 0..255 by the range of the whole batch, truncated; a constant batch gives zeros.

    Padding takes part in the range only on demand. A batch is a run of `size` rows, so its rows are brought
    together once, spread over the tasks by batch, and the range is a window over them; the window's sort
    is by the batch alone.
    """
    batch = F.floor(F.col(position) / size).cast("long")
    whole = Window.partitionBy("batch_id")
    prepared = df.withColumn("batch_id", batch).withColumn("_v", F.transform(values, lambda v: (v - 100.0) / 100.0))
    joined = prepared.withColumn("_low", F.min(F.array_min("_v")).over(whole)).withColumn(
        "_high", F.max(F.array_max("_v")).over(whole)).withColumn("_n", F.count("*").over(whole))
    if include_padding:
        pad = (F.col("_n") < size, F.lit(-1.0))  # a zero frame
        joined = joined.withColumn("_low", F.when(pad[0], F.least("_low", pad[1])).otherwise(F.col("_low"))).withColumn(
            "_high", F.when(pad[0], F.greatest("_high", pad[1])).otherwise(F.col("_high")))
    scaled = F.transform("_v", lambda v: F.when(
        F.col("_high") > F.col("_low"), F.floor((v - F.col("_low")) / (F.col("_high") - F.col("_low")) * 255)).otherwise(0).cast("long"))
    return joined.withColumn(name, scaled).drop("_v", "_low", "_high", "_n")


def collate(df: DataFrame, frames: str, shape: tuple[int, int, int], size: int, position: str = "pos") -> DataFrame:
    """Rows of training batches: frames HWC 0..255 become CHW -1..1, with batch_id and row_in_batch."""
    h, w, c = shape
    return df.withColumn("tensor", to_unit_range(hwc_to_chw(F.col(frames), h, w, c))).withColumn(
        "batch_id", F.floor(F.col(position) / size).cast("long")).withColumn("row_in_batch", F.col(position) % size)


def summary(df: DataFrame, values: str, by: list[str]) -> DataFrame:
    """Smallest, largest, mean and number of values; each row is reduced before the shuffle."""
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return df.groupBy(*by).agg(
        F.min(F.array_min(values)).alias("low"), F.max(F.array_max(values)).alias("high"),
        (F.sum(total) / F.sum(F.size(values))).alias("mean"), F.sum(F.size(values)).alias("n_values"))


def collate_with_metadata(df: DataFrame, frames: str, shape: tuple[int, int, int], size: int, metadata: list[str], position: str = "pos") -> DataFrame:
    """Whole training batches, a row each: the tensors as one array and a list of metadata, both in the batch's order."""
    rows = collate(df, frames, shape, size, position)
    got = rows.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("row_in_batch", "tensor", F.struct(*metadata).alias("metadata")))).alias("_all"))
    return got.select("batch_id", F.transform("_all", lambda x: x["tensor"]).alias("tensors"), F.transform("_all", lambda x: x["metadata"]).alias("metadata"))


def preprocess(rgb: Column, depth: Column) -> Column:
    """Bytes of an image and its depth, CHW, to one tensor of -1..1: float32 steps, the channels together, then bfloat16."""
    both = concat_channels(to_unit_range(rgb, "float"), to_unit_range(depth, "float"))
    return F.transform(both, lambda v: to_bfloat16(v.cast("double")))


def payload(frames: Column, *metadata: str) -> Column:
    """What a producer sends: the frames, and their metadata as one struct."""
    return F.struct(frames.alias("frames"), F.struct(*metadata).alias("metadata"))


def unpack(df: DataFrame, name: str = "payload") -> DataFrame:
    """frames and the fields of metadata, as columns."""
    return df.select(f"{name}.frames", f"{name}.metadata.*")
