"""Counts, rates and running totals."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sharding import with_position


def count_images(paths: DataFrame, path: str = "path", include_depth: bool = True) -> DataFrame:
    """How many files end in .jpg or .jpeg in any case; depth images count unless left out."""
    low = F.lower(path)
    wanted = low.endswith(".jpg") | low.endswith(".jpeg")
    wanted = wanted if include_depth else wanted & ~low.endswith(".depth.jpg")
    return paths.where(wanted).agg(F.count("*").alias("n_images"))


def rate(amount: Column, seconds: Column, at_once: float | None = None) -> Column:
    """Amount a second; `at_once` where no time has passed: null, or the guard's value, such as infinity or 0."""
    return F.when(seconds > 0, amount / seconds).otherwise(F.lit(at_once).cast("double"))


def interval_rates(snapshots: DataFrame, time: str, count: str, seconds: float) -> DataFrame:
    """Change since the snapshot before, and its rate.

    Snapshots are numbered without meeting in one task (`with_position`), and each meets the one before by number.
    """
    numbered = with_position(snapshots, time, name="_at")
    before = numbered.select((F.col("_at") + 1).alias("_at"), F.col(count).alias("_before"))
    out = numbered.join(before, "_at", "left").withColumn("delta", F.col(count) - F.col("_before"))
    return out.withColumn("per_second", rate(F.col("delta"), F.lit(seconds))).drop("_at", "_before")


def running_totals(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """How many rows of the same key there are up to each row, in a total order.

    All rows are numbered in the order of key and `order` without a key's rows meeting in one task; a key's
    first number, a row a key, gives each its place.
    """
    numbered = with_position(df, *by, *order, name="_at")
    first = numbered.groupBy(*by).agg(F.min("_at").alias("_first"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
    joined = numbered.alias("a").join(first.alias("b"), reduce(and_, same))
    return joined.select(*(F.col(f"a.{c}") for c in df.columns), (F.col("_at") - F.col("_first") + 1).alias("running"))


def estimated_total(own: Column, workers: int, seconds: Column, at_once: float | None = None) -> Column:
    """Throughput of all workers from one worker's count; `at_once` where no time has passed."""
    return rate(own * workers, seconds, at_once)


def average_fps(frames: Column, first: Column, last: Column) -> Column:
    """Frames a second between the times of the first and the last frame; null for a single frame."""
    return rate(frames - 1, (F.unix_micros(last.cast("timestamp")) - F.unix_micros(first.cast("timestamp"))) / 1e6)
