"""Which files have which siblings: semi, anti and inner joins on derived keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tensor import concat_channels
from .sharding import with_position


def todo(items: DataFrame, done: DataFrame, on: list[str], force: bool = False) -> DataFrame:
    """Items without a finished sibling; all of them with `force`."""
    return items if force else items.join(done.select(*on), on, "left_anti")


def paired(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Both members as columns; keys are unique on either side."""
    return left.join(right, on, "inner")


def with_sibling(items: DataFrame, others: DataFrame, on: list[str]) -> DataFrame:
    return items.join(others.select(*on), on, "left_semi")


def triples_todo(left: DataFrame, right: DataFrame, done: DataFrame, on: list[str], force: bool = False) -> DataFrame:
    """Pairs whose result isn't there yet."""
    return todo(paired(left, right, on), done, on, force)


def fan_in(*streams: DataFrame) -> DataFrame:
    """All rows of all inputs, by column name; duplicates stay."""
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return out


def zipped(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str]) -> DataFrame:
    """Two lists side by side, by their positions in their own orders; the shorter one ends both."""
    a = with_position(left, *left_order)
    return a.join(with_position(right, *right_order), "pos")


def aligned(left: DataFrame, right: DataFrame, video: list[str], frame: str, values: tuple[str, str], name: str = "x") -> DataFrame:
    """Frames of two recordings of one video, the second's channels after the first's, by video and frame number."""
    other = right.select(*video, frame, F.col(values[1]).alias("_other"))
    joined = left.join(other, [*video, frame])
    return joined.withColumn(name, concat_channels(F.col(values[0]), F.col("_other"))).drop("_other")
