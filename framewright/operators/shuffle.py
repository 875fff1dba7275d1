"""Seeded orders and draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sharding import with_position


def shuffle_key(key: Column, seed: int) -> Column:
    """Sorting by this, then by the key, is a shuffle that the seed fixes."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def seeded_shuffle(df: DataFrame, key: str, seed: int, name: str = "pos", total: str | None = None) -> DataFrame:
    return with_position(df.withColumn("_mix", shuffle_key(F.col(key), seed)), "_mix", key, name=name, total=total).drop("_mix")


def block_shuffle(df: DataFrame, key: str, block: int, seed: int, position: str = "pos", name: str = "shuffled") -> DataFrame:
    """Shuffles within runs of `block` rows: what a buffer that is filled, shuffled and emptied gives.

    A run's rows change places only within it, so the new number is the run's start plus a rank.
    """
    from pyspark.sql import Window

    run = F.floor(F.col(position) / block).cast("long")
    rank = F.row_number().over(Window.partitionBy(run).orderBy(shuffle_key(F.col(key), seed), key)) - 1
    return df.withColumn(name, run * block + rank)


def draws(items: DataFrame, count: int, seed: int, position: str = "pos", total: str = "total") -> DataFrame:
    """`count` draws with replacement, numbered by `draw`, from items with positions and their total."""
    spark = items.sparkSession
    one = items.select(total).limit(1)  # one row
    drawn = spark.range(count).withColumnRenamed("id", "draw").crossJoin(F.broadcast(one))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("draw").cast("string")))
    drawn = drawn.select("draw", (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.col(total)).alias(position))
    return drawn.join(items.drop(total), position)
