"""Positions and shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialise


def with_position(df: DataFrame, *order, name: str = "pos", total: str | None = None) -> DataFrame:
    """Number all rows from 0 in a total order, without bringing them together in one task.

    Rows are range-partitioned and sorted, numbered within their partition and written once; the counts of
    the partitions, a row each, give each partition its offset. `total` also adds the number of rows.
    """
    cut = 1 << 33  # monotonically_increasing_id holds the partition above 33 bits
    ranked = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    ranked = ranked.withColumn("_part", F.floor(F.col("_id") / cut)).withColumn("_row", F.col("_id") % cut).drop("_id")
    ranked = materialise(ranked, "positions")
    parts = ranked.groupBy("_part").agg(F.count("*").alias("_n"))
    whole = Window.orderBy("_part")  # a row a partition
    parts = parts.select("_part", (F.sum("_n").over(whole) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    out = ranked.join(F.broadcast(parts), "_part").withColumn(name, F.col("_before") + F.col("_row"))
    if total:
        out = out.withColumn(total, F.col("_all"))
    return out.drop("_part", "_row", "_before", "_all")


def balanced(position: Column, total: Column, shards: int) -> Column:
    """Contiguous shards whose sizes differ by one at most, larger first: what ``ntile`` gives, less 1."""
    size, rest = F.floor(total / shards), total % shards
    large = rest * (size + 1)
    return F.when(position < large, F.floor(position / (size + 1))).otherwise(
        rest + F.floor(F.try_divide(position - large, size))).cast("long")


def by_ceiling(position: Column, total: Column, shards: int) -> Column:
    """Contiguous shards of ``ceil(total / shards)`` rows; the last may be short or empty."""
    return F.floor(position / F.ceil(total / shards)).cast("long")


def round_robin(position: Column, workers: int) -> Column:
    return position % workers


def two_levels(df: DataFrame, nodes: int, workers: int, position: str = "pos", total: str = "total") -> DataFrame:
    """Balanced over nodes, then over each node's workers, by arithmetic alone: node and worker."""
    pos, all_rows = F.col(position), F.col(total)
    df = df.withColumn("node", balanced(pos, all_rows, nodes))
    size, rest = F.floor(all_rows / nodes), all_rows % nodes
    node = F.col("node")
    before = node * size + F.least(node, rest)
    own = size + (node < rest).cast("long")
    return df.withColumn("worker", balanced(pos - before, own, workers))


def clamped(workers: int | Column, items: Column) -> Column:
    """No more workers than items, and one at least."""
    return F.greatest(F.lit(1), F.least(F.lit(workers) if isinstance(workers, int) else workers, items))


def consumers(df: DataFrame, number: int, *key: str) -> DataFrame:
    """Each row to exactly one of `number` consumers, which are tasks; `consumer` says which took it."""
    return df.repartition(number, *key).withColumn("consumer", F.spark_partition_id().cast("long"))
