"""Beta-binomial shrinkage of rates from a level of sites towards the level above it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread_join

#: A prior's strength, in rows, stays between these, and is the last when sites don't differ.
STRENGTH = (2.0, 1000.0)


def above(level: DataFrame, up: list[str]) -> DataFrame:
    """The sums n and bad of the sites of a level by the site above, and their number, `rows`."""
    return level.groupBy(*up).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count("*").alias("rows"))


def shrink(level: DataFrame, parent: DataFrame, up: str) -> DataFrame:
    """`level` (n, bad, ..., `up`) with posterior a, b and mean, and the prior's strength k.

    `parent` has `up`, mean and `rows`, its number of sites; both should be written already. The prior's mean
    is the parent's. Its strength is one number a level, by moments: the excess of sum n (p - m)^2 over what
    binomial noise alone gives is the variance between sites. A site without rows (n = 0) has no part in that
    and gets the prior itself. A parent with very many sites has them dealt to many tasks.
    """
    seen = spread_join(level, parent.select(up, F.col("mean").alias("m0"), F.col("rows").alias("sites")), [up], "sites")
    v = F.col("m0") * (1 - F.col("m0"))
    moments = seen.where("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("m0"), F.lit(2))).alias("q"),
        F.sum(v).alias("e0"), F.sum(F.col("n") * v).alias("e1"),
    )
    # E[q] = sum v + (sum n v - sum v) / (strength + 1)
    raw = F.try_divide(F.col("e1") - F.col("e0"), F.col("q") - F.col("e0")) - 1
    k = F.when(F.col("q") > F.col("e0"), F.least(F.greatest(raw, F.lit(STRENGTH[0])), F.lit(STRENGTH[1]))).otherwise(F.lit(STRENGTH[1]))
    seen = seen.join(F.broadcast(moments.select(k.alias("k"))))  # one row
    return seen.withColumn("a", F.col("m0") * F.col("k") + F.col("bad")).withColumn(
        "b", (1 - F.col("m0")) * F.col("k") + F.col("n") - F.col("bad")
    ).withColumn("mean", F.col("a") / (F.col("a") + F.col("b"))).drop("m0")
