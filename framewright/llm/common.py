"""What the corpus operators share: checked broadcasts, key filters, joins of hot keys and connected components.

Column names that begin with ``__fw_`` are reserved for what operators add to a caller's rows on the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import append, discard, materialise, scratch, shared_dir, written

__all__ = ["KeyFilter", "append", "ascii_lower", "connected_components", "discard", "materialise", "scratch", "shared_dir", "small", "spread_join", "table", "written"]

#: A frame of at most so many narrow rows (keys and a few numbers) may be broadcast.
BROADCAST_ROWS = 100_000
#: A key is hot with more than one in HOT_SHARE of all rows, and HOT_ROWS of them; its rows are dealt to SALTS tasks.
HOT_SHARE, HOT_ROWS, SALTS = 1_000, 1_000, 64
#: A key filter has so many bits a key, up to a broadcast of 2**29 bits, 64 MiB.
KEY_BITS, MOST_LOG_BITS = 16, 29


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, which must be written already, marked for broadcast if its row count is within the bound.

    Beyond the bound the planner's shuffled join is the other way.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; ``lower`` would change letters beyond ASCII too."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spread_join(rows: DataFrame, keyed: DataFrame, on: list[str], weight: str, how: str = "inner", hot_on: list[str] | None = None) -> DataFrame:
    """Join `rows` with `keyed`, which has a key once and in `weight` how many of the rows have it.

    Rows of a hot key are dealt to SALTS tasks by a hash of what else they hold, and the key's one row is
    sent to each of these. At most HOT_SHARE keys can be hot, so their list is a broadcast of proven size; a
    count of the largest key says whether there are any. `hot_on` names the columns to know a hot key by, if
    the key is long. `keyed` should be written already; with `how` "left", rows without a partner stay.
    `weight` is not in the result.
    """
    hot_on = hot_on or on
    total, most = keyed.agg(F.sum(weight), F.max(weight)).first()
    bound = max(HOT_ROWS, (total or 0) // HOT_SHARE)
    if (most or 0) <= bound:
        return rows.join(keyed.drop(weight), on, how)
    hot = F.broadcast(keyed.where(F.col(weight) > bound).select(*hot_on, F.lit(True).alias("__fw_hot")).distinct())
    rest = [c for c in rows.columns if c not in on]
    salt = F.when(F.col("__fw_hot"), F.pmod(F.xxhash64(*rest), F.lit(SALTS))).otherwise(0)
    left = rows.join(hot, hot_on, "left").withColumn("__fw_salt", salt).drop("__fw_hot")
    salts = F.when(F.col("__fw_hot"), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    right = keyed.drop(weight).join(hot, hot_on, "left").withColumn("__fw_salt", F.explode(salts)).drop("__fw_hot")
    return left.join(right, [*on, "__fw_salt"], how).drop("__fw_salt")


class KeyFilter:
    """A bitmap over hashed 64-bit keys, as a broadcast side of proven size.

    It has KEY_BITS bits a counted key, at most 2**MOST_LOG_BITS: that is 64 MiB, in rows of 4 KiB. A key that
    went in always passes; others pass with a chance of about one in KEY_BITS, more beyond the bound, so
    an exact join or grouping has to follow. `matching` keeps that chance at any number of keys: beyond the
    bound it takes the keys in parts, each with a bitmap of its own and a pass over the rows.
    """

    def __init__(self, keys: DataFrame, key: str, log_bits: int | None = None, most_log_bits: int = MOST_LOG_BITS):
        self.keys = materialise(keys.select(F.col(key).cast("long").alias("key")), "keys")
        wanted = max(1 << 15, KEY_BITS * self.keys.count())
        self.bits = 1 << min(log_bits or (wanted - 1).bit_length(), most_log_bits)
        self.parts = 1 if log_bits else -(-wanted // self.bits)
        self.maps = self._maps(self.keys)
        self.passed: list[DataFrame] = []

    def _maps(self, keys: DataFrame) -> DataFrame:
        slot = self._slot(F.col("key"))
        maps = keys.groupBy(F.bitmap_bucket_number(slot).alias("__fw_bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("__fw_map"))
        word = "cast(conv(hex(substring(__fw_map, 4 * i + 1, 4)), 16, 10) as bigint)"  # as whole numbers, to be tested fast
        signed = f"transform(sequence(0, 1023), i -> cast({word} - if({word} >= 2147483648, 4294967296, 0) as int))"
        return materialise(maps.select("__fw_bucket", F.expr(signed).alias("__fw_map")), "bitmap")

    def _slot(self, key: Column) -> Column:
        return F.pmod(key, F.lit(self.bits)) + 1

    def _part(self, key: Column) -> Column:
        return F.pmod(F.shiftright(key, 40), F.lit(self.parts))

    def flag(self, df: DataFrame, key: Column, name: str, maps: DataFrame | None = None) -> DataFrame:
        """`df` with a boolean column: may `key` be among the keys? Null keys are not."""
        slot = self._slot(key)
        probe = df.withColumn("__fw_bucket", F.bitmap_bucket_number(slot)).withColumn("__fw_bit", F.bitmap_bit_position(slot))
        # four bytes a word, the first byte highest
        bit = F.expr("getbit(get(__fw_map, cast(__fw_bit div 32 as int)), cast(24 - (__fw_bit % 32) div 8 * 8 + __fw_bit % 8 as int))")
        return (
            probe.join(F.broadcast(self.maps if maps is None else maps), "__fw_bucket", "left")
            .withColumn(name, F.coalesce(bit > 0, F.lit(False)))
            .drop("__fw_bucket", "__fw_bit", "__fw_map")
        )

    def matching(self, df: DataFrame, key: Column) -> DataFrame:
        """The rows of `df` whose `key` may be among the keys."""
        if self.parts == 1:
            return self.flag(df, key, "__fw_may").where("__fw_may").drop("__fw_may")
        out = scratch(df.sparkSession, "matching")
        for part in range(self.parts):
            maps = self._maps(self.keys.where(self._part(F.col("key")) == part))
            rows = df.where(self._part(key) == part)
            append(self.flag(rows, key, "__fw_may", maps).where("__fw_may").drop("__fw_may"), out)
            discard(maps)
        self.passed.append(written(df.sparkSession, out, df.schema))
        return self.passed[-1]

    def discard(self) -> None:
        """Delete the keys, the bitmap and what `matching` wrote; whatever is built on them must be written."""
        discard(self.keys, self.maps, *self.passed)


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as (a, b) of 64-bit ids; returns (node, root), root smallest.

    `discard` deletes the result.

    Alternates the large-star and small-star steps, which end in a number of rounds that grows with the
    logarithm of the size. Minima are aggregated before they are joined back, and a hub's rows are dealt to
    many tasks, so it is never gathered in one; each round is written to the shared folder, and the one
    before it deleted.
    """

    def with_minimum(rows: DataFrame, count: int) -> DataFrame:
        """(u, v, m): with the least v of each u."""
        least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        if count <= HOT_ROWS:
            return rows.join(least.drop("n"), "u")
        minima.append(materialise(least, "minima"))
        return spread_join(rows, minima[-1], ["u"], "n")

    def stamp(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())

    def step(pairs: DataFrame, before: DataFrame, name: str) -> DataFrame:
        out = materialise(pairs.where("u > v").distinct(), name)
        discard(before, *minima)
        minima.clear()
        return out

    minima: list[DataFrame] = []
    pairs = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), "edges")
    seen = stamp(pairs)
    while seen[0]:
        both = with_minimum(pairs.union(pairs.select("v", "u")), 2 * seen[0]).where("v > u")
        pairs = step(both.select(F.col("v").alias("u"), F.least("u", "m").alias("v")), pairs, "large-star")
        joined = with_minimum(pairs, seen[0])
        both_ends = F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        pairs = step(joined.select(F.explode(both_ends).alias("e")).select("e.*"), pairs, "small-star")
        now = stamp(pairs)
        if now == seen:
            break
        seen = now
    out = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out._framewright_path = pairs._framewright_path  # so that `discard` knows it
    return out
