"""Exact duplicate removal by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KeyFilter, ascii_lower, materialise, spread_join


def exact_dedup(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", prefix_chars: int = 64, digest: bool = False
) -> DataFrame:
    """One row per row of `docs`: its id, keep_id, group_size, kept and, with `digest`, text_sha256.

    Texts are equal when identical after lower-casing A-Z; of equal texts the largest id stays.

    1. Rows whose text has a byte length that no other text has are unique; only lengths are counted.
    2. Of the rest, only those that share length and hash of the first `prefix_chars` characters remain.
    3. Only these are read in full: a bitmap over the surviving (length, prefix) keys is broadcast, and a
       text is hashed in the scan itself if its key may be among them. So no text is ever shuffled, only
       32-byte hashes, and a false positive of the bitmap costs one hash.
    4. Rows without a hash leave here and meet no join; a hot group's rows are dealt to many tasks.

    `digest` asks for the hash of every text as a report column, which means reading them all.

    Nulls: a null text counts as empty. A row with null id is kept only if its whole group has null ids.
    Repeated rows with one id are one another's copies and are all kept or all dropped with it. A very long
    text costs one hash in the scan. Empty tables give empty results; other columns of `docs` are not
    looked at, whatever their names.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(body).alias("len"), body.alias("body"))
    key = F.xxhash64("len", ascii_lower(F.substring("body", 1, prefix_chars)))

    lengths = materialise(rows.groupBy("len").agg(F.count("*").alias("n")).where("n > 1"), "lengths")
    prefixes = spread_join(rows.select("len", key.alias("key")), lengths, ["len"], "n")
    survivors = prefixes.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")

    full = F.unhex(F.sha2(ascii_lower(F.col("body")), 256))
    flagged = KeyFilter(survivors, "key").flag(rows, key, "again")
    hashed = flagged.select(
        "id", F.when(F.col("again"), full).alias("hash"), *([full.alias("report")] if digest else [])
    )
    hashed = materialise(hashed, "text-hashes")
    again = hashed.where("hash is not null")
    groups = materialise(again.groupBy("hash").agg(F.max("id").alias("keep"), F.count("*").alias("size"), F.count("*").alias("n")).where("size > 1"), "groups")
    copies = spread_join(again, groups, ["hash"], "n", "left").drop("hash")
    alone = hashed.where("hash is null").drop("hash").withColumn("keep", F.col("id")).withColumn("size", F.lit(None).cast("long"))
    out = copies.withColumn("keep", F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep"))).unionByName(alone)
    return out.select(
        F.col("id").alias(id_col),
        F.col("keep").alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        *([F.lower(F.hex("report")).alias("text_sha256")] if digest else []),
    )


OP3_SQL = """
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""
