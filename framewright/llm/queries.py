"""The registered queries of this subpackage, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import find_leaks
from .exact_dedup import OP3_SQL, exact_dedup
from .licenses import scan_licenses
from .line_dedup import dedup_lines
from .ngram_join import OP10_SQL, ngram_components
from .packing import pack
from .quality import REJECT, score_documents
from .sharding import shard_table
from .url_filter import OP7_SQL, filter_urls, page_outcomes
from .warc import OP4_SQL, archive_round_trip


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that stay, with their probabilities of being bad."""
    scored = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), columns=["doc_id"])
    return scored.where(F.col("p_bad") < REJECT).withColumn("kept", F.lit(True))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each document lies after all arrivals and compactions, read from the shards themselves."""
    _, rows = shard_table(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.sha2("text", 256).alias("text_sha256"), "shard", "shard_rows", "shard_bytes", "manifest_version")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), digest=True)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = archive_round_trip(table(spark, sf_dir, "pages"), payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "text", "removed_chunks", "removed_lines", "copies_of")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_file())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), page_outcomes(table(spark, sf_dir, "labels")))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_classifier, op2_sharding, op3_exact_dedup, op4_warc, op5_line_dedup, op6_packing, op7_url_reputation, op8_decontamination,
        op9_license_scan, op10_ngram_jaccard,
    )
}

SQL: dict[str, str] = {"op3_exact_dedup": OP3_SQL, "op4_warc": OP4_SQL, "op7_url_reputation": OP7_SQL, "op10_ngram_jaccard": OP10_SQL}
