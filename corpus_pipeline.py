"""A training-corpus pipeline: quality filter, line dedup, near-duplicate removal, decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm.common import KeyFilter, discard, materialise, table
from framewright.llm.decontaminate import drop_leaks
from framewright.llm.line_dedup import dedup_lines
from framewright.llm.ngram_join import ngram_components
from framewright.llm.packing import pack
from framewright.llm.quality import filter_quality
from framewright.llm.queries import tokenizer_file

#: Near duplicates share this part of their distinct shingles of so many words.
SHINGLE_WORDS, SIMILARITY = 5, (80, 100)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Judged by row: rows that repeat an id are judged each, a null text counts as empty, null sources and
    languages are sites of their own, ties at the threshold go. An empty table stays empty, and extra columns
    pass through whatever their names. Where `labels` has no usable rows, all stay.
    """
    return filter_quality(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go, and with them the documents that held nothing else; n_chars follows the text.

    A null text stays as it is, and so does an empty one. Rows that repeat id and text are one document here: they
    keep or lose the same lines. Of equal passages the one of the smallest (id, position) stays, a null id
    first. Extra columns pass through; removed_chunks, removed_lines and copies_of are the operator's.
    """
    done = dedup_lines(docs)
    left = done.where((F.col("removed_chunks") == 0) | (F.trim("text") != ""))
    return left.withColumn("n_chars", F.when(F.col("removed_chunks") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays, that of the smallest id, a null id before all.

    A document is known by its id and its text's digest, so rows that share an id but not a text are judged
    each. Of rows that repeat both one stays, also where the text is null or without words, which is near to
    nothing else. Whole documents travel only if a key filter over the verdicts says that they may go. An empty
    table stays empty; extra columns pass through whatever their names, and of repeated rows that
    differ in them any one stays.
    """
    num, den = SIMILARITY
    person = F.struct("doc_id", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("digest"), F.col("text").isNull().alias("none"))
    groups = ngram_components(docs.select(person.alias("__fw_doc"), "text"), SHINGLE_WORDS, num, den, id_col="__fw_doc")
    groups = groups.groupBy("__fw_doc").agg(F.count("*").alias("rows"), (F.min("component_id") < F.col("__fw_doc")).alias("gone"))
    judged = materialise(groups.where("rows > 1 OR gone"), "near-duplicates")
    key = F.xxhash64("__fw_doc")
    flagged = KeyFilter(judged.select(key.alias("key")), "key").flag(docs.withColumn("__fw_doc", person), key, "__fw_may")
    again = flagged.where("__fw_may").join(judged.where("gone").select("__fw_doc"), "__fw_doc", "left_anti").dropDuplicates(["__fw_doc"])
    return flagged.where("not __fw_may").select(*docs.columns).unionByName(again.select(*docs.columns))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    Judged by row: repeated rows share their fate, null and empty texts hold nothing and stay. Null and empty
    items are not looked for. Empty tables change nothing; extra columns pass through whatever their names.
    """
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences of 2048 tokens, with their token ids.

    Rows that repeat an id are packed each; a null or empty text is its end id alone, a null source the
    queue of empty sources. An empty table gives no pieces; extra columns are not looked at.
    """
    pieces = pack(docs, tokenizer_file())
    return pieces.select("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", F.crc32("ids").alias("ids_crc32"), "ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: The classifier, the chunk boundaries and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
