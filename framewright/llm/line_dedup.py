"""Removal of passages that repeat across documents, by content-defined chunks and by runs of lines."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KeyFilter, materialise, spread_join

#: The window of the rolling hash, in lines; a boundary falls after one line in DIVISOR.
WINDOW, DIVISOR = 3, 3
#: Defaults. A line of so many words is a chunk of its own; a chunk of several lines counts from so many words.
LONG_LINE, LEAST_WORDS = 50, 1
#: A run of shorter lines that holds so many words is a passage, wherever chunks end.
PASSAGE_WORDS = 50


class Rules(NamedTuple):
    """What counts as a repeated piece; see `dedup_lines`."""

    least_words: int = LEAST_WORDS
    long_line: int = LONG_LINE
    passage_words: int = PASSAGE_WORDS


def _let(value: Column, body) -> Column:
    """`body(value)`, with `value` computed once a row however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _rotated(x: Column, bits: int) -> Column:
    return F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits)) if bits else x


def _chunk_ends(hashes: Column, words: Column, long_line: int) -> Column:
    """Where the chunks of a text end, as numbers of lines before the boundary.

    A cyclic-polynomial hash rolls over the hashes of the last WINDOW lines; a chunk ends where it is
    divisible by DIVISOR, so a boundary depends on the lines just before it and insertions elsewhere
    don't shift it. A line of `long_line` words has boundaries on both sides.
    """

    def ends_here(end: Column) -> Column:
        rolled = F.lit(0).cast("long")
        for back in range(WINDOW):
            rolled = rolled.bitwiseXOR(_rotated(F.coalesce(F.get(hashes, end - 1 - back), F.lit(0)), back))
        near_long = (F.get(words, end - 1) >= long_line) | (F.coalesce(F.get(words, end), F.lit(long_line)) >= long_line)
        return near_long | (F.pmod(F.xxhash64(rolled), F.lit(DIVISOR)) == 0)

    return F.filter(F.sequence(F.lit(1), F.size(hashes)), ends_here)


def _passages(words: Column, rules: Rules) -> Column:
    """The least runs of lines that hold `passage_words`, as first line * 2**32 + last line.

    From each line forward to the first that completes the words, and from each line back. A longer run
    that stands twice is covered by such runs that stand twice: by the one from its first line, and for
    each line after that by the one back from it. Which runs are least depends on their own lines alone,
    so equal passages have equal runs whatever stands around them. Lines of `long_line` words are chunks
    of their own and end a run; blank lines hold no word and neither begin nor end one, so a run has at
    most `passage_words` lines with words.
    """
    enough = rules.passage_words

    def reached(order: Column, at: Column) -> Column:
        """The line of `order` that completes the words from number `at` on, else null."""

        def step(seen: Column, line: Column) -> Column:  # words so far, enough + line once complete, -1 at a long line
            count = F.get(words, line)
            return (
                F.when((seen < 0) | (seen >= enough), seen).when(count >= rules.long_line, -1)
                .when(seen + count >= enough, line + enough).otherwise(seen + count)
            )

        end = F.aggregate(F.slice(order, at + 1, enough), F.lit(0), step)
        return F.when(end >= enough, end - enough)

    def runs(order: Column, forward: bool) -> Column:
        def run(line: Column, at: Column) -> Column:
            last = reached(order, at)
            first, last = (line, last) if forward else (last, line)
            return F.when(F.get(words, line) < rules.long_line, F.shiftleft(first.cast("long"), 32).bitwiseOR(last.cast("long")))

        return F.transform(order, run)

    filled = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda line: F.get(words, line) > 0)
    return _let(filled, lambda order: F.filter(
        F.array_union(runs(order, True), _let(F.reverse(order), lambda back: runs(back, False))), lambda run: run.isNotNull()))


def _with_lines(text: Column, body) -> Column:
    """`body(lines, hashes, words)` of a text; a blank line has no words."""

    def count(line: Column) -> Column:
        return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + (line != "").cast("int")

    return _let(F.split(text, "\n"), lambda lines: _let(
        F.transform(lines, lambda x: F.xxhash64(x)), lambda hashes: _let(
            F.transform(lines, lambda x: count(F.trim(x))), lambda words: body(lines, hashes, words))))


def line_units(text: Column, with_text: bool, rules: Rules = Rules()) -> Column:
    """What may be removed from a text: array of (start, lines, hash, chunk), chunks and then passages.

    A chunk counts if it is several lines with `least_words` words in all, or a long line. The hash of a
    passage is never meant to equal that of a chunk of the same lines.
    """

    def units(lines: Column, hashes: Column, words: Column) -> Column:
        def unit(start: Column, size: Column, *kind: Column) -> Column:
            body = F.array_join(F.slice(lines, start + 1, size), "\n") if with_text else F.lit(None).cast("string")
            return F.struct(
                start.alias("start"), size.alias("lines"), F.xxhash64(F.slice(hashes, start + 1, size), *kind).alias("hash"), body.alias("chunk"))

        def chunk(ends: Column) -> Column:
            def one(end: Column, no: Column) -> Column:
                start = F.when(no > 0, F.get(ends, no - 1)).otherwise(0)
                total = F.aggregate(F.slice(words, start + 1, end - start), F.lit(0), lambda a, w: a + w)
                return F.when(((end - start > 1) & (total >= rules.least_words)) | (total >= rules.long_line), unit(start, end - start))

            return F.transform(ends, one)

        def passage(run: Column) -> Column:
            start, last = F.shiftright(run, 32).cast("int"), run.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
            return unit(start, last - start + 1, F.lit("passage"))

        chunks = F.filter(_let(_chunk_ends(hashes, words, rules.long_line), chunk), lambda c: c.isNotNull())
        return F.concat(chunks, F.transform(_passages(words, rules), passage))

    return _with_lines(text, units)


def _without(text: Column, numbers: Column, rules: Rules) -> Column:
    """(text without the lines of these numbers, chunks that lost a line, lines lost)."""

    def rest(lines: Column, hashes: Column, words: Column) -> Column:
        def lost(ends: Column) -> Column:
            def touched(end: Column, no: Column) -> Column:
                return F.arrays_overlap(F.sequence(F.when(no > 0, F.get(ends, no - 1)).otherwise(0), end - 1), numbers)

            return F.size(F.filter(ends, touched))

        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), numbers)
        return F.struct(
            F.array_join(F.transform(kept, lambda line: F.get(lines, line)), "\n").alias("text"),
            _let(_chunk_ends(hashes, words, rules.long_line), lost).cast("long").alias("chunks"), F.size(numbers).cast("long").alias("lines"))

    return _with_lines(text, rest)


def dedup_lines(docs: DataFrame, text: str = "text", id_col: str = "doc_id", rules: Rules = Rules()) -> DataFrame:
    """`docs` with repeated chunks and passages taken out of `text`, plus removed_chunks, removed_lines and copies_of.

    A chunk is what stands between two content-defined boundaries. It counts if it is several lines with
    `least_words` words in all (by default one, so that any repeat with a word in it goes), or one line of
    `long_line` words. A passage is a run of lines, each of under `long_line` words, that holds
    `passage_words` in all. Of equal chunks, and of equal passages, that of the smallest (id, position) stays
    wherever it is, and so does whatever overlaps it in its own text; a line that goes always stands at a
    smaller (id, position) too. removed_chunks counts chunks that lost a line; copies_of lists the ids of the
    rows that hold the first of its chunks and passages. Rows are never dropped here: a row all of whose lines
    stand elsewhere keeps an empty text.

    1. The scan yields a hash a chunk and a hash a least passage; hashes that occur twice go into a bitmap
       (`KeyFilter.matching`).
    2. Only chunks and passages that pass it are read as text and grouped by their bytes, so equal hashes
       of different ones don't matter. A chunk in a third of all rows is one row a task after partial
       aggregation, and the join back deals its rows to many tasks (`spread_join`).
    3. Texts are shuffled only for documents that lose a line; the others pass straight through.

    Nulls: a null text stays null; a null id sorts first. Rows that repeat id and text count as one
    document. Empty texts have one empty chunk, which is never removed. A very long text is one row, whose
    passages are bounded in number by its lines. Empty tables give empty results. Other columns pass through;
    the names removed_chunks, removed_lines and copies_of replace columns of these names.
    """
    extra = ["removed_chunks", "removed_lines", "copies_of"]
    docs = docs.drop(*extra)
    mark = F.xxhash64(F.col(text))
    rows = docs.select(F.col(id_col).alias("id"), mark.alias("mark"), F.col(text).alias("body")).where("body is not null")

    hashes = rows.select(F.explode(line_units(F.col("body"), False, rules)).alias("c")).groupBy("c.hash")
    again = KeyFilter(hashes.agg(F.count("*").alias("n")).where("n > 1").select("hash"), "hash")

    chunks = rows.select("id", "mark", F.explode(line_units(F.col("body"), True, rules)).alias("c")).select("id", "mark", "c.*")
    chunks = materialise(again.matching(chunks, F.col("hash")), "chunks")
    place = F.struct("id", "mark", "start")
    first = materialise(chunks.groupBy("hash", "chunk").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1"), "firsts")
    overlaps = F.col("first.id").eqNullSafe(F.col("id")) & (F.col("first.mark") == F.col("mark")) & (F.col("start") < F.col("first.start") + F.col("lines"))
    removed = spread_join(chunks, first, ["hash", "chunk"], "n", hot_on=["hash"]).where(~overlaps)
    removed = materialise(
        removed.groupBy("id", "mark").agg(
            F.array_distinct(F.flatten(F.collect_set(F.sequence("start", F.col("start") + F.col("lines") - 1)))).alias("__fw_numbers"),
            F.sort_array(F.collect_set("first.id")).alias("copies_of"),
        ),
        "removed",
    )

    touched = KeyFilter(removed.select(F.xxhash64("id", "mark").alias("key")), "key")
    marked = touched.flag(docs.withColumn("__fw_mark", mark), F.xxhash64(F.col(id_col), "__fw_mark"), "__fw_touched")
    names = docs.columns
    same = marked.where("not __fw_touched").select(
        *names, F.lit(0).cast("long").alias("removed_chunks"), F.lit(0).cast("long").alias("removed_lines"),
        F.array().cast(removed.schema["copies_of"].dataType).alias("copies_of"))
    joined = marked.where("__fw_touched").join(
        removed.select(F.col("id").alias("__fw_id"), F.col("mark").alias("__fw_m"), "__fw_numbers", "copies_of"),
        F.col(id_col).eqNullSafe(F.col("__fw_id")) & (F.col("__fw_mark") == F.col("__fw_m")), "left")
    joined = joined.withColumn("__fw_rest", F.when(F.col("__fw_numbers").isNotNull(), _without(F.col(text), F.col("__fw_numbers"), rules)))
    new_text = F.when(F.col("__fw_numbers").isNull(), F.col(text)).otherwise(F.col("__fw_rest.text"))
    changed = joined.select(
        *[new_text.alias(text) if c == text else F.col(c) for c in names],
        F.coalesce("__fw_rest.chunks", F.lit(0)).cast("long").alias("removed_chunks"),
        F.coalesce("__fw_rest.lines", F.lit(0)).cast("long").alias("removed_lines"),
        F.coalesce("copies_of", F.array().cast(removed.schema["copies_of"].dataType)).alias("copies_of"),
    )
    return same.unionByName(changed)
