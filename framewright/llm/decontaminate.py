"""Benchmark decontamination: pieces by the pigeonhole principle, verified by bit-parallel edit distance."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Edits allowed, as a share of an item's characters; items of fewer characters allow none and must be whole words.
ERROR_RATE, LEAST_CHARS = 0.05, 24
#: So many items, and characters of items, are held by a task at once, in expectation; a larger benchmark takes several passes.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 8_000_000


def normalise(text: str | None) -> str:
    """Lower case, each run of white space one space."""
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """`budget` + 1 pieces (offset, text) of about equal length; with so many edits, one stays whole."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def edit_search(pattern: str, text: str, budget: int) -> tuple[int, int] | None:
    """(distance, end) of the best match of all of `pattern` with any part of `text`, within `budget`.

    Myers' algorithm; Python's whole numbers serve as bit vectors of the pattern's length.
    """
    m = len(pattern)
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    every, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = every, 0, m, (m, 0) if m <= budget else None
    for at, c in enumerate(text):
        eq = masks.get(c, 0)
        across = (((eq & up) + up) ^ up) | eq
        right, left = down | (every & ~(across | up)), up & across
        if right & top:
            score += 1
        elif left & top:
            score -= 1
        right, left = right << 1 & every, left << 1 & every
        eq |= down
        up, down = left | (every & ~(eq | right)), right & eq
        if score <= budget and (best is None or score < best[0]):
            best = score, at + 1
    return best


def inside_word(text: str, at: int) -> bool:
    """Does position `at` of `text` stand between two letters or digits?"""
    return 0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum()


class Matcher:
    """Finds benchmark items in texts."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float = ERROR_RATE):
        self.items = [(i, t, int(len(t) * error_rate) if len(t) >= LEAST_CHARS else 0) for i, t in ((i, normalise(t)) for i, t in items) if t]
        owners: dict[str, list[tuple[int, int]]] = {}
        for n, (_, item, budget) in enumerate(self.items):
            for offset, piece in pieces(item, budget):
                owners.setdefault(piece, []).append((n, offset))
        self.index = ahocorasick.Automaton()
        for piece, found in owners.items():
            self.index.add_word(piece, (len(piece), found))
        self.index.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item id, distance, end in the normalised text) of each item's best match."""
        if not self.items:
            return []
        body = normalise(text)
        starts: dict[int, list[int]] = {}
        whole: dict[int, int] = {}  # end of the first match of each short item
        for end, (length, found) in self.index.iter(body):
            for n, offset in found:
                if len(self.items[n][1]) >= LEAST_CHARS:
                    starts.setdefault(n, []).append(end + 1 - length - offset)
                elif n not in whole and not inside_word(body, end + 1 - length) and not inside_word(body, end + 1):
                    whole[n] = end + 1
        out = [(self.items[n][0], 0, end) for n, end in whole.items()]
        for n, places in starts.items():
            item_id, item, budget = self.items[n]
            best, done = None, -1
            for start in sorted(places):
                low, high = max(0, start - budget), start + len(item) + budget
                if high <= done:
                    continue  # inside what has been looked at
                done = high
                match = edit_search(item, body[low:high], budget)
                if match and (best is None or match[0] < best[0]):
                    best = match[0], low + match[1]
            if best:
                out.append((item_id, *best))
        return out


def _holds_none(matcher):
    @F.arrow_udf("boolean")
    def clean(texts: pa.Array) -> pa.Array:
        find = matcher()
        return pa.array([not find.find(t.as_py()) for t in texts], pa.bool_())

    return clean


def blocks_of(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> Iterator[list[tuple]]:
    """The benchmark, a stated set of queries, in blocks of bounded expected size; one block is read at a time."""
    rows = benchmark.select(F.col(item).alias("i"), F.col(text).alias("t")).where("i is not null and t is not null").distinct()
    n, chars = rows.agg(F.count("*"), F.sum(F.length("t"))).first()
    count = max(1, -(-n // BLOCK_ITEMS), -(-(chars or 0) // BLOCK_CHARS))
    for b in range(count):
        yield [tuple(r) for r in rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == b).collect()]


def _shared(spark: SparkSession, items: list[tuple]):
    """A function that gives the matcher of `items`, built once in a Python process."""
    sent = spark.sparkContext.broadcast(items)

    def matcher() -> Matcher:
        if getattr(matcher, "built", None) is None:
            matcher.built = Matcher(sent.value)
        return matcher.built

    return matcher


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", id_col: str = "doc_id", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(document id, item id, distance, match_end, item_chars) for every document that holds a benchmark item.

    An item is held if some part of the document is within ERROR_RATE of the item's length in edits
    (insert, delete, replace one character), both in lower case with single spaces. The item is split into
    one more piece than edits are allowed, so at least one piece occurs unchanged; an Aho-Corasick scan
    finds all pieces of all items in one pass over the text, and Myers' algorithm verifies the places that
    they point to. The best match of an item in a document is reported, on ties the first. An item below
    LEAST_CHARS characters is held if it occurs unchanged and neither end is between two letters or digits.

    The scan runs where the rows are; nothing is shuffled. The benchmark is the stated query set; beyond
    BLOCK_ITEMS items or BLOCK_CHARS characters it is taken in blocks, a pass each, so a task's index is
    bounded, and so is what the driver holds.

    Nulls: null texts hold nothing; null items and items without a character are not looked for.
    Rows that repeat an id are reported each; so are items that repeat an id with another text. A very long
    text is searched whole, by one worker. Empty tables give empty results; other columns are not looked at.
    """
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item].dataType.simpleString()
    item_type = to_arrow_type(benchmark.schema[item].dataType)
    out = None
    for items in blocks_of(benchmark, item, item_text):
        matcher = _shared(docs.sparkSession, items)

        def scan(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            find = matcher()
            for batch in batches:
                rows = [(at, *m) for at, t in enumerate(batch.column(1)) for m in find.find(t.as_py())]
                cols = list(zip(*rows, strict=True)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1]).cast(item_type), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())],
                    ["id", "item", "distance", "match_end"],
                )

        found = docs.select(id_col, text).mapInArrow(scan, f"id {kind}, item {item_kind}, distance long, match_end long")
        out = found if out is None else out.unionByName(found)
    return out.select(F.col("id").alias(id_col), F.col("item").alias(item), "distance", "match_end")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of `docs` that hold no benchmark item; see `find_leaks`."""
    for items in blocks_of(benchmark, item, item_text):
        matcher = _shared(docs.sparkSession, items)

        docs = docs.where(_holds_none(matcher)(F.col(text)))
    return docs
