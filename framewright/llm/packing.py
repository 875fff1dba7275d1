"""Mixture-controlled packing: deficit round-robin over source queues into fixed-length sequences."""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from fractions import Fraction
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer, pre_tokenizers

from .common import materialise, small
from .shingles import slices

#: Tokens of a sequence, sequences of a window, the id after each document.
SEQUENCE, WINDOW_SEQUENCES, END_ID = 2048, 64, 1
#: Default bound on queues; sources with a stated share always have their own.
MAX_QUEUES = 4_096
#: Pieces between spaces, and words, that a task remembers beyond those of its latest portion, none of them longer than so many bytes.
PIECES_HELD, LONGEST_HELD = 200_000, 200
#: A portion is texts of so many bytes, or one text; words that go through the model in one call.
PORTION_BYTES, WORDS_AT_ONCE = 4 << 20, 1_000

#: The word pattern, and the normalisers, of the tokenizers that `WordTokenizer` has a short way for.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
#: A piece of the common case, whose lower case is the same in Arrow and in the tokenizer: a word, and perhaps one of MARKS.
MARKS = ".,;:!?"
PLAIN_PIECE = r"\A[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+[.,;:!?]?\z"


def _joined(values: pa.Array, ends: np.ndarray) -> pa.Array:
    """Binary values in a row, as one value from each of `ends` to the next."""
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, "<i8")[: len(values) + 1] if len(values) else np.zeros(1, "<i8")
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(offsets[ends]), data or pa.py_buffer(b"")])


class _Memory:
    """Ids of strings met lately, as Arrow columns; those of the latest portion alone stay when they are more than PIECES_HELD."""

    def __init__(self) -> None:
        self.keys, self.values = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def find(self, names: pa.Array, learn: Callable[[pa.Array], pa.Array]) -> tuple[pa.Array, np.ndarray]:
        """Values, and which of them each of the different `names` has; `learn` gives those of new names."""
        at = pc.index_in(names, value_set=self.keys)
        new = at.is_null()
        fresh = names.filter(new)
        keys, values = pa.concat_arrays([self.keys, fresh]), pa.concat_arrays([self.values, learn(fresh)])
        at = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        at[new.to_numpy(zero_copy_only=False)] = np.arange(len(self.keys), len(keys))
        self.keys, self.values = keys, values
        if len(keys) > PIECES_HELD:
            self.keys, self.values = keys.take(pa.array(at)), values.take(pa.array(at))
        short = pc.less_equal(pc.binary_length(self.keys), LONGEST_HELD)
        if not pc.all(short).as_py():
            self.keys, self.values = self.keys.filter(short), self.values.filter(short)
        return values, at


class WordTokenizer:
    """Ids of texts, piece by piece between spaces and line feeds, with a bounded memory of pieces.

    Arrow splits a portion of texts, numbers its pieces and puts their ids in a row; Python sees only what is not a
    PLAIN_PIECE, each once a portion.

    Valid for tokenizers whose tokens never reach across a space or line feed and that give these no
    tokens. Where the file has NORMALIZERS, WORD_PATTERN and a byte-level BPE with word ends, as
    word_bpe_49k.json, new pieces of Latin letters are normalised and split here and only their words,
    many at a time, go to the bare BPE model; other pieces and other files go through the tokenizer itself.
    """

    def __init__(self, path: str):
        self.model = Tokenizer.from_file(path)
        size = self.model.get_vocab_size(with_added_tokens=True)
        self.width = "<u2" if size <= 1 << 16 else "<u4"
        self.known, self.words = _Memory(), _Memory()
        self.pattern, self.bytes = self._short_way(json.loads(self.model.to_str()), size)

    def _short_way(self, file: dict, size: int):
        steps = (file.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        normalizers = [x["type"] for x in (file.get("normalizer") or {}).get("normalizers") or []]
        model = file["model"]
        if not (
            normalizers == NORMALIZERS and len(steps) == 2 and steps[0].get("pattern") == {"Regex": WORD_PATTERN} and steps[0]["invert"]
            and steps[1]["type"] == "ByteLevel" and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
            and model["type"] == "BPE" and model["end_of_word_suffix"] == "</w>" and not model["dropout"] and not model["ignore_merges"]
        ):
            return None, None
        self.bare = Tokenizer(self.model.model)
        self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends = np.zeros(size, bool)
        self.ends[[i for w, i in model["vocab"].items() if w.endswith("</w>")]] = True
        # a byte that prints in Latin-1 stands for itself, the others for the characters from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        points = np.arange(256, dtype="<u4")
        points[rest] = 256 + np.arange(len(rest))
        points[ord(" ")] = ord(" ")  # stands between words
        return regex.compile(WORD_PATTERN), points

    def _split(self, piece: str) -> list[str] | None:
        """The words of a piece; None if it has to go through the tokenizer."""
        if not piece.isprintable() or "<|" in piece or max(piece, default="") >= "\u0300":
            return None
        return self.pattern.findall(unicodedata.normalize("NFC", piece).lower())

    def _learn(self, words: pa.Array) -> pa.Array:
        """Ids of words by the bare model, which ends each with a token that has the word-end mark."""
        starts = [*range(0, len(words), WORDS_AT_ONCE), len(words)]
        groups = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), words), pa.scalar(" ", pa.large_string())).to_pylist() if len(words) else []
        found, ends = [], [np.zeros(1, "<i8")]
        for group, (start, stop) in zip(groups, pairwise(starts), strict=True):
            mapped = group if group.isascii() else self.bytes[np.frombuffer(group.encode(), np.uint8)].tobytes().decode("utf-32-le")
            ids = np.array(self.bare.encode_batch_fast([mapped], add_special_tokens=False)[0].ids, self.width)
            ends.append(np.flatnonzero(self.ends[ids]) + 1 + ends[-1][-1])
            found.append(ids)
            if len(ends[-1]) != stop - start:
                raise RuntimeError("the tokenizer's words don't end as its file says")
        data = pa.py_buffer(b"".join(x.tobytes() for x in found))
        ends = np.concatenate(ends).astype("<i8") * np.dtype(self.width).itemsize
        return pa.Array.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(ends), data])

    def _meet(self, pieces: pa.Array) -> pa.Array:
        """Ids of different pieces."""
        if self.pattern:
            plain = pc.match_substring_regex(pieces, PLAIN_PIECE).to_numpy(zero_copy_only=False)
        else:
            plain = np.zeros(len(pieces), bool)
        common, rest = pieces.filter(pa.array(plain)), pieces.filter(pa.array(~plain)).to_pylist()
        split = [self._split(x) if self.pattern else None for x in rest]
        # all words: of plain pieces, their marks, of the other pieces
        marks = pa.array([*MARKS], pa.large_string())
        words = pa.concat_arrays([pc.utf8_lower(pc.utf8_rtrim(common, MARKS)), marks, pa.array([w for x in split for w in x or ()], pa.large_string())])
        if self.pattern:
            coded = words.dictionary_encode()
            values, at = self.words.find(coded.dictionary, self._learn)
            words = values.take(pa.array(at[coded.indices.to_numpy()]))
        else:
            words = pa.array([], pa.large_binary())
        n = len(common)
        mark = pc.fill_null(pc.index_in(pc.utf8_slice_codeunits(common, -1), value_set=marks), len(marks))
        ends = pa.concat_arrays([words.slice(n, len(marks)), pa.array([b""] * (1 if self.pattern else len(marks) + 1), pa.large_binary())]).take(mark)
        first = pc.binary_join_element_wise(words.slice(0, n), ends, pa.scalar(b"", pa.large_binary()))
        own = np.cumsum([0, *(len(x or ()) for x in split)])
        second = _joined(pa.concat_arrays([words.slice(n + len(marks))]), own)
        odd = [i for i, x in enumerate(split) if x is None]
        third = pa.array(
            [np.array(self.model.encode(rest[i], add_special_tokens=False).ids, self.width).tobytes() for i in odd], pa.large_binary())
        # which of the three holds a piece's ids
        place, others = np.zeros(len(pieces), np.int64), n + np.arange(len(rest))
        place[plain] = np.arange(n)
        others[odd] = n + len(rest) + np.arange(len(odd))
        place[~plain] = others
        return pa.concat_arrays([first, second, third]).take(pa.array(place))

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin in it, with the end of all; null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        pieces = split.flatten().dictionary_encode()
        values, at = self.known.find(pieces.dictionary, self._meet)
        ids = _joined(values.take(pa.array(at[pieces.indices.to_numpy()])), split.offsets.to_numpy())
        _, ends, data = ids.buffers()
        ends = np.frombuffer(ends, "<i8") // np.dtype(self.width).itemsize
        return np.frombuffer(data, self.width)[: ends[-1]], ends

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, ends = self.encode_column(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in pairwise(ends.tolist())]


class Schedule:
    """How many tokens of each queue the first windows hold.

    Queue s sends its t-th token at virtual time (t + 1/2) / rate[s]; windows take tokens in that order,
    ties by queue. This is deficit round-robin with the deficits in closed form: after every window a queue
    is within a token or so of its share, what it lacks is owed to it in the next window, and any task
    can compute any window without the ones before. When a queue runs dry the others share its part. Queues
    of rate 0 have no share while others last; they follow in proportion to their sizes.
    """

    def __init__(self, totals: list[int], rates: list[int], window: int):
        if any(r < 0 for r in rates):
            raise ValueError("a share is 0 at least")
        self.totals, self.window, self.all = totals, window, sum(totals)
        first = [s for s, r in enumerate(rates) if r]
        later = [s for s, r in enumerate(rates) if not r]
        self.turns = [([totals[s] for s in first], [rates[s] for s in first], first), ([totals[s] for s in later], [totals[s] for s in later], later)]
        self.cache: dict[int, list[int]] = {}

    def served(self, w: int) -> list[int]:
        if w not in self.cache:
            if len(self.cache) > 64:
                self.cache.clear()
            x, out = min(w * self.window, self.all), [0] * len(self.totals)
            for totals, rates, queues in self.turns:
                part = min(x, sum(totals))
                for s, n in zip(queues, self._served(part, totals, rates), strict=True):
                    out[s] = n
                x -= part
            self.cache[w] = out
        return self.cache[w]

    @staticmethod
    def _served(x: int, totals: list[int], rates: list[int]) -> list[int]:
        if x == sum(totals):
            return list(totals)
        if x == 0:
            return [0] * len(totals)

        def at(num: int) -> list[int]:
            return [min(t, (2 * r * num + den) // (2 * den)) for t, r in zip(totals, rates, strict=True)]

        den = max(rates) << 8  # a step of 1 / den moves no queue by more than a token
        low, high = 0, den * (max(-(-t // r) for t, r in zip(totals, rates, strict=True)) + 1)
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if sum(at(mid)) <= x else (low, mid)
        out = at(low)
        lack = x - sum(out)
        if lack:
            due = [(Fraction(2 * c + 1, r), s) for s, (c, r, t) in enumerate(zip(out, rates, totals, strict=True)) if c < t]
            heapq.heapify(due)
            for _ in range(lack):
                _, s = heapq.heappop(due)
                out[s] += 1
                if out[s] < totals[s]:
                    heapq.heappush(due, (Fraction(2 * out[s] + 1, rates[s]), s))
        return out

    def place(self, queue: int, at: int) -> tuple[int, int]:
        """(position in the stream of sequences, tokens from there that stay together) of a queue's token."""
        low, high = 0, -(-self.all // self.window)
        guess = min(high - 1, at * self.all // (self.totals[queue] * self.window))  # exact but for rounding at own rates
        if self.served(guess)[queue] <= at < self.served(guess + 1)[queue]:
            low = guess
        else:
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if self.served(mid)[queue] <= at else (low, mid)
        before, after = self.served(low), self.served(low + 1)
        position = sum(before) + sum(after[s] - before[s] for s in range(queue)) + at - before[queue]
        return position, after[queue] - at


#: The tokenizer of a Python worker, kept from task to task with the words it has met.
_kept: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _kept:
        _kept.clear()
        _kept[path] = WordTokenizer(path)
    return _kept[path]


def _portions(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a column's values are at most PORTION_BYTES in all, or one row."""
    for batch in batches:
        sums = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(batch):
            bound = PORTION_BYTES + (int(sums[start - 1]) if start else 0)
            end = max(start + 1, int(np.searchsorted(sums, bound, "right")))
            yield batch.slice(start, end - start)
            start = end


def _tokens(path: str, end_id: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, block, sums = _tokenizer(path), TaskContext.get().partitionId(), {}
        width = np.dtype(tokenizer.width).itemsize
        for batch in _portions(batches, 2):
            ids, ends = tokenizer.encode_column(batch.column(2))
            data = np.insert(ids, ends[1:], end_id)
            ends = ends + np.arange(len(ends))
            counts, before = np.diff(ends), []
            for queue, n in zip(batch.column(1).to_pylist(), counts.tolist(), strict=True):
                before.append(sums.get(queue, 0))
                sums[queue] = before[-1] + n
            texts = pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends * width), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(id_type), batch.column(1), pa.array([block] * len(counts), pa.int32()), pa.array(before, pa.int64()),
                 pa.array(counts, pa.int64()), texts.cast(pa.binary())],
                ["id", "queue", "block", "before", "n", "ids"],
            )
            pa.default_memory_pool().release_unused()  # else a worker keeps what the largest portion took, also in later queries

    return run


def _cut(queues: list[str], schedule: Schedule, sequence: int, id_type: pa.DataType):
    names = ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {q: i for i, q in enumerate(queues)}
        for batch in slices(batches):
            rows: list[tuple] = []
            cols = [batch.column(i).to_pylist() for i in range(1, 5)]
            for at, (queue, begin, n, data) in enumerate(zip(*cols, strict=True)):
                ids = np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype("<u4")
                start = 0
                while start < n:
                    position, room = schedule.place(number[queue], begin + start)
                    length = min(n - start, room, sequence - position % sequence)
                    rows.append((at, start, length, n, position // sequence, position % sequence, ids[start : start + length].tobytes()))
                    start += length
            at, *rest = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)).cast(id_type), *(pa.array(c, pa.int64()) for c in rest[:5]), pa.array(rest[5], pa.binary())], names)

    return run


def pack(
    docs: DataFrame, tokenizer: str, shares: dict[str, int] | None = None, text: str = "text", id_col: str = "doc_id",
    source: str = "source", sequence: int = SEQUENCE, window_sequences: int = WINDOW_SEQUENCES, end_id: int = END_ID, max_queues: int = MAX_QUEUES,
) -> DataFrame:
    """Pieces of documents in sequences: id, start, length, doc_tokens, sequence_id, offset, ids.

    A document is its ids by the tokenizer file `tokenizer`, without special tokens, then `end_id`. Each
    source is a queue. A window is `window_sequences` sequences, and one a queue at least, so that a queue's part
    of it doesn't shrink to slivers. Its tokens are dealt to the queues by `Schedule`, in proportion to
    `shares` (source to whole-number weight; 0: after all others; 1 for sources not in it) or else to the
    queues' sizes, so that every window has the mixture to the token. A queue's part of a window is one run
    in it, and runs follow one another without gaps, so only the very last sequence can need padding.
    Documents are cut at the ends of sequences and of runs, nowhere else. `ids` are little-endian unsigned
    32-bit.

    Token ids are written once to the shared folder, each task's rows with running sums for its queues; the
    place of every token follows from these, the sums over tasks (a row a task and queue) and the queue
    sizes. So a hot source is not one task, nothing is sorted, and token ids are never shuffled unless the
    table of sums is too long to broadcast.

    Sources with a stated share always have a queue of their own. If the sources are more than `max_queues`,
    those without one are dealt by hash to so many queues, whose weight is the number of their sources (or
    their size); the mixture is then held to the token between queues, within one only on average.

    Nulls: a null text is empty and gets the end id only; a null source is the queue of empty sources.
    Rows that repeat an id are packed each. A very long text is cut like any. Empty tables give no pieces.
    Columns besides the three are not looked at, whatever their names.
    """
    name = F.coalesce(F.col(source).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.concat(F.lit("="), name).alias("queue"), F.col(text).alias("body"))
    weights = {f"={k}": w for k, w in (shares or {}).items()}
    sources = materialise(rows.groupBy("queue").agg(F.count("*").alias("rows")), "sources")
    if sources.limit(max_queues + 1).count() > max_queues:
        bucket = F.concat(F.lit("#"), F.pmod(F.xxhash64("queue"), F.lit(max_queues)).cast("string"))
        rest = ~F.col("queue").isin(list(weights)) if weights else F.lit(True)
        members = sources.where(rest).groupBy(bucket.alias("queue")).agg(F.count("*").alias("n"))
        weights |= {r.queue: r.n for r in members.collect()}  # at most max_queues
        rows = rows.withColumn("queue", F.when(rest, bucket).otherwise(F.col("queue")))
    kind = docs.schema[id_col].dataType
    name = kind.simpleString()
    tokens = materialise(rows.mapInArrow(
        _tokens(tokenizer, end_id, to_arrow_type(kind)), f"id {name}, queue string, block int, before long, n long, ids binary"), "tokens")
    sums = tokens.groupBy("queue", "block").agg(F.sum("n").alias("n"))
    running = F.sum("n").over(Window.partitionBy("queue").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    sums = materialise(sums.select("queue", "block", "n", running.alias("base")), "sums")
    totals = {r.queue: r.n for r in sums.groupBy("queue").agg(F.sum("n").alias("n")).collect()}  # max_queues and the stated ones at most
    queues = sorted(totals)
    sizes = [totals[q] for q in queues]
    rates = [weights.get(q, 1) for q in queues] if shares else sizes
    schedule = Schedule(sizes, rates, sequence * max(window_sequences, len(queues)))
    placed = tokens.join(small(sums.select("queue", "block", "base")), ["queue", "block"]).select(
        "id", "queue", (F.col("base") + F.col("before")).alias("begin"), "n", "ids")
    out = placed.mapInArrow(
        _cut(queues, schedule, sequence, to_arrow_type(kind)),
        f"id {name}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
    return out.withColumnRenamed("id", id_col)
