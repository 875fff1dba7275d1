"""Licence scans: MinHash bands over overlapping windows find templates, shingle containment verifies them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .license_texts import TEMPLATES
from .shingles import _hashes, slices, texts_of, windows

#: Words of a shingle; the part of a template's shingles that a window must hold.
SHINGLE, CONTAINMENT = 3, 0.9
#: Bands of one MinHash each. A window is at most 3 blocks long for a template of more than 4/3 blocks, or
#: three shingles for one, so where it holds CONTAINMENT of the template, a third of their union is
#: shared, and all bands miss with a chance of (2/3) ** BANDS, below one in a thousand.
BANDS = 20
#: Texts are scanned together up to so many shingles.
TOGETHER = 60_000

_SPACED = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def _words(text: bytes) -> np.ndarray:
    """Hashes of the words: A-Z lower-cased, all other ASCII marks are spaces."""
    found = text.translate(_SPACED).split()
    return np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))


def _minima(shingles: np.ndarray) -> np.ndarray:
    """The values of each band's hash, a row a band; the band is part of the value."""
    seeds = np.arange(1, BANDS + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    x = (shingles[None, :] ^ seeds) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)


class Scanner:
    """Finds templates, grouped by length so that a window is in proportion to its templates."""

    def __init__(self, templates):
        self.names, self.sets = [t[0] for t in templates], []
        groups: dict[int, list[int]] = {}
        for i, (_, text) in enumerate(templates):
            shingles = windows(_words(text.encode()), SHINGLE)
            self.sets.append(np.unique(shingles))
            block = 1
            while 2 * block < len(shingles):  # blocks of 1, 2, 3, 5, 8, 12 ... shingles
                block = -(-block * 3 // 2)
            groups.setdefault(block, []).append(i)
        self.groups = []
        for block, members in sorted(groups.items()):
            keys, owners = [], []
            for i in members:
                if len(self.sets[i]):
                    keys.append(_minima(self.sets[i]).min(axis=1))
                    owners.append(np.full(BANDS, i))
            if keys:
                key, owner = np.concatenate(keys), np.concatenate(owners)
                order = np.argsort(key, kind="stable")
                maybe = np.zeros(1 << 16, bool)
                maybe[key & np.uint64(0xFFFF)] = True
                self.groups.append((block, key[order], owner[order], maybe))

    def scan(self, texts: list) -> list[tuple[int, int, float, int, int]]:
        """(text, template, containment, first word, last word), the best window of each template in each text."""
        words = [_words(t or b"") for t in texts]
        parts = [windows(w, SHINGLE) for w in words]
        sizes = np.array([len(p) for p in parts], np.int64)
        if not sizes.sum():
            return []
        shingles, offsets = np.concatenate(parts), np.cumsum(sizes) - sizes
        minima, best = _minima(shingles), {}
        nothing = np.iinfo(np.uint64).max
        for block, key, owner, maybe in self.groups:
            counts = -(-sizes // block)
            of = np.repeat(np.arange(len(sizes)), counts)  # the text of each block
            starts = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * block + offsets[of]
            low = np.pad(np.minimum.reduceat(minima, starts, axis=1), ((0, 0), (0, 2)), constant_values=nothing)
            next1, next2 = (np.append(of, [-1, -1])[i : i + len(of)] == of for i in (1, 2))
            low = np.minimum(np.minimum(low[:, :-2], np.where(next1, low[:, 1:-1], nothing)), np.where(next2, low[:, 2:], nothing))
            found: dict[int, set[int]] = {}
            for band, w in zip(*np.nonzero(maybe[low & np.uint64(0xFFFF)]), strict=True):
                a, b = np.searchsorted(key, low[band, w]), np.searchsorted(key, low[band, w], "right")
                if a < b:
                    found.setdefault(int(w), set()).update(owner[a:b].tolist())
            for w, templates in sorted(found.items()):
                text, first = int(of[w]), int(starts[w])
                window = shingles[first : min(first + 3 * block, offsets[text] + sizes[text])]
                for i in sorted(templates):
                    inside = np.isin(window, self.sets[i])
                    part = len(np.unique(window[inside])) / len(self.sets[i])
                    if part >= CONTAINMENT and part > best.get((text, i), (0,))[0]:
                        places = first - int(offsets[text]) + np.flatnonzero(inside)
                        best[text, i] = part, int(places[0]), int(places[-1]) + min(SHINGLE, len(words[text])) - 1
        return [(*k, *v) for k, v in sorted(best.items())]


def scan_licenses(docs: DataFrame, templates=TEMPLATES, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, template, licence, containment, first_word, last_word) for each template that a document holds.

    Words are runs of letters and digits, A-Z lower-cased. Overlapping windows, each three blocks of
    shingles and a block apart, go over the whole text; a template of at most two blocks lies whole in
    one of them. A window that shares a MinHash with a template in some band is compared exactly: it must
    hold CONTAINMENT of the template's shingles. One row a template: its best window, on ties the first.

    `templates` is the stated query set, (licence, wording). Templates without words are never found.
    Nulls: a null text holds nothing. Rows that repeat an id are reported each. A very long text is scanned
    whole, by itself. Empty tables give empty results; other columns are not looked at. Nothing is shuffled.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    templates = tuple(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in slices(batches):
            texts, rows, first, size = texts_of(batch.column(1)), [], 0, 0
            for end, t in enumerate(texts, 1):
                size += len(t or b"") // 5
                if size >= TOGETHER or end == len(texts):
                    rows += [(first + at, *m) for at, *m in scanner.scan(texts[first:end])]
                    first, size = end, 0
            at, template, part, begin, last = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(template, pa.int64()), pa.array([scanner.names[i] for i in template], pa.string()),
                 pa.array(part, pa.float64()), pa.array(begin, pa.int64()), pa.array(last, pa.int64())],
                ["id", "template", "license", "containment", "first_word", "last_word"],
            )

    found = docs.select(F.col(id_col), F.col(text)).mapInArrow(
        run, f"id {kind}, template long, license string, containment double, first_word long, last_word long")
    return found.withColumnRenamed("id", id_col)
