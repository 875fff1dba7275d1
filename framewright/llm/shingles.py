"""Word n-gram sets as sorted arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


#: Words remembered at once, and rows of a batch that are Python objects at once: bounds on a worker's memory.
WORDS_HELD, ROWS_HELD = 100_000, 250


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, cut into short ones; a worker that waits for its next task holds no free memory of Arrow's."""
    for batch in batches:
        for start in range(0, len(batch), ROWS_HELD):
            yield batch.slice(start, ROWS_HELD)
    pa.default_memory_pool().release_unused()


class _WordHashes(dict):
    """Word to hash, remembered; emptied when it has grown to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_HELD:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHashes()


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a UTF-8 text: A-Z lower-cased, split at space and tab to carriage return.

    ``bytes.lower`` and ``bytes.split`` know ASCII only, which is just that.
    """
    words = text.lower().split()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k words; a shorter text is one run, no words are none."""
    if not 0 < len(hashes):
        return hashes
    k = min(k, len(hashes))
    n = len(hashes) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = (out ^ hashes[i : i + n]) * _MIX[0]
        out ^= out >> np.uint64(29)
        out *= _MIX[1]
    return out ^ (out >> np.uint64(32))


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles."""
    return np.unique(windows(word_hashes(text or b""), k))


def texts_of(column: pa.Array) -> list:
    return column.cast(pa.binary()).to_pylist()


def signed(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))
