"""Training batches from published windows, as an iterable for a training loop."""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame


def collate(items: list[dict]) -> tuple[np.ndarray, list[dict]]:
    """Frames of 0..255, [n, h, w, c] each, to one array [batch, n, c, h, w] of -1..1 in float32, and the list of metadata."""
    frames = [x["frames"].astype(np.float32) / np.float32(255) * np.float32(2) - np.float32(1) for x in items]
    return np.stack([f.transpose(0, 3, 1, 2) for f in frames]), [x["metadata"] for x in items]


class WindowIterable:
    """Windows of a table that `windows.produce_windows` made: batches of them, shuffled by a buffer with a seed.

    Partitions come to the driver one at a time, the next one while this one is in use; so no more than two and
    a buffer are held, however large the table is. Several loops each take a table of their own, by `consumers`.
    """

    def __init__(self, windows: DataFrame, batch: int, buffer: int = 64, seed: int = 0, drop_last: bool = False):
        self.windows, self.batch, self.buffer, self.seed, self.drop_last = windows.where("error is null"), batch, max(1, buffer), seed, drop_last

    def items(self) -> Iterator[dict]:
        """The windows, in the order in which buffers are filled, shuffled and emptied."""
        draw, waiting = random.Random(self.seed), []
        for row in self.windows.toLocalIterator(prefetchPartitions=True):
            metadata = {k: v for k, v in row.asDict().items() if k not in ("frames", "shape", "error")}
            waiting.append({"frames": np.frombuffer(row["frames"], np.uint8).reshape(row["shape"]), "metadata": metadata})
            if len(waiting) == self.buffer:
                draw.shuffle(waiting)
                yield from waiting
                waiting = []
        draw.shuffle(waiting)
        yield from waiting

    def __iter__(self) -> Iterator[tuple[np.ndarray, list[dict]]]:
        held: list[dict] = []
        for item in self.items():
            held.append(item)
            if len(held) == self.batch:
                yield collate(held)
                held = []
        if held and not self.drop_last:
            yield collate(held)
