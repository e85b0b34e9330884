"""Counts of 64-bit keys within a task, of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


class KeyCounts:
    """Adds up keys of one kind. What exceeds ``limit`` different keys is given out early:
    the aggregation behind adds the parts up."""

    def __init__(self, kind: int, limit: int = 500_000):
        self.kind, self.limit = kind, limit
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(keys):
            return
        self.parts.append(np.unique(keys, return_counts=True))
        self.size += len(self.parts[-1][0])
        if self.size > 2 * self.limit:
            self._merge()
            if self.size > self.limit:
                yield from self.flush()

    def _merge(self) -> None:
        if len(self.parts) > 1:
            keys = np.concatenate([k for k, _ in self.parts])
            counts = np.concatenate([n for _, n in self.parts])
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order]
            first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            self.parts = [(keys[first], np.add.reduceat(counts, first))]
        self.size = sum(len(k) for k, _ in self.parts)

    def flush(self) -> Iterator[pa.RecordBatch]:
        self._merge()
        for keys, counts in self.parts:
            for start in range(0, len(keys), 100_000):
                k = keys[start : start + 100_000]
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(k), self.kind, dtype=np.int32)),
                        pa.array(k.astype(np.uint64).view(np.int64)),
                        pa.array(counts[start : start + 100_000].astype(np.int64)),
                    ],
                    names=["kind", "key", "n"],
                )
        self.parts, self.size = [], 0
