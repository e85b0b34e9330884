"""Vectorised words and word windows of a batch of UTF-8 texts.

A word is a run of bytes other than blank and U+0009 to U+000D; A-Z count as lower case.
Everything works on the bytes of a whole Arrow batch at once, so the cost per byte does not
depend on how long the single texts are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_WINDOW_BASE = 0xD6E8FEB86659FD93 | 1
#: Texts of one pass: about this many bytes, at least one text. A task's memory follows it: there are
#: numbers of eight bytes for each byte.
CHUNK_BYTES = 1 << 19


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 to base^(n-1). Those of a usual chunk are kept, those of a longer text are not."""
    if n <= 2 * CHUNK_BYTES:
        if len(_known.get(base, ())) < n:
            _known[base] = _new_powers(base, max(n, CHUNK_BYTES))
        return _known[base][:n]
    return _new_powers(base, n)


_known: dict[int, np.ndarray] = {}


def _new_powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, out=out)


def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every bit depends on every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Of each byte, with A-Z in lower case.
_VALUE_LOW = _byte_values()[_LOWER]


def is_space(data: np.ndarray) -> np.ndarray:
    """Which bytes are blank or U+0009 to U+000D."""
    return _IS_SPACE[data]


def lower(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case."""
    return _LOWER[data]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n+1 offsets of its rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES):
    """Row ranges of about ``limit`` bytes each."""
    start, n = 0, len(offsets) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        yield start, stop
        start = stop


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row, start and end of each word, in order."""
    n = len(data)
    if n == 0:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3)))
    inside = ~_IS_SPACE[data]
    first = np.zeros(n, dtype=bool)
    rows_with_text = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[rows_with_text] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:]
    starts = np.flatnonzero(begins)
    ends_here = inside.copy()
    ends_here[:-1] &= ~inside[1:] | first[1:]
    ends = np.flatnonzero(ends_here) + 1
    # Hash of a word: the sum of value(byte) * base^place, as a difference of running sums
    # that is brought back to place 0 by the inverse power.
    # One array of numbers a byte at a time, changed in place.
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.take(_VALUE_LOW, data, out=sums[1:], mode="clip")  # clip: without a buffer
    sums[1:] *= _powers(_BASE, n)
    np.cumsum(sums[1:], out=sums[1:])
    hashes = sums[ends] - sums[starts]
    del sums
    hashes *= _powers(pow(_BASE, -1, 1 << 64), n)[starts]
    hashes = mix(hashes + (ends - starts).astype(np.uint64))
    rows = np.searchsorted(offsets, starts, "right") - 1
    return hashes, rows, starts, ends


def windows(hashes: np.ndarray, rows: np.ndarray, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each window of ``width`` words; a row with fewer words has one of all of them."""
    counts = np.bincount(rows, minlength=n_rows)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    total = len(hashes)
    if total == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    place = np.arange(total) - first[rows]
    starts = np.flatnonzero(place <= np.maximum(counts[rows] - width, 0))
    owner = rows[starts]
    size = np.minimum(counts[owner], width)
    out = np.zeros(len(starts), dtype=np.uint64)
    padded = np.concatenate((hashes, np.zeros(width, np.uint64)))
    for k in range(width):
        term = mix(padded[starts + k] + np.uint64((_WINDOW_BASE * (k + 1)) & _MASK))
        out = out * np.uint64(_WINDOW_BASE) + np.where(k < size, term, np.uint64(0))
    return mix(out + size.astype(np.uint64)), owner


def shingle_sets(column: pa.Array, width: int):
    """Sorted distinct window hashes of each text: yields (first row, offsets, hashes) per chunk."""
    data, offsets = text_bytes(column)
    for start, stop in chunks(offsets):
        part = data[offsets[start] : offsets[stop]]
        hashes, rows, _, _ = words(part, offsets[start : stop + 1] - offsets[start])
        shingles, owner = windows(hashes, rows, stop - start, width)
        borders = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=stop - start))))
        for a, b in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
            shingles[a:b].sort()
        keep = np.ones(len(shingles), dtype=bool)
        keep[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
        shingles, owner = shingles[keep], owner[keep]
        counts = np.bincount(owner, minlength=stop - start)
        yield start, np.concatenate(([0], np.cumsum(counts))), shingles
