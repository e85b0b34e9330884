"""Token-sorted Indel similarity.

The longest common subsequence of two texts is found bit-parallel: a machine word holds 64 letters
of one text, and a letter of the other takes a few operations on it. That runs over an Arrow batch
of pairs at once, so a pair costs no Python step of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from rillweave.functions.text import WHITESPACE_CLASS, quote, strip

_WORD = 64
#: Letters of the texts that are compared in one step, padding included.
_STEP_LETTERS = 1 << 20


def token_sort(x: str) -> str:
    """Words in code point order, joined by one blank: the key under which word order is moot."""
    return f"array_join(sort_array(split({strip(x)}, {quote(WHITESPACE_CLASS + '+')})), ' ')"


def _padded(texts: list[str], width: int, filler: int) -> np.ndarray:
    """The code points of each text, a row each, filled up to ``width``."""
    lengths = np.array([len(t) for t in texts])
    letters = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.full((len(texts), width), filler, dtype=np.uint32)
    out[np.arange(width) < lengths[:, None]] = letters
    return out


def _lcs_of_rows(xs: list[str], ys: list[str], words: int) -> np.ndarray:
    """Lengths for pairs in which x fills ``words`` machine words at most; longest y first.

    A zero bit stands for a letter of x at which the subsequence with what was read of y grows.
    """
    x = _padded(xs, words * _WORD, 0xFFFFFFFF)
    y = _padded(ys, len(ys[0]), 0xFFFFFFFE)
    # Rows whose y has more than j letters come first.
    active = len(ys) - np.searchsorted(np.array([len(t) for t in ys])[::-1], np.arange(len(ys[0])), "right")
    state = np.full((len(xs), words), np.uint64(0xFFFFFFFFFFFFFFFF))
    for j, n in enumerate(active.tolist()):
        match = np.packbits(x[:n] == y[:n, j : j + 1], axis=1, bitorder="little").view("<u8")
        carry = np.zeros(n, dtype=np.uint64)
        for w in range(words):
            v, m = state[:n, w], match[:, w]
            hit = v & m
            total = v + hit
            over = total < hit
            total += carry
            over |= total < carry
            carry = over.astype(np.uint64)
            state[:n, w] = total | (v & ~m)
    return words * _WORD - np.bitwise_count(state).sum(axis=1, dtype=np.int64)


def lcs_lengths(xs: list[str], ys: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair, in letters (code points)."""
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(xs, ys, strict=True)]
    words = np.array([-(-len(x) // _WORD) for x, _ in pairs], dtype=np.int64)
    longest = np.array([len(y) for _, y in pairs], dtype=np.int64)
    out = np.zeros(len(pairs), dtype=np.int64)
    order = np.lexsort((-longest, words))
    order = order[words[order] > 0]
    at = 0
    while at < len(order):
        w, y = words[order[at]], longest[order[at]]
        same = int(np.searchsorted(words[order], w, "right"))
        stop = min(same, at + max(1, _STEP_LETTERS // int(w * _WORD + y)))
        rows = order[at:stop]
        out[rows] = _lcs_of_rows([pairs[r][0] for r in rows], [pairs[r][1] for r in rows], int(w))
        at = stop
    return out


@F.arrow_udf(IntegerType())
def _lcs_column(a: pa.Array, b: pa.Array) -> pa.Array:
    known = [(x, y) if x is not None and y is not None else ("", "") for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)]
    lengths = lcs_lengths([x for x, _ in known], [y for _, y in known]).astype(np.int32)
    return pa.array(lengths, mask=np.array(a.is_null()) | np.array(b.is_null()))


# A filter on its result is not pushed below its computation, which would repeat it.
_lcs_once = _lcs_column.asNondeterministic()


def lcs_length(a: str, b: str) -> Column:
    """Length of the longest common subsequence of two texts; null if one is null."""
    return _lcs_once(F.expr(a), F.expr(b))


def indel_distance(a: str, b: str) -> Column:
    """Letters that have to be inserted or deleted to turn one text into the other."""
    return F.expr(f"length({a}) + length({b})") - 2 * lcs_length(a, b)


def similarity(distance: str, total_length: str) -> str:
    """0..100 from an Indel distance; two empty texts are equal."""
    return f"(1.0D - cast({distance} AS double) / greatest({total_length}, 1)) * 100.0D"


def allowed_distance(total_length: str, threshold: int) -> str:
    """Largest Indel distance that still scores ``threshold``, in whole numbers."""
    return f"cast({100 - threshold} * ({total_length}) div 100 AS int)"


def token_sort_ratio(a: str, b: str) -> Column:
    x, y = token_sort(a), token_sort(b)
    total = F.greatest(F.expr(f"length({x}) + length({y})"), F.lit(1))
    return (F.lit(1.0) - indel_distance(x, y).cast("double") / total) * 100.0
