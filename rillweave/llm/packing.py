"""Conflict-constrained best-fit packing of documents into bins of one capacity.

Documents longer than a bin give full pieces and a rest. Pieces are dealt into groups by a
hash, each small enough for one task, and every group is packed on its own: longest piece
first, into the bin with the least room that still takes it. A bin holds one piece of a
source and one piece of a duplicate cluster at most; it carries bitmaps of both. The search
for a bin goes up from the exact fit, past bins in conflict, until it finds the tightest
compatible one, or opens a new bin.

A hot source or cluster spreads over the groups like any rows. Within a group, each size of
room remembers for which sources and clusters it holds nothing, so that their pieces do not
walk the same full bins again and again.

Lengths are UTF-8 bytes plus one for the end of the document, so pieces may end within a
character: this packs for byte-level models. The query packs what is given as ``length``.

Clusters come from the n-gram join (5 words, similarity 0.8); texts equal but for case and
blanks are of one cluster too. So packing costs a run of that join. Where it ran before and one
document of each class was kept, ``near_copies=False`` leaves it out: no two texts would link.

Defined cases: null and empty text have length 1 and no cluster. A null source counts as a
source. Repeated rows are rows of one cluster. An empty table gives an empty result. Further
columns are ignored.
"""

from __future__ import annotations

from bisect import insort
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillweave.llm import wordhash
from rillweave.llm.common import components, input_rows, settled, small_batches
from rillweave.llm.ngram_join import rooted_classes

CAPACITY = 8192
#: Documents of a group on average. Memory and time of a task follow it.
GROUP_ROWS = 16_384

SCHEMA = (
    "doc_id bigint, source string, piece bigint, piece_start bigint, piece_length bigint,"
    " bin_id bigint, bin_slot bigint, bin_offset bigint"
)


class BestFit:
    """Open bins, found by the room they have left."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.rooms: dict[int, list[int]] = defaultdict(list)  # room -> bins, lowest number first
        self.filled = np.zeros(capacity + 1, dtype=bool)
        #: Goes up when a bin gets this room; what failed at the same number fails still.
        self.version = np.zeros(capacity + 1, dtype=np.int32)
        self.failed: dict[tuple[str, int], np.ndarray] = {}
        self.room: list[int] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def _candidates(self, length: int, marks: list[np.ndarray]) -> np.ndarray:
        open_ = self.filled[length:].copy()
        for m in marks:
            open_ &= m[length:] != self.version[length:]
        return np.flatnonzero(open_) + length

    def place(self, length: int, source: int, cluster: int) -> int:
        """Bin of the next piece. ``source`` and ``cluster`` are bit numbers, -1: none."""
        bit_s, bit_c = (1 << source if source >= 0 else 0), (1 << cluster if cluster >= 0 else 0)
        keys = [k for k in (("s", source), ("c", cluster)) if k[1] >= 0]
        for room in self._candidates(length, [self.failed[k] for k in keys if k in self.failed]).tolist():
            without_s = without_c = False
            for b in self.rooms[room]:
                free_s, free_c = not self.sources[b] & bit_s, not self.clusters[b] & bit_c
                if free_s and free_c:
                    self._move(b, room, room - length, bit_s, bit_c)
                    return b
                without_s |= free_s
                without_c |= free_c
            for key, some in ((("s", source), without_s), (("c", cluster), without_c)):
                if not some and key[1] >= 0:
                    self.failed.setdefault(key, np.full(self.capacity + 1, -1, dtype=np.int32))[room] = self.version[room]
        self.room.append(self.capacity)
        self.sources.append(0)
        self.clusters.append(0)
        b = len(self.room) - 1
        self._move(b, None, self.capacity - length, bit_s, bit_c)
        return b

    def _move(self, b: int, old: int | None, new: int, bit_s: int, bit_c: int) -> None:
        if old is not None:
            self.rooms[old].remove(b)
            self.filled[old] = bool(self.rooms[old])
        self.room[b] = new
        self.sources[b] |= bit_s
        self.clusters[b] |= bit_c
        if new:
            insort(self.rooms[new], b)
            self.filled[new] = True
            self.version[new] += 1


def _bits(values: Iterable, shared_only: bool) -> list[int]:
    """A small number for each value; -1 for null and, if wanted, for values that occur once."""
    codes, _ = pd.factorize(pd.Series(values), use_na_sentinel=True)
    if shared_only and len(codes):
        counts = np.bincount(codes + 1)
        renumbered, _ = pd.factorize(np.where(counts[codes + 1] > 1, codes, -1), use_na_sentinel=False)
        return np.where((codes >= 0) & (counts[codes + 1] > 1), renumbered, -1).tolist()
    return codes.tolist()


def pack_group(pieces: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Packs the pieces of one group; the order of equal lengths is that of id and piece."""
    p = pieces.sort_values(["piece_length", "doc_id", "piece", "cluster", "source"], ascending=[False] + [True] * 4, kind="stable")
    fit = BestFit(capacity)
    sources = _bits(p["source"].fillna("\0"), shared_only=False)
    clusters = _bits(p["cluster"], shared_only=True)
    bins, slots, offsets, count = [], [], [], []
    for length, s, c in zip(p["piece_length"].tolist(), sources, clusters, strict=True):
        b = fit.place(length, s, c)
        if b == len(count):
            count.append(0)
        bins.append(b)
        slots.append(count[b])
        offsets.append(capacity - fit.room[b] - length)
        count[b] += 1
    return p.assign(bin=np.array(bins, dtype=np.int64), bin_slot=np.array(slots, dtype=np.int64), bin_offset=np.array(offsets, dtype=np.int64))


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first column as it is, the texts of the second in lower case, without blank and U+0009 to U+000D."""
    for batch in batches:
        data, offsets = wordhash.text_bytes(batch.column(1))
        kept = ~wordhash.is_space(data)
        ends = np.concatenate(([0], np.cumsum(kept)))[offsets]
        small = wordhash.lower(data[kept])
        if len(small) and small.max() >= 128:
            lines = [small[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            # Spark's strings may hold bytes that are no UTF-8; they stay as they are.
            texts = [
                x.tobytes().decode(errors="surrogateescape").lower().encode(errors="surrogateescape")
                if len(x) and x.max() >= 128 else x.tobytes()
                for x in lines
            ]
            letters = pa.array(texts, pa.binary())
        else:
            letters = pa.Array.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(small)])
        yield pa.record_batch([batch.column(0), letters], names=["text_hash", "letters"])


def clusters(docs: DataFrame, near_copies: bool = True) -> DataFrame:
    """text_hash, cluster of each different text but the empty one (columns doc_id, text)."""
    # Blanks and case go in a task's Python: SQL's translate and lower take most of the time of this step.
    letters = docs.where("text <> ''").selectExpr("xxhash64(text) text_hash", "text").mapInArrow(
        _letters, "text_hash bigint, letters binary"
    )
    keys = letters.selectExpr("text_hash", "xxhash64(letters) key").groupBy("text_hash").agg(F.min("key").alias("key"))
    if not near_copies:
        return keys.selectExpr("text_hash", "key cluster")
    roots = rooted_classes(docs).groupBy("text_hash").agg(F.min("root").alias("root"))
    texts = settled(keys.join(roots, "text_hash", "left").selectExpr("text_hash", "key", "coalesce(root, key) node"))
    # Classes with texts of one key are one cluster.
    first = texts.groupBy("key").agg(F.min("node").alias("u"), F.max("node").alias("last")).where("u <> last").select("key", "u")
    names = components(texts.join(first, "key").selectExpr("u", "node v")).withColumnRenamed("root", "cluster")
    return texts.join(names, "node", "left").selectExpr("text_hash", "coalesce(cluster, node) cluster")


def pack(
    docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS,
    doc_id: str = "doc_id", text: str = "text", source: str = "source", near_copies: bool = True,
) -> DataFrame:
    """doc_id, source, piece, piece_start, piece_length, bin_id, bin_slot, bin_offset: a row per piece.

    Clusters are the classes of near copies of the n-gram join, and texts equal but for case and blanks; the latter alone
    without ``near_copies``.
    """
    own = input_rows(docs, doc_id=F.col(f"`{doc_id}`").cast("long"), source=F.col(f"`{source}`").cast("string"), text=text)
    with small_batches(docs.sparkSession):
        narrow = settled(
            own.selectExpr(
                "doc_id", "source",
                "cast(coalesce(octet_length(text), 0) + 1 as bigint) length",
                # The exact text takes part in the deal, so that rows of one id spread too.
                "xxhash64('deal', doc_id, text) deal",
                "xxhash64(coalesce(text, '')) text_hash",
            ).join(clusters(own, near_copies), "text_hash", "left")
        )
    groups = max(1, -(-narrow.count() // group_rows))
    pieces = narrow.selectExpr(
        f"pmod(deal, {groups}) g", "doc_id", "source", "cluster", "length",
        f"explode(sequence(0L, (length - 1) div {capacity})) piece",
    ).selectExpr("g", "doc_id", "source", "cluster", "piece", f"least({capacity}, length - piece * {capacity}) piece_length")

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        packed = pack_group(rows, capacity)
        packed["bin_id"] = (int(key[0]) << 32) + packed["bin"]
        packed["piece_start"] = packed["piece"] * capacity
        return packed[[c.split()[0] for c in SCHEMA.split(", ")]]

    return pieces.groupBy("g").applyInPandas(run, SCHEMA)
