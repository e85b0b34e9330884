"""Log-probabilities of texts by prediction by partial matching.

The model is a trie of byte contexts up to ``ORDER`` bytes long, with the symbols that follow
each. A symbol is predicted in the longest context that was seen; what the context does not
know escapes to the next shorter one (the escape counts as often as the context has different
symbols), and there the symbols of the longer context are excluded. Below the empty context
all symbols left are equally likely.

A text is lower-cased (A-Z), its words (runs other than blank and U+0009 to U+000D) stand
with one blank between them, and an end symbol closes it; ``ORDER`` start symbols go before
it, which are context only. 0xFE and 0xFF do not occur in UTF-8 and serve as start and end.

Learning: tasks count the (context, symbol) strings of their rows, an aggregation adds them
up over the corpus. All lower orders follow from the counts of the highest. Scoring: the
distinct strings of a batch are looked up once. The trie is given to the tasks in blocks of at
most ``BLOCK_ROWS`` strings, a pass over the texts for each: strings that end a context
with the same two bytes stay together, so each chain of escapes stays within a block, and the
two lowest orders (65,536 strings at most) go along with every block.

The base line is a unigram model with add-one smoothing. Counts of the most frequent
``RESIDENT_WORDS`` words go to the tasks; rarer words are joined by a shuffle.

Defined cases: null text counts as empty; an empty text is its end symbol. A null id is not
held out. Repeated rows count and are scored each. Without training rows every symbol has the
same probability and the base is 0 counts of 0. An empty table gives an empty result. Further
columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillweave.llm import wordhash
from rillweave.llm.common import Workspace, input_rows, settled
from rillweave.llm.counting import KeyCounts

ORDER = 5
BLOCK_ROWS = 3_000_000
RESIDENT_WORDS = 400_000
_START, _END, _BLANK = 0xFE, 0xFF, 0x20
#: Bytes 0 to 0xFD and the end.
_SYMBOLS = 255
#: Stands for the end among word hashes.
_END_WORD = np.uint64(0xE4D0F7EC7)
_STRINGS, _WORDS = 0, 1


def symbol_strings(data: np.ndarray, offsets: np.ndarray, order: int = ORDER):
    """Per symbol its string (context and symbol, packed into 64 bits), where each text
    begins among them, and word hashes with their rows."""
    n = len(offsets) - 1
    hashes, rows, starts, ends = wordhash.words(data, offsets)
    lengths = ends - starts
    words = np.bincount(rows, minlength=n)
    letters = np.bincount(rows, weights=lengths, minlength=n).astype(np.int64)
    # A text takes its start symbols, its words with a sign behind each, or the end alone.
    size = order + letters + np.maximum(words, 1)
    begin = np.concatenate(([0], np.cumsum(size)))
    stream = np.full(begin[-1], _BLANK, dtype=np.uint8)
    total = int(lengths.sum())
    if total:
        word = np.repeat(np.arange(len(starts)), lengths)
        within = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        first_word = np.concatenate(([0], np.cumsum(words)))[:-1]
        before = np.cumsum(lengths) - lengths
        letters_before = np.concatenate(([0], np.cumsum(letters)))[:-1]
        at = begin[rows] + order + (before - letters_before[rows]) + (np.arange(len(starts)) - first_word[rows])
        stream[at[word] + within] = wordhash.lower(data[starts[word] + within])
    stream[begin[1:] - 1] = _END
    for k in range(order):
        stream[begin[:-1] + k] = _START
    wide = stream.astype(np.uint64)
    packed = np.zeros(len(stream), dtype=np.uint64)
    for k in range(order + 1):
        back = order - k
        packed[back:] |= wide[: len(wide) - back] << np.uint64(8 * back)
    keep = np.ones(len(stream), dtype=bool)
    for k in range(order):
        keep[begin[:-1] + k] = False
    return packed[keep], (begin - order * np.arange(n + 1)), hashes, rows


def count_strings(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """kind, key, n: strings (kind 0) and words (kind 1) of column ``text``, added up over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings, words = KeyCounts(_STRINGS), KeyCounts(_WORDS)
        for batch in batches:
            data, offsets = wordhash.text_bytes(batch.column(0))
            for a, b in wordhash.chunks(offsets):
                packed, begin, hashes, _ = symbol_strings(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], order)
                yield from strings.add(packed)
                yield from words.add(np.concatenate((hashes, np.full(len(begin) - 1, _END_WORD))))
        yield from strings.flush()
        yield from words.flush()

    counted = docs.select("text").mapInArrow(run, "kind int, key bigint, n bigint")
    return counted.groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Trie:
    """Contexts and symbols of one block, as sorted arrays per order."""

    def __init__(self, strings: np.ndarray, counts: np.ndarray, low: np.ndarray, low_counts: np.ndarray, order: int):
        """``strings`` of the highest order, ``low``: all strings of order 1."""
        self.order = order
        self.strings: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.totals: list[np.ndarray] = []
        self.kinds: list[np.ndarray] = []
        self.shared: list[np.ndarray] = []
        for k in range(order + 1):
            source, n = (low, low_counts) if k < 2 else (strings, counts)
            keys, sums = _added(source & _mask(k + 1), n)
            context, first = np.unique(keys >> np.uint64(8), return_index=True)
            self.strings.append(keys)
            self.counts.append(sums)
            self.contexts.append(context)
            self.totals.append(np.add.reduceat(sums, first) if len(first) else np.empty(0, np.int64))
            self.kinds.append(np.diff(np.concatenate((first, [len(keys)]))))
            # How often the shorter context was followed by one of this context's symbols.
            if k and len(keys):
                at = np.searchsorted(self.strings[k - 1], keys & _mask(k))
                self.shared.append(np.add.reduceat(self.counts[k - 1][at], first))
            else:
                self.shared.append(np.zeros(len(context), np.int64))

    def log10(self, strings: np.ndarray) -> np.ndarray:
        """Log-probability of the last symbol of each string."""
        out = np.zeros(len(strings))
        left = np.arange(len(strings))
        excluded_n = np.zeros(len(strings), np.int64)
        excluded_kinds = np.zeros(len(strings), np.int64)
        for k in range(self.order, -1, -1):
            own = strings[left] & _mask(k + 1)
            c, seen = _find(self.contexts[k], own >> np.uint64(8))
            s, hit = _find(self.strings[k], own)
            total = np.where(seen, self.totals[k][c], 0) - excluded_n[left] if len(self.contexts[k]) else np.zeros(len(left))
            kinds = np.where(seen, self.kinds[k][c], 0) - excluded_kinds[left] if len(self.contexts[k]) else np.zeros(len(left))
            # Where nothing is left to predict, the escape is certain.
            weighs = seen & (kinds > 0)
            share = np.where(hit, self.counts[k][s] if len(self.strings[k]) else 0, kinds)
            out[left[weighs]] += np.log10(share[weighs] / (total + kinds)[weighs])
            if len(self.contexts[k]):
                on = left[seen & ~hit]
                excluded_n[on] = self.shared[k][c[seen & ~hit]]
                excluded_kinds[on] = self.kinds[k][c[seen & ~hit]]
            left = left[~hit]
        out[left] -= np.log10(_SYMBOLS - excluded_kinds[left])
        return out


def _mask(n_bytes: int) -> np.uint64:
    return np.uint64((1 << 8 * n_bytes) - 1)


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.empty(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else np.empty(0, np.int64)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), int), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _collected(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Columns key and n on the driver. For tables of bounded size."""
    t = df.select("key", "n").toArrow()
    return t["key"].to_numpy().view(np.uint64), t["n"].to_numpy()


def _blocks(sizes: list[tuple[int, int]], limit: int) -> list[list[int]]:
    """(group, rows) into blocks of at most ``limit`` rows; a larger group is a block of its own."""
    blocks: list[list[int]] = [[]]
    used = 0
    for group, rows in sizes:
        if blocks[-1] and used + rows > limit:
            blocks.append([])
            used = 0
        blocks[-1].append(group)
        used += rows
    return blocks


_LOADED: dict[str, Trie] = {}


def _trie(shared, order: int) -> Trie:
    """The trie of a broadcast block, built once per worker."""
    strings, counts, low, low_counts, _, name = shared.value
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = Trie(strings, counts, low, low_counts, order)
    return _LOADED[name]


def _in_trie(trie: Trie, groups: np.ndarray, packed: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Per text, the sum over the symbols whose context ends in one of ``groups``."""
    distinct, which = np.unique(packed, return_inverse=True)
    inside = groups[(distinct >> np.uint64(8) & np.uint64(0xFFFF)).astype(np.int64)]
    values = np.zeros(len(distinct))
    values[inside] = trie.log10(distinct[inside])
    return np.add.reduceat(values[which], begin[:-1])


def _score_block(docs: DataFrame, shared, order: int) -> DataFrame:
    """doc_id, text_hash, score in one block of the trie; a row per different document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, groups = _trie(shared, order), shared.value[4]
        for batch in batches:
            data, offsets = wordhash.text_bytes(batch.column(2))
            scores = np.zeros(batch.num_rows)
            for a, b in wordhash.chunks(offsets):
                packed, begin, _, _ = symbol_strings(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], order)
                scores[a:b] = _in_trie(trie, groups, packed, begin)
            yield pa.record_batch([*batch.columns[:2], pa.array(scores)], names=["doc_id", "text_hash", "score"])

    scored = docs.select("doc_id", "text_hash", "text").mapInArrow(run, "doc_id bigint, text_hash bigint, score double")
    return scored.groupBy("doc_id", "text_hash").agg(F.max("score").alias("score"))


def _score_first(docs: DataFrame, shared, frequent, order: int) -> DataFrame:
    """The score in the first block, n_tokens, known and logs (of the words given), rare (hashes of the others)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, groups = _trie(shared, order), shared.value[4]
        keys, counts = frequent.value
        for batch in batches:
            data, offsets = wordhash.text_bytes(batch.column(2))
            for a, b in wordhash.chunks(offsets):
                n = b - a
                packed, begin, hashes, rows = symbol_strings(
                    data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], order
                )
                scores = _in_trie(trie, groups, packed, begin)
                hashes = np.concatenate((hashes, np.full(n, _END_WORD)))
                rows = np.concatenate((rows, np.arange(n)))
                distinct, which = np.unique(hashes, return_inverse=True)
                at, hit = _find(keys, distinct)
                logs = np.where(hit, np.log10((counts[at] if len(keys) else 0) + 1.0), 0.0)[which]
                hit = hit[which]
                rare_rows = rows[~hit]
                by_row = np.argsort(rare_rows, kind="stable")
                borders = np.concatenate(([0], np.cumsum(np.bincount(rare_rows, minlength=n))))
                rare = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(hashes[~hit][by_row].view(np.int64)))
                part = batch.slice(a, n)
                yield pa.record_batch(
                    [
                        part.column(0), part.column(1), part.column(3),
                        pa.array(scores),
                        pa.array(np.bincount(rows, minlength=n)),
                        pa.array(np.bincount(rows, weights=hit, minlength=n).astype(np.int64)),
                        pa.array(np.bincount(rows, weights=logs, minlength=n)),
                        rare,
                    ],
                    names=["doc_id", "text_hash", "held_out", "score", "n_tokens", "known", "logs", "rare"],
                )

    return docs.select("doc_id", "text_hash", "text", "held_out").mapInArrow(
        run,
        "doc_id bigint, text_hash bigint, held_out boolean, score double, n_tokens bigint, known bigint, logs double,"
        " rare array<bigint>",
    )


def ppm_scores(
    docs: DataFrame, order: int = ORDER, block_rows: int = BLOCK_ROWS, resident_words: int = RESIDENT_WORDS,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of ``docs``.

    Rows with crc32(id as text) mod 7 = 2 are held out, the model learns from the others.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    own = input_rows(docs, doc_id=F.col(f"`{doc_id}`").cast("long"), text=text)
    held = F.expr("coalesce(crc32(cast(cast(doc_id as string) as binary)) % 7 = 2, false)")
    with Workspace(spark) as work:
        counts = work(count_strings(own.where(~held), order), "counts")
        strings, words = counts.where(f"kind = {_STRINGS}"), counts.where(f"kind = {_WORDS}")
        sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
        # Bounded: 65,536 groups, 65,536 strings of order 1.
        group = F.expr("shiftright(key, 8) & 65535")
        sizes = sorted(tuple(r) for r in strings.groupBy(group.alias("g")).count().collect())
        low = _collected(strings.groupBy(F.expr("key & 65535").alias("key")).agg(F.sum("n").alias("n")))
        seen = {g for g, _ in sizes}

        def block(groups: list[int], first: bool):
            member = np.zeros(1 << 16, dtype=bool)
            member[groups] = True
            if first:  # contexts that were never seen need the low orders alone: any block will do
                member[[g for g in range(1 << 16) if g not in seen]] = True
            own_strings = strings.where(group.between(groups[0], groups[-1])) if groups else strings.where("false")
            return sc.broadcast((*_collected(own_strings), *low, member, uuid.uuid4().hex))

        first, *others = _blocks(sizes, block_rows)

        # The smallest count whose words, with all more frequent ones, fit into the bound. The
        # numbers of words per count are few: their sum of counts is the number of tokens.
        by_count = words.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n"))
        least, room = None, resident_words
        for r in by_count.toLocalIterator():
            if r.words > room:
                break
            least, room = r.n, room - r.words
        frequent = words.where(F.col("n") >= least) if least is not None else words.where("false")
        keys, n = _collected(frequent)
        rank = np.argsort(keys)
        docs_ = own.select("doc_id", F.xxhash64("text").alias("text_hash"), "text", held.alias("held_out"))
        scored = _score_first(docs_, block(first, True), sc.broadcast((keys[rank], n[rank])), order)
        # Numbered when written: from there on the numbers are fixed.
        scored = work(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
        rare = words.where(F.col("n") < least) if least is not None else words
        found = (
            scored.selectExpr("row", "explode(rare) key")
            .groupBy("row", "key").count()
            .join(rare.select("key", "n"), "key")
            .groupBy("row")
            .agg(F.sum("count").alias("more"), F.sum(F.expr("count * log10(n + 1D)")).alias("more_logs"))
        )
        result = scored.drop("rare").join(found, "row", "left")
        for groups in others:
            part = _score_block(docs_, block(groups, False), order).selectExpr(
                "doc_id p_id", "text_hash p_hash", "score p_score"
            )
            result = result.join(part, F.expr("doc_id <=> p_id and text_hash = p_hash")).withColumn(
                "score", F.expr("score + p_score")
            ).drop("p_id", "p_hash", "p_score")
        return settled(
            result.select(
                "doc_id", "held_out", "n_tokens",
                F.expr("known + coalesce(more, 0)").alias("n_known"),
                F.lit(int(sums.n)).cast("long").alias("train_tokens"),
                F.expr(f"logs + coalesce(more_logs, 0D) - n_tokens * log10({int(sums.n) + int(sums.v) + 1}D)").alias("base_score"),
                "score",
            )
        )
