"""Similarity join of documents on their sets of word n-grams, by skipping over set relations.

Two documents link when the Jaccard similarity of their sets reaches a threshold. The join is
exact. What it returns are the classes of linked documents.

1. Equal sets are one set from here on. Each set is ordered by one global order: n-grams in
   the order of their hashes, frequent ones (found in a sample) last. Sets that link share
   an n-gram within their prefixes (n - ceil(t n) + 1 of n), at positions that leave enough
   n-grams behind.
2. The prefixes form index lists, cut into blocks by set size; sizes that cannot link never
   meet. Each block has a leader. First, each set is compared with the leaders of its blocks
   only, and neighbouring leaders with each other: as many pairs as entries. The links give
   classes.
3. Blocks whose sets fell into one class are skipped: there is nothing left to find. In the
   others, sets outside of the list's main class, the largest, are compared with all sets of other
   classes, unless size, position or the answers of a common leader forbid a link: what two
   sets share beyond the leader is at most what either has beyond it.
4. Pairs are checked against bitmaps of the sets, which bound the overlap from above, and what
   remains against the sets themselves.

So a group of near copies costs a comparison per copy and list, not one per pair, and a
passage shared by many documents does not enter the prefixes. Lists of frequent n-grams, groups
and classes are never gathered in one place: those steps are joins and aggregations, and where a
key owns many rows, one side of the join is a row per key, so the other can be split. Lists of
rare n-grams are short; a task gets a bucket of them and finds shared lists, blocks and leaders.

Defined cases: null or empty text, or text without words, has an empty set and links with
nothing. Fewer words than n form one n-gram. Repeated rows and equal ids: each row gets its
own result; a class is named by its smallest id, null only if it has no other. An empty table
gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillweave.llm import wordhash
from rillweave.llm.common import Workspace, components, input_rows, settled, small_batches
from rillweave.llm.counting import KeyCounts

WIDTH = 5
PERCENT = 80
#: One document in so many tells which n-grams are frequent, and how often one must occur there.
SAMPLE, FREQUENT = 16, 8
#: So many frequent n-grams go to the back of the order. The order affects cost only.
FREQUENT_KEPT = 200_000
#: N-grams travel packed, a row per bucket of their hashes and chunk: a row for each costs several times their work.
#: Buckets in which those of the sample are counted; rare n-grams of a bucket of the lists, and of a chunk, on average.
_COUNT_BUCKETS, _BUCKET, _CHUNK = 256, 1 << 18, 1 << 20
#: Keys that are given to all tasks rather than joined by a shuffle.
RESIDENT_KEYS = 500_000
#: Words of a bitmap at least, a power of two. It travels with each pair that is looked at. Larger sets have larger ones,
#: of two to four bits an n-gram: those of a fixed size are full, and bound nothing, for some thousand n-grams.
_BITMAP_WORDS = 32
#: Words of the bitmap that travels with each entry of step 3, a power of two.
_SMALL_WORDS = 16
#: Steps that shuffle all prefixes run in so many parts, one after the other, so that what is on disk at once is a part
#: of them. Steps that shuffle whole sets do so too if the sets of all their pairs are as much as all sets, else in fewer.
PARTS = 4
#: N-grams of such a part at least: fewer do not fill a disk, and each part is a round of small tasks.
PART_NGRAMS = 1 << 26


def _dealt(tokens: np.ndarray, buckets: int, *columns: np.ndarray) -> pa.RecordBatch:
    """A row per bucket of ``tokens`` that is not empty, the numbers of each column packed into bytes. Tokens are hashes."""
    bucket = (tokens.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bounds = np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=buckets))))
    some = np.flatnonzero(np.diff(bounds)).astype(np.int32)
    offsets = pa.py_buffer(np.append(bounds[some], len(tokens)).astype(np.int32) * np.int32(8))
    packed = [
        pa.Array.from_buffers(pa.binary(), len(some), [None, offsets, pa.py_buffer(c[order].view(np.int64))])
        for c in (tokens, *columns)
    ]
    return pa.record_batch([pa.array(some), *packed], names=["bucket", *(f"c{k}" for k in range(len(packed)))])


def _dealt_schema(columns: int) -> str:
    return ", ".join(["bucket int", *(f"c{k} binary" for k in range(columns))])


def _gathered(rows: pa.Table, columns: int) -> list[np.ndarray]:
    """The columns of all rows of a bucket, as ``_dealt`` got them."""
    return [np.frombuffer(b"".join(rows.column(f"c{k}").to_pylist()), dtype=np.int64) for k in range(columns)]


def _frequent(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of many documents of a sample, sorted, and their place in the order, rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = KeyCounts(0)
        for batch in batches:
            for _, _, shingles in wordhash.shingle_sets(batch.column(0), width):
                for some in counts.add(shingles):
                    yield _dealt(some.column(1).to_numpy(), _COUNT_BUCKETS, some.column(2).to_numpy())
        for some in counts.flush():
            yield _dealt(some.column(1).to_numpy(), _COUNT_BUCKETS, some.column(2).to_numpy())

    def summed(rows: pa.Table) -> pa.Table:
        tokens, n = _gathered(rows, 2)
        order = np.argsort(tokens)
        tokens, n = tokens[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        n = np.add.reduceat(n, first)
        many = n >= FREQUENT
        return pa.table({"key": tokens[first][many], "n": n[many]})

    sample = (
        docs.select("text", F.xxhash64("text").alias("h"))
        .where(f"pmod(h, {SAMPLE}) = 0")
        .groupBy("h").agg(F.first("text").alias("text"))  # copies count once
        .select("text")
    )
    counted = sample.mapInArrow(run, _dealt_schema(2)).groupBy("bucket").applyInArrow(summed, "key bigint, n bigint")
    rows = counted.orderBy(F.desc("n"), "key").limit(FREQUENT_KEPT).toArrow()
    keys = rows["key"].to_numpy().view(np.uint64)
    place = np.arange(len(keys), 0, -1)
    order = np.argsort(keys)
    return keys[order], place[order]


def _needed(n, percent: int):
    """Smallest overlap of a set of n with a set that it links with."""
    return -(-n * percent // 100)


def _bitmaps(shingles: np.ndarray, owner: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of the rows, and the words of their bitmaps. A bitmap's halves, or-ed, are the next smaller one."""
    words = np.maximum(_BITMAP_WORDS, 1 << np.ceil(np.log2(np.maximum(n, 1) / 32)).astype(np.int64).clip(0))
    offsets = np.concatenate(([0], np.cumsum(words)))
    bits = np.zeros(offsets[-1] * 64, dtype=bool)
    bits[(offsets[owner] << 6) + (shingles & (words[owner] * 64 - 1).astype(np.uint64)).astype(np.int64)] = True
    return offsets, np.packbits(bits).view(np.int64)


def _late(shingles: np.ndarray, owner: np.ndarray, keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of each row in the global order, those of ``keys`` last, and which ones are of ``keys``."""
    if not len(keys) or not len(shingles):
        return shingles, np.zeros(len(shingles), dtype=bool)
    at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
    late = np.where(keys[at] == shingles, places[at], 0)
    # Hash order holds already; only rows with frequent n-grams change.
    has = np.zeros(owner[-1] + 1, dtype=bool)
    has[owner[late > 0]] = True
    moved = np.flatnonzero(has[owner])
    out, of_keys = shingles.copy(), late > 0
    order = moved[np.lexsort((late[moved], owner[moved]))]
    out[moved], of_keys[moved] = shingles[order], late[order] > 0
    return out, of_keys


def _sets(docs: DataFrame, shared, width: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n, sig, bitmap of each row, and its prefix: rare n-grams packed, frequent ones behind them as a list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, places = shared.value
        for batch in batches:
            for start, borders, shingles in wordhash.shingle_sets(batch.column(2), width):
                n = np.diff(borders)
                rows = len(n)
                owner = np.repeat(np.arange(rows), n)
                sums = np.zeros(rows, dtype=np.uint64)
                full = np.flatnonzero(n)
                if len(full):
                    sums[full] = np.add.reduceat(wordhash.mix(shingles), borders[full])
                sig = wordhash.mix(sums + n.astype(np.uint64))
                ordered, of_keys = _late(shingles, owner, keys, places)
                take = np.where(n > 0, n - _needed(n, percent) + 1, 0)
                within = np.arange(len(shingles)) - np.repeat(borders[:-1], n)
                in_prefix = within < np.repeat(take, n)
                rare, common = np.flatnonzero(in_prefix & ~of_keys), np.flatnonzero(in_prefix & of_keys)
                ends = [np.concatenate(([0], np.cumsum(np.bincount(owner[x], minlength=rows)))).astype(np.int32) for x in (rare, common)]
                packed = [None, pa.py_buffer(ends[0] * np.int32(8)), pa.py_buffer(ordered[rare])]
                places_of_maps, maps = _bitmaps(shingles, owner, n)
                part = batch.slice(start, rows)
                yield pa.record_batch(
                    [
                        part.column(0), part.column(1), pa.array(n), pa.array(sig.view(np.int64)),
                        pa.Array.from_buffers(pa.binary(), rows, packed),
                        pa.ListArray.from_arrays(pa.array(ends[1], pa.int32()), pa.array(ordered[common].view(np.int64))),
                        pa.ListArray.from_arrays(pa.array(places_of_maps, pa.int32()), pa.array(maps)),
                    ],
                    names=["doc_id", "text_hash", "n", "sig", "rare", "common", "bitmap"],
                )

    return docs.select("doc_id", "text_hash", "text").mapInArrow(
        run, "doc_id bigint, text_hash bigint, n bigint, sig bigint, rare binary, common array<bigint>, bitmap array<bigint>"
    )


#: An entry: a set in the list of a token. lead: the leader of its block (token, s). met: what step 2 compares it with, the
#: leader, or for a leader that of the block below. size: entries of the list.
_ENTRY = (
    "token bigint, s int, sig bigint, n bigint, pos int, size bigint, lead bigint, met bigint, met_n bigint, met_pos int"
)


def _rare_entries(classes: DataFrame, percent: int, buckets: int, part: int, parts: int) -> DataFrame:
    """The entries of rare n-grams in shared lists, of one part of the buckets.

    A rare n-gram is none of the most frequent ones, so its list is short, and a bucket of such lists fits a task.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            sig, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            packed = batch.column(2).cast(pa.large_binary())
            ends = np.frombuffer(packed.buffers()[1], np.int64)[packed.offset : packed.offset + len(packed) + 1]
            tokens = np.frombuffer(packed.buffers()[2] or b"", np.int64)[ends[0] // 8 : ends[-1] // 8]
            many = np.diff(ends) // 8
            owner = np.repeat(np.arange(len(many)), many)
            at = (n[owner] << 32) + np.arange(len(tokens)) - (ends[:-1] // 8 - ends[0] // 8)[owner]
            mine = tokens.view(np.uint64) % np.uint64(buckets) % np.uint64(parts) == part if parts > 1 else slice(None)
            held.append((tokens[mine].copy(), sig[owner[mine]], at[mine]))
            count += len(held[-1][0])
            if count >= _CHUNK:
                yield _dealt(*_chunk(held, buckets))
                held, count = [], 0
        if count:
            yield _dealt(*_chunk(held, buckets))

    def listed(rows: pa.Table) -> pa.Table:
        token, sig, at = _gathered(rows, 3)
        order = np.argsort(token)
        first = np.concatenate(([True], np.diff(token[order]) != 0))
        size = np.diff(np.append(np.flatnonzero(first), len(token)))
        size = np.repeat(size, size)
        order, size = order[size > 1], size[size > 1]
        token, sig, at = token[order], sig[order], at[order]
        n, pos = at >> 32, at & 0x7FFFFFFF
        s = np.floor(np.log(n) / np.log(100 / percent)).astype(np.int32)
        # Another leader in each list: a near copy is compared with as many others as it has
        # lists, so the copies of one text hang together after this step.
        order = np.lexsort((wordhash.mix(sig.view(np.uint64) ^ wordhash.mix(token.view(np.uint64))), s, token))
        token, s, sig, n, pos, size = (x[order] for x in (token, s, sig, n, pos, size))
        leads = np.ones(len(token), dtype=bool)
        leads[1:] = (token[1:] != token[:-1]) | (s[1:] != s[:-1])
        lead = np.flatnonzero(leads)
        block = np.cumsum(leads) - 1
        below = np.concatenate((lead[:1], lead[:-1]))  # of each block, the leader of the one before
        near = (token[lead] == token[below]) & (s[lead] == s[below] + 1)
        met = np.where(leads, below[block], lead[block])
        none = leads & ~near[block]
        return pa.table({
            "token": token, "s": s, "sig": sig, "n": n, "pos": pos.astype(np.int32), "size": size, "lead": sig[lead[block]],
            "met": pa.array(sig[met], mask=none), "met_n": pa.array(n[met], mask=none),
            "met_pos": pa.array(pos[met].astype(np.int32), mask=none),
        })

    dealt = classes.select("sig", "n", "rare").where("rare <> x''").mapInArrow(deal, _dealt_schema(3))
    return dealt.groupBy("bucket").applyInArrow(listed, _ENTRY)


def _chunk(held: list[tuple[np.ndarray, ...]], buckets: int) -> tuple:
    token, *others = (np.concatenate(c) for c in zip(*held, strict=True))
    return token, buckets, *others


def _common_entries(classes: DataFrame, work: Workspace, percent: int) -> DataFrame:
    """The entries of frequent n-grams in shared lists, which are never gathered in one place."""
    listed = classes.where("size(common) > 0").selectExpr(
        "sig", "n", "cast(octet_length(rare) div 8 as int) before", "posexplode(common) as (place, token)"
    ).selectExpr("sig", "token", "n", "before + place pos", f"cast(floor(ln(n) / ln({100 / percent}D)) as int) s")
    shared = listed.groupBy("token").agg(F.count("*").alias("size")).where("size > 1")
    # One row a token on that side, so a hash table of it is small and the entries need no sorting.
    entries = work(listed.join(shared.hint("shuffle_hash"), "token"), "listed")
    leaders = work(
        entries.groupBy("token", "s").agg(F.min(F.struct(F.xxhash64("sig", "token"), "sig", "n", "pos")).alias("lead"))
        .selectExpr("token", "s", "lead.sig lead", "lead.n lead_n", "lead.pos lead_pos"),
        "leaders",
    )
    below = leaders.selectExpr("token", "s + 1 s", "lead below", "lead_n below_n", "lead_pos below_pos")
    return entries.join(leaders.join(below, ["token", "s"], "left"), ["token", "s"]).selectExpr(
        "token", "s", "sig", "n", "pos", "size", "lead", "if(sig = lead, below, lead) met",
        "if(sig = lead, below_n, lead_n) met_n", "if(sig = lead, below_pos, lead_pos) met_pos",
    )


def _whole_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """sig, tokens of the texts whose hash is in ``wanted`` (text_hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, borders, shingles in wordhash.shingle_sets(batch.column(1), width):
                rows = len(borders) - 1
                yield pa.record_batch(
                    [
                        batch.column(0).slice(start, rows),
                        pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(shingles.view(np.int64))),
                    ],
                    names=["sig", "tokens"],
                )

    few = wanted.count() <= RESIDENT_KEYS
    texts = docs.select("text_hash", "text").join(F.broadcast(wanted) if few else wanted, "text_hash")
    once = texts.groupBy("sig").agg(F.first("text").alias("text"))
    return once.mapInArrow(run, "sig bigint, tokens array<bigint>")


class _Join:
    """The steps of one run."""

    def __init__(self, docs: DataFrame, work: Workspace, width: int, percent: int):
        self.docs, self.work, self.width, self.percent = docs, work, width, percent
        self.steps = 0
        shared = docs.sparkSession.sparkContext.broadcast(_frequent(docs, width))
        self.rows = work(_sets(docs, shared, width, percent), "rows")
        self.ids = work(self.rows.select("doc_id", "text_hash", "n", "sig"), "ids")
        self.size = self.ids.agg(F.sum("n")).first()[0] or 0
        # A row per different set. Its n-grams are computed again, where needed, from a text that has it.
        self.classes = work(
            self.rows.where("n > 0").groupBy("sig").agg(
                F.min("n").alias("n"), F.min("doc_id").alias("doc_id"), F.min("text_hash").alias("text_hash"),
                *(F.first(c).alias(c) for c in ("rare", "common", "bitmap")),
            ),
            "classes",
        )
        work.drop("rows")

    def least_overlap(self, a: str, b: str) -> str:
        """SQL for the smallest overlap with which sets of sizes a and b link."""
        p = self.percent
        return f"(({p} * ({a} + {b}) + {99 + p}) div {100 + p})"

    def could_link(self, a: str, pa_: str, b: str, pb: str) -> str:
        """SQL: sizes and positions of a common n-gram, the first one, allow a link."""
        return (
            f"100 * least({a}, {b}) >= {self.percent} * greatest({a}, {b})"
            f" and 1 + least({a} - {pa_} - 1, {b} - {pb} - 1) >= {self.least_overlap(a, b)}"
        )

    def checked(self, pairs: DataFrame) -> DataFrame:
        """a, b, na, nb, low, high (bounds of the overlap), linked; of distinct pairs with a < b."""
        self.steps += 1
        maps = self.classes.select("sig", "bitmap", "text_hash")
        left = maps.withColumnsRenamed({"sig": "a", "bitmap": "map_a", "text_hash": "hash_a"})
        right = maps.withColumnsRenamed({"sig": "b", "bitmap": "map_b", "text_hash": "hash_b"})
        bounded = self.work(
            pairs.join(left, "a").join(right, "b").selectExpr(
                "a", "b", "na", "nb", "hash_a", "hash_b",
                f"{_high('na', 'nb', 'map_a', 'map_b')} high",
            ).withColumn("open", F.expr(f"high >= {self.least_overlap('na', 'nb')}")),
            f"bounded{self.steps}",
        )
        still = bounded.where("open")
        volume = still.agg(F.sum(F.col("na") + F.col("nb"))).first()[0] or 0
        # The shares of the sets' whole size that the pairs carry; none is open: no part.
        parts = min(PARTS, -(-volume // max(PART_NGRAMS, self.size // PARTS)))
        done = []
        for k in range(parts):
            part, sets = still.where(f"pmod(a, {parts}) = {k}"), f"sets{self.steps}_{k}"
            wanted = settled(part.selectExpr("a sig", "hash_a text_hash").union(part.select("b", "hash_b")).distinct())
            whole = self.work(_whole_sets(self.docs, wanted, self.width), sets)
            overlaps = (
                part.select("a", "b", "na", "nb")
                .join(whole.selectExpr("sig a", "tokens tokens_a"), "a")
                .join(whole.selectExpr("sig b", "tokens tokens_b"), "b")
                .selectExpr("a", "b", "na", "nb", "cast(size(array_intersect(tokens_a, tokens_b)) as bigint) common")
            )
            linked = f"100 * common >= {self.percent} * (na + nb - common) linked"
            done.append(self.work(overlaps.selectExpr("a", "b", "na", "nb", "common low", "common high", linked), f"overlaps{self.steps}_{k}"))
            self.work.drop(sets)
        skipped = bounded.where("not open").selectExpr("a", "b", "na", "nb", "0L low", "high", "false linked")
        checked = self.work(reduce(DataFrame.unionByName, done, skipped), f"checked{self.steps}")
        self.work.drop(f"bounded{self.steps}", *(f"overlaps{self.steps}_{k}" for k in range(parts)))
        return checked

    def star(self) -> tuple[DataFrame, DataFrame]:
        """Entries of shared n-grams, and the pairs of step 2."""
        rare, common = self.classes.agg(F.sum(F.expr("octet_length(rare) div 8")), F.sum(F.size("common"))).first()
        parts = min(PARTS, -(-(rare or 0) // PART_NGRAMS))
        buckets = parts * -(-(rare or 0) // (_BUCKET * max(1, parts)))
        done = [
            self.work(_rare_entries(self.classes, self.percent, buckets, k, parts), f"entries{k}") for k in range(parts)
        ]
        if common:
            done.append(self.work(_common_entries(self.classes, self.work, self.percent), "entries_common"))
            self.work.drop("listed", "leaders")
        nothing = self.classes.sparkSession.createDataFrame([], _ENTRY)
        entries = reduce(DataFrame.unionByName, done) if done else nothing
        met = entries.where("met is not null").where(self.could_link("n", "pos", "met_n", "met_pos"))
        return entries, self.checked(met.selectExpr(*_ordered("sig", "n", "met", "met_n")).distinct())

    def rest(self, entries: DataFrame, known: DataFrame, roots: DataFrame) -> DataFrame:
        """The pairs of step 3: between the classes that ``roots`` (node, root) leaves."""
        sizes = roots.groupBy("root").agg(F.count("*").alias("class_size"))
        named = settled(roots.join(sizes, "root").selectExpr("node sig", "root", "class_size"))
        named = F.broadcast(named) if named.count() <= RESIDENT_KEYS else named
        # Where a list is one leader and one other set, step 2 has compared them.
        in_class = entries.where("size > 2").join(named, "sig", "left").selectExpr(
            "token", "s", "sig", "n", "pos", "lead", "coalesce(root, sig) class", "coalesce(class_size, 1) class_size"
        )
        open_lists = (
            in_class.groupBy("token").agg(
                F.max(F.struct("class_size", "class")).alias("main"), F.min("class").alias("first"),
                F.max("class").alias("last"),
            )
            .where("first <> last").selectExpr("token", "main.class main")
        )
        # Written, so that the join below has a shuffle of its own on each side and a hot list can be split.
        open_lists = self.work(open_lists, "open")
        answers = known.selectExpr("a", "b", "low", "high")
        placed = (
            in_class.join(open_lists, "token")
            .selectExpr("*", "least(sig, lead) a", "greatest(sig, lead) b")
            .join(answers, ["a", "b"], "left")
            .selectExpr(
                "token", "s", "sig", "n", "pos", "class", "class = main is_main", "lead",
                "if(sig = lead, n, coalesce(low, 0)) low", "if(sig = lead, n, coalesce(high, n)) high",
            )
        )
        # Small bitmaps come along, with each entry, so that the join below gives out only what may link.
        maps = self.classes.selectExpr("sig", f"{_folded('bitmap', str(_SMALL_WORDS))} bitmap")
        placed = self.work(placed.join(maps, "sig"), "placed")
        self.work.drop("open", "entries_common", *(f"entries{k}" for k in range(PARTS)))
        names = ["sig", "n", "pos", "class", "lead", "low", "high", "bitmap"]
        allowed = (
            "x_class <> class and x_sig <> lead and sig <> x_lead and "
            + self.could_link("x_n", "x_pos", "n", "pos")
            # Answers of a common leader: what both have within it, and what both may have beyond it.
            + " and (lead <> x_lead or least(high, x_high) + least(n - low, x_n - x_low) >= "
            + self.least_overlap("n", "x_n") + ")"
        )

        alone = " + ".join(f"bit_count(bitmap[{k}] ^ x_bitmap[{k}])" for k in range(_SMALL_WORDS))
        bounded = f"(n + x_n - ({alone})) div 2 >= {self.least_overlap('n', 'x_n')}"
        # A set outside of the main class against all of that class, and against others of its kind once.
        some = placed.where("not is_main").selectExpr("token", "explode(array(s - 1, s, s + 1)) s", *(f"{c} x_{c}" for c in names))
        pairs = (
            some.join(placed.select("token", "s", *names, "is_main"), ["token", "s"])
            .where(f"{allowed} and (is_main or x_sig < sig) and {bounded}")
            .selectExpr(*_ordered("x_sig", "x_n", "sig", "n"))
        )
        new = self.work(pairs.distinct().join(answers, ["a", "b"], "left_anti"), "new")
        self.work.drop("placed")
        return self.checked(new)


def _folded(bitmap: str, words: str) -> str:
    """SQL for a bitmap brought to so many words; a larger one is or-ed from its parts."""
    parts = f"transform(sequence(1, size({bitmap}) div {words} - 1), i -> slice({bitmap}, i * {words} + 1, {words}))"
    ored = f"aggregate({parts}, slice({bitmap}, 1, {words}), (t, x) -> zip_with(t, x, (p, q) -> p | q))"
    return f"if(size({bitmap}) <= {words}, {bitmap}, {ored})"


def _high(na: str, nb: str, map_a: str, map_b: str) -> str:
    """SQL for the bound of the overlap: each bit in one map alone stands for an n-gram in one set alone."""
    words = f"least(size({map_a}), size({map_b}))"
    alone = f"zip_with({_folded(map_a, words)}, {_folded(map_b, words)}, (p, q) -> cast(bit_count(p ^ q) as bigint))"
    return f"(({na} + {nb} - aggregate({alone}, 0L, (t, p) -> t + p)) div 2)"


def _ordered(a: str, na: str, b: str, nb: str) -> list[str]:
    return [f"least({a}, {b}) a", f"greatest({a}, {b}) b", f"if({a} < {b}, {na}, {nb}) na", f"if({a} < {b}, {nb}, {na}) nb"]


def ngram_classes(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id of each row of ``docs``.

    text_hash is xxhash64 of the text (of empty text for null).
    """
    return rooted_classes(docs, width, percent, doc_id, text).drop("root")


def rooted_classes(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``ngram_classes`` with root: a number of the class, also where no row of it has an id; null without words."""
    own = input_rows(
        docs, doc_id=F.col(f"`{doc_id}`").cast("long"), text=text, text_hash=F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    )
    with Workspace(docs.sparkSession) as work, small_batches(docs.sparkSession):
        join = _Join(own, work, width, percent)
        entries, known = join.star()
        links = known.where("linked").selectExpr("a u", "b v")
        more = join.rest(entries, known, components(links))
        roots = components(links.union(more.where("linked").select("a", "b")))
        classes = join.classes.select("sig", "doc_id").join(roots.selectExpr("node sig", "root"), "sig", "left").selectExpr(
            "sig", "doc_id", "coalesce(root, sig) root"
        )
        names = classes.groupBy("root").agg(F.min("doc_id").alias("component"))
        named = classes.join(names, "root").select("sig", "component", "root")
        rows = join.ids.select("doc_id", "text_hash", "n", F.expr("if(n > 0, sig, null) sig"))
        return settled(
            rows.join(named, "sig", "left").selectExpr(
                "doc_id", "text_hash", "n n_shingles", "if(sig is null, doc_id, component) component_id", "root"
            )
        )


def without_near_copies(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The documents with the smallest id of their class, all columns as they were.

    Rows that repeat a kept document, id and text, are the same document and stay. A class
    without any id keeps its rows.
    """
    gone = ngram_classes(docs, width, percent).where("doc_id <> component_id or doc_id is null and component_id is not null")
    gone = settled(gone.selectExpr("doc_id gone_id", "text_hash gone_hash").distinct())
    gone = F.broadcast(gone) if gone.count() <= RESIDENT_KEYS else gone
    same = (F.col("gone_id").eqNullSafe(docs["doc_id"])) & (
        F.col("gone_hash") == F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    )
    return docs.join(gone, same, "left_anti")
