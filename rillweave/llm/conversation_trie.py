"""Prefix trie of conversations by collapsing whole sequences.

Identical conversations become one weighted sequence with the list of those that end there. A
sequence that is a proper prefix of another one is no leaf: an anti-join finds the leaves. The
weighted prefixes of the different sequences, aggregated, are the nodes.

A prefix is known by its depth and a 128-bit signature: the running XOR of a hash of each turn with
its place. So a node is an equal key, not a string of texts, and texts are read once. What a
subtree saves is a sum over sequences, not over pairs of nodes: a sequence adds its weight times the
bytes from a node on, less the bytes of the nodes from there on that it owns, i.e. whose smallest
member it holds; those are the last ones of its path.

A turn or conversation that owns a third of the rows costs a row per task: copies collapse before
prefixes are listed, and nodes are aggregated with map-side combination. The parents of very many
nodes (at most ``HOT``, by count) are given to all tasks. Lists of ends travel in blocks of ids,
in order, so the longest one is never in memory. A conversation is a unit as a document is;
its turns are sorted by a window, which spills.

Defined cases: null role or text is empty. Turns are ordered by turn (null first), ties by a hash of
role and text, so ties and repeated rows count, each as a turn. Rows without a conv_id belong to no
conversation. An empty table gives no node. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillweave.llm.common import Workspace, input_rows

#: Parents with more than one in so many of all nodes; there are fewer of them than that.
HOT = 1000
#: Ids of a block of an end list span 2 to this power.
BLOCK_BITS = 14
KEY = ["depth", "s1", "s2"]


class Trie(NamedTuple):
    """``nodes``: depth, s1, s2, conv_id (smallest member), parent_conv_id, n_convs, n_children, n_leaves, saved.
    The last turn of a node is turn ``depth`` of conversation ``conv_id``.
    ``ends``: depth, s1, s2, block, ids; the conversations that end at a node, as sorted text, in blocks."""

    nodes: DataFrame
    ends: DataFrame


def ordered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, place (from 1), h1, h2, bytes of each turn: two hashes of role and text, and the bytes of the text."""
    rows = input_rows(
        conversations, conv_id=F.col(f"`{conv_id}`").cast("long"), turn=turn,
        role=F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")), text=F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")),
    ).where("conv_id is not null")
    narrow = rows.selectExpr(
        "conv_id", "turn", "xxhash64(role, text) h1", "xxhash64(1, text, role) h2", "cast(octet_length(text) as bigint) bytes"
    )
    # Ties have some fixed order; that of the hashes spares a sort on texts.
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "h1", "h2")
    return narrow.select("conv_id", F.row_number().over(order).cast("long").alias("place"), "h1", "h2", "bytes")


def reopened(turns: DataFrame, spread: int = 5, fold: int = 9) -> DataFrame:
    """``turns`` of conversations rebuilt on a shared opening, and a place 0 for each conversation.

    Conversation c starts with the first h turns of conversation c - c % spread, h = crc32(c as text) % fold;
    its own turns after its first h follow.
    """
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")).selectExpr(
        "conv_id", "n", f"conv_id - conv_id % {spread} base", f"crc32(cast(cast(conv_id as string) as binary)) % {fold} h"
    )
    bases = convs.selectExpr("conv_id base", "n base_n")
    convs = convs.join(bases, "base", "left").selectExpr("conv_id", "base", "h", "least(h, coalesce(base_n, 0L)) taken")
    openings = turns.where(f"place < {fold}").withColumnRenamed("conv_id", "base")
    opening = convs.join(openings, "base").where("place <= h").select("conv_id", "place", "h1", "h2", "bytes")
    own = turns.join(convs, "conv_id").where("place > h").selectExpr("conv_id", "taken + place - h place", "h1", "h2", "bytes")
    start = convs.selectExpr("conv_id", "0L place", "0L h1", "0L h2", "0L bytes")
    return start.unionByName(opening).unionByName(own)


def _paths(turns: DataFrame) -> DataFrame:
    """Each prefix of each conversation: conv_id, depth, s1, s2, signature of the parent p1, p2, bytes of the last turn,
    bytes before it, bytes of the conversation (total) and its length (len)."""
    whole = Window.partitionBy("conv_id")
    upto = whole.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Place 0 stands for the root and has the signature 0.
    keyed = turns.selectExpr(
        "conv_id", "place", "bytes", "if(place = 0, 0L, xxhash64(place, h1)) k1", "if(place = 0, 0L, xxhash64(place, h2)) k2"
    )
    running = keyed.select(
        "conv_id", F.col("place").alias("depth"), "k1", "k2", "bytes",
        F.expr("bit_xor(k1)").over(upto).alias("s1"), F.expr("bit_xor(k2)").over(upto).alias("s2"), F.sum("bytes").over(upto).alias("upto"),
        F.sum("bytes").over(whole.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
        F.max("place").over(whole.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("len"),
    )
    return running.selectExpr(
        "conv_id", *KEY, "s1 ^ k1 p1", "s2 ^ k2 p2", "bytes", "upto - bytes before", "total", "len"
    )


def prefix_trie(turns: DataFrame, work: Workspace) -> Trie:
    """The trie of ``turns`` (conv_id, place, h1, h2, bytes; place 0 for each conversation), written to ``work``."""
    paths = work(_paths(turns), "paths")
    last = paths.where("depth = len")
    sequences = last.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"))
    sequences = work(sequences, "sequences")
    listed = paths.join(sequences.select("conv_id", "weight"), "conv_id")
    longer = listed.where("depth < len").select(*KEY).distinct()
    leaves = sequences.join(longer, KEY, "left_anti").selectExpr("conv_id", "1L leaf")
    listed = work(listed.join(leaves, "conv_id", "left").fillna({"leaf": 0}), "listed")
    found = listed.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        F.sum(F.expr("weight * (total - before)")).alias("sent"),
        # Equal for all members.
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("before").alias("before"),
    )
    found = work(found, "found")
    owners = found.groupBy("conv_id").agg(F.min("before").alias("owned_from"))
    once = (
        listed.join(owners, "conv_id").withColumn("owned", F.expr("total - greatest(before, owned_from)"))
        .groupBy(*KEY).agg(F.sum("owned").alias("stored"))
    )
    kids = found.where("depth > 0").groupBy(F.expr("depth - 1").alias("depth"), F.col("p1").alias("s1"), F.col("p2").alias("s2")).agg(
        F.count("*").alias("n_children")
    )
    nodes = work(found.join(once, KEY, "left").join(kids, KEY, "left").fillna({"stored": 0, "n_children": 0}), "nodes")
    parents = nodes.where("n_children > 0").selectExpr(
        "depth + 1 depth", "s1 p1", "s2 p2", "conv_id parent_conv_id", "n_children kids"
    )
    many = f"kids * {HOT} > {nodes.count()}"
    up = ["depth", "p1", "p2"]
    hot = parents.where(many).drop("kids").withColumnRenamed("parent_conv_id", "hot_conv_id")
    marked = nodes.join(F.broadcast(hot), up, "left")
    apart = marked.where("hot_conv_id is null and depth > 0").join(parents.where(f"not ({many})").drop("kids"), up)
    done = marked.where("hot_conv_id is not null or depth = 0").withColumn("parent_conv_id", F.col("hot_conv_id"))
    nodes = done.unionByName(apart).selectExpr(
        *KEY, "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "sent - stored saved"
    )
    ends = last.groupBy(*KEY, F.expr(f"shiftright(conv_id, {BLOCK_BITS})").alias("block")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    return Trie(nodes, ends)


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, s1, s2, ends_sha256: the hash of the joined blocks of each list, fed block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, out = None, None, []
        for batch in batches:
            for *k, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
                if k == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        out.append((*key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256()
                digest.update(ids.encode())
            yield _records(out)
            out = []
        if key is not None:
            yield _records([(*key, digest.hexdigest())])

    streamed = ends.select(*KEY, "block", "ids").repartition(*KEY).sortWithinPartitions(*KEY, "block")
    return streamed.mapInArrow(run, "depth bigint, s1 bigint, s2 bigint, ends_sha256 string")


def _records(rows: list[tuple]) -> pa.RecordBatch:
    fields = [("depth", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("ends_sha256", pa.string())]
    return pa.record_batch([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])
