"""Merkle manifest of a dataset, with a proof for each row by pointer jumping.

Rows of a group, in order, are the leaves of a tree in which up to ``ARITY`` consecutive nodes make
one; the roots of the groups, in order, are the leaves of the top tree. Ranks come from a range
partition and the sizes of its parts. Blocks of consecutive nodes climb several levels at once, so a
tree of any size takes a few rounds.

Proofs: each node starts with a pointer to its parent and a segment, its siblings there. A
self-join appends to each segment that of the node it points to and takes over its pointer, so
the distance doubles, until every leaf points to the root. Nodes that no later pointer can reach are
left out of the next round. A node is pointed to by ARITY to the power of the distance at most; once the
nodes far enough up are few, they are given to all tasks, so no join has a hot key.

Digests are hex text where they are hashed and bytes in segments. A segment is an array of (l, r), the
siblings to the left and to the right, bottom up.

Defined cases: null is a group of its own, the first one. Equal rows are leaves of their own, side by
side. A group of one row has its leaf as root; a single group has its root as the root of all. An
empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillweave.llm.common import Workspace, input_rows, settled

ARITY = 3
#: Levels that a block of ARITY ** CLIMB nodes climbs in one task.
CLIMB = 7
#: Nodes given to all tasks rather than joined by a shuffle.
RESIDENT = 20_000

#: Columns of a document, in the order in which they are hashed.
HASHED = ("doc_id", "source", "lang", "n_chars", "text")

_ID = ["tree", "level", "idx"]
_NODES = "tree bigint, level int, idx bigint, n bigint, l binary, r binary, digest string"
_TOP = -1


def field(column: str) -> str:
    """SQL: a value as it is hashed: its bytes, counted; ``-`` for null."""
    value = f"cast({column} as string)"
    return f"coalesce(concat(octet_length({value}), ':', {value}), '-')"


def leaf(columns: list[str]) -> str:
    """SQL for the digest of a row."""
    return f"sha2(concat({', '.join(map(field, columns))}), 256)"


def document_leaves(docs: DataFrame, columns: tuple[str, ...] = HASHED) -> DataFrame:
    """doc_id, source, leaf and tampered of each document: its digest, and that after the line ends of its text were
    deleted, where 2 divides crc32(doc_id as text). ``columns`` are hashed in order."""
    own = input_rows(docs, **{c: c for c in columns})
    deleted = "replace(text, '\n', '')"
    hit = "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 2 = 0 and instr(text, '\n') > 0, false)"
    digests = own.selectExpr("cast(doc_id as bigint) doc_id", "cast(source as string) source", "text", *(
        c for c in columns if c not in ("doc_id", "source", "text")), f"{leaf(list(columns))} leaf")
    return digests.selectExpr(
        "doc_id", "source", "leaf", f"if({hit}, {leaf(list(columns)).replace(field('text'), field(deleted))}, leaf) tampered"
    )


def folded(digest: str, path: str) -> str:
    """SQL for the digest that ``digest`` and the siblings of ``path`` give."""
    return f"aggregate({path}, {digest}, (d, p) -> sha2(concat(lower(hex(p.l)), d, lower(hex(p.r))), 256))"


def proof_digest(path: str) -> str:
    """SQL for the digest of all siblings of ``path``."""
    return f"sha2(array_join(transform({path}, p -> concat(lower(hex(p.l)), lower(hex(p.r)))), ''), 256)"


def height(n: str) -> str:
    """SQL for the levels above the leaves of a tree of ``n`` leaves."""
    steps = " ".join(f"when {n} <= {ARITY**k} then {k}" for k in range(39))
    return f"case {steps} else 39 end"


def ranked(df: DataFrame, keys: list[str], work: Workspace, name: str) -> DataFrame:
    """``df`` with rank (from 0, without gaps) in the order of ``keys``, nulls first, ties in any order."""
    tie = df.withColumn("tie", F.monotonically_increasing_id())
    placed = work(
        tie.repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie")
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("tie"),
        name,
    )
    # A row per part of the table.
    sizes = sorted(placed.groupBy("part").count().collect())
    offsets, total = [], 0
    for part, n in sizes:
        offsets.append((part, total))
        total += n
    before = df.sparkSession.createDataFrame(offsets, "part int, before long")
    return placed.join(F.broadcast(before), "part").withColumn("rank", F.expr("before + at")).drop("part", "at", "before")


def _climb(nodes: DataFrame, level: int) -> DataFrame:
    """From tree, idx, n (leaves of the tree), digest of all nodes of a level: their siblings, and those of CLIMB - 1
    levels more; nodes that have none there, because they are the root or the highest of this round, with their digest."""
    size, width = ARITY**CLIMB, ARITY

    def block(tree: int, first: int, n: int, digests: list[str], out: list[tuple]) -> None:
        at, count = level, -(-n // width**level)
        while at < level + CLIMB and count > 1:
            above = []
            for k in range(0, len(digests), width):
                run = digests[k : k + width]
                for j in range(len(run)):
                    out.append((tree, at, first + k + j, n, bytes.fromhex("".join(run[:j])), bytes.fromhex("".join(run[j + 1 :])), None))
                above.append(hashlib.sha256("".join(run).encode()).hexdigest())
            digests, first, at, count = above, first // width, at + 1, -(-count // width)
        out.append((tree, at, first, n, None, None, digests[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, n, digests, out = None, 0, 0, [], []
        for batch in batches:
            for tree, idx, leaves, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (tree, idx // size) != key:
                    if key is not None:
                        block(key[0], first, n, digests, out)
                    key, first, n, digests = (tree, idx // size), idx, leaves, []
                digests.append(digest)
            yield _records(out)
            out = []
        if key is not None:
            block(key[0], first, n, digests, out)
            yield _records(out)

    dealt = nodes.select("tree", "idx", "n", "digest", F.expr(f"idx div {size}").alias("block")).repartition("tree", "block")
    return dealt.sortWithinPartitions("tree", "idx").drop("block").mapInArrow(run, _NODES)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.string()]
    names = [c.split()[0] for c in _NODES.split(", ")]
    return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def _grown(leaves: DataFrame, work: Workspace, name: str) -> tuple[DataFrame, DataFrame]:
    """Nodes below a root (tree, level, idx, n, l, r), and tree, digest of the roots, of the trees over tree, idx, n, digest."""
    largest = leaves.agg(F.max("n")).first()[0] or 1
    level, nodes, tops = 0, None, leaves
    while True:
        part = work(_climb(tops, level), f"{name}{level}")
        below = part.where("digest is null").drop("digest")
        nodes = below if nodes is None else nodes.unionByName(below)
        level += CLIMB
        done = part.where(f"digest is not null and {height('n')} <= {level}").select("tree", "digest")
        roots = done if level == CLIMB else roots.unionByName(done)  # noqa: F821
        if ARITY**level >= largest:
            return nodes, roots
        tops = part.where(f"digest is not null and {height('n')} > {level}").select("tree", "idx", "n", "digest")


def proofs(rows: DataFrame, group: str, order: list[str], digest: str, work: Workspace) -> DataFrame:
    """All columns of ``rows`` with n (leaves of its group), path (siblings up to the root) and root.

    ``rows`` has no columns of the names tree, idx, n, path, root, rank, first_rank, part, at, tie and before.
    """
    spark = rows.sparkSession
    placed = ranked(rows, [group, *order, digest], work, "placed")
    groups = placed.groupBy(group).agg(F.min("rank").alias("first_rank"), F.count("*").alias("n"))
    groups = ranked(groups, ["first_rank"], work, "groups").withColumnsRenamed({"rank": "tree", group: "group_value"})
    groups = work(groups, "numbered")
    leaves = work(
        placed.join(groups, F.col(group).eqNullSafe(F.col("group_value")))
        .withColumn("idx", F.expr("rank - first_rank")).drop("rank", "first_rank", "group_value"),
        "leaves",
    )
    trees = groups.count()
    inner, subroots = _grown(leaves.select("tree", "idx", "n", F.col(digest).alias("digest")), work, "inner")
    tops = subroots.selectExpr(f"{_TOP}L tree", "tree idx", f"{trees}L n", "digest")
    upper, roots = _grown(tops, work, "upper")
    root = roots.first()
    if root is None:
        return settled(rows.selectExpr("*", "0L n", "cast(array() as array<struct<l:binary,r:binary>>) path", "'' root"))
    # The root of a group goes by its name in the top tree. A pointer to the root of all is null: nothing is left to do.
    nodes = inner.unionByName(upper).selectExpr(
        *_ID, f"tree >= 0 and level + 1 = {height('n')} up", f"tree < 0 and level + 1 = {height('n')} last", "l", "r"
    )
    jumps = nodes.selectExpr(
        *_ID, f"case when last or up and {trees} = 1 then null when up then {_TOP}L else tree end a_tree",
        "if(up, 0, level + 1) a_level", f"if(up, tree, idx div {ARITY}) a_idx", "array(struct(l, r)) path",
    )
    if trees > 1:  # A group of one row: its leaf is the leaf of the top tree.
        alone = groups.where("n = 1").selectExpr(
            "tree", "0 level", "0L idx", f"{_TOP}L a_tree", "0 a_level", "tree a_idx", "cast(array() as array<struct<l:binary,r:binary>>) path"
        )
        jumps = jumps.unionByName(alone)
    jumps, distance = work(jumps, "jump0"), 1
    is_leaf = "tree >= 0 and level = 0"
    while not (open_ := jumps.where("a_tree is not null")).isEmpty():
        # Nodes of the groups at this distance at least from a leaf, and the top tree.
        targets = jumps.where(f"tree < 0 or level >= {distance}").selectExpr(
            "tree a_tree", "level a_level", "idx a_idx", "a_tree b_tree", "a_level b_level", "a_idx b_idx", "path more"
        )
        targets = F.broadcast(targets) if targets.count() <= RESIDENT else targets
        moved = open_.join(targets, ["a_tree", "a_level", "a_idx"]).selectExpr(
            *_ID, "b_tree a_tree", "b_level a_level", "b_idx a_idx", "concat(path, more) path"
        )
        distance *= 2
        kept = f"({is_leaf}) or tree < 0 or level >= {distance}"
        jumps = work(jumps.where("a_tree is null").unionByName(moved).where(kept), f"jump{distance}")
    paths = jumps.where(is_leaf).select("tree", "idx", "path")
    named = leaves.join(paths, ["tree", "idx"], "left").select(
        *(F.col(f"`{c}`") for c in rows.columns), "n",
        F.expr("coalesce(path, cast(array() as array<struct<l:binary,r:binary>>)) path"), F.lit(root.digest).alias("root"),
    )
    return settled(named)
