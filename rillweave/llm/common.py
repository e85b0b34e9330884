"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillweave.plans.staging import staging_root

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """What a step shuffles is deleted as soon as its result is written, not some time later."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Bytes of a batch that goes to a Python worker, where the steps behind hold several numbers for each byte.
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches for Python are bounded by their bytes, whatever the length of the texts. At least one row each."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the folder all executors share.

    Cuts the lineage. A lost executor costs nothing that was settled, and Spark's cleaner may
    delete the files as soon as no plan refers to them.
    """
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(staging_root(df.sparkSession))
    with _dropped_shuffles(df.sparkSession):
        return df.select("*").checkpoint()


class Workspace:
    """A folder of written tables in the shared folder, for one run of an operator.

    ``with Workspace(spark) as work`` deletes it at the end, also after a failure; what the
    operator returns must be settled before.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{staging_root(spark)}/rillweave-llm-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        with _dropped_shuffles(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes written tables that no later step reads."""
        for name in names:
            self._delete(f"{self.path}/{name}")

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self._delete(self.path)


def spare_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores added, so that it clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def input_rows(df: DataFrame, **columns: str | Column) -> DataFrame:
    """The named columns alone, so that further columns of a table cannot clash with own names."""
    return df.select(*(F.col(f"`{c}`").alias(k) if isinstance(c, str) else c.alias(k) for k, c in columns.items()))


#: Links that a task contracts at once.
TASK_LINKS = 500_000


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) with the components of a task's links: each node but the smallest of its component, and that one."""
    held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if not held:
        return
    nodes, at = np.unique(np.concatenate([np.concatenate(c) for c in zip(*held, strict=True)]), return_inverse=True)
    u, v = np.split(at, 2)
    root = np.arange(len(nodes))
    while len(u):
        # Roots hang onto smaller ones, then all nodes onto their roots.
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while not np.array_equal(above := root[root], root):
            root = above
        u, v = root[u], root[v]
        u, v = u[u != v], v[u != v]
    hangs = root != np.arange(len(nodes))
    yield pa.record_batch([pa.array(nodes[hangs]), pa.array(nodes[root[hangs]])], names=["u", "v"])


def components(edges: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """Connected components of undirected ``edges`` (u long, v long): node, root (its smallest node).

    Tasks contract their links first, about ``task_links`` each; a graph of one task's links is done
    then. Larger ones take alternating star contraction: each round hangs neighbours onto the smallest
    one around, in two aggregations with map-side combination. No neighbour list is ever gathered, so a
    node with any number of links is as cheap as its rows. Rounds: about the logarithm of the longest
    path. Loops and repeated edges do no harm.
    """
    links = settled(edges.where("u <> v").selectExpr("greatest(u, v) u", "least(u, v) v").distinct())
    tasks = max(1, -(-links.count() // task_links))
    links = settled(links.coalesce(tasks).mapInArrow(_contracted, "u bigint, v bigint"))
    while tasks > 1:
        both = links.unionByName(links.selectExpr("v u", "u v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) m")
        large = both.where("v > u").join(least, "u").selectExpr("v u", "m v").distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u")
        after = settled(
            small.where("v <> m").selectExpr("v u", "m v").unionByName(lower.selectExpr("u", "m v")).distinct()
        )
        same = after.count() == links.count() and after.exceptAll(links).isEmpty()
        links = after
        if same:
            break
    return links.selectExpr("u node", "v root").unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
