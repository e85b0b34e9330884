"""From raw documents to packed training sequences.

Each stage works on all documents that the one before kept, its result is written and read
again. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillweave.llm.common import Workspace, settled, table
from rillweave.llm.line_dedup import line_dedup
from rillweave.llm.ngram_join import without_near_copies
from rillweave.llm.packing import pack
from rillweave.llm.quality_rules import passing


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break the base rule or lie above the cutoffs of their language and source go."""
    return passing(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; n_chars follows the text."""
    cleaned = line_dedup(docs)
    changed = cleaned.withColumn(
        "n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    )
    return changed.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return without_near_copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in bins. The stage before left no near copies."""
    return pack(docs, near_copies=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_copies),
    ("best-fit packing", packing),
]

#: Packing takes each piece into the best of the bins that the pieces before it left; SQL
#: does not express that. tests/llm compares the run with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with Workspace(spark) as work:
        for k, (_, stage) in enumerate(STAGES):
            docs = work(stage(spark, docs, sf_dir), f"stage{k}")
        return settled(docs)
