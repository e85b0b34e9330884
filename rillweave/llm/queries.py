"""One query per operator, over its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillweave.llm import merkle
from rillweave.llm.common import Workspace, settled, table
from rillweave.llm.conversation_trie import KEY, end_digests, ordered_turns, prefix_trie, reopened
from rillweave.llm.cover_tree import near_copies
from rillweave.llm.line_dedup import line_dedup
from rillweave.llm.ngram_join import ngram_classes
from rillweave.llm.packing import pack
from rillweave.llm.phrase_index import contamination
from rillweave.llm.piece_codec import piece_digests
from rillweave.llm.ppm import ppm_scores
from rillweave.llm.quality_rules import quality_verdicts
from rillweave.llm.sharding import shard_records
from rillweave.llm.token_counts import token_counts
from rillweave.llm.token_files import round_trip


def tokenizer_file(name: str) -> str:
    """A public vocabulary file; it is installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op2_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "embeddings"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_records(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    with Workspace(spark) as work:
        digests = round_trip(
            table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), 1, f"{work.path}/{uuid.uuid4().hex}"
        )
        return settled(digests)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", "source", "n_lines", "n_dropped",
        F.octet_length("text").cast("long").alias("clean_bytes"), F.md5(F.col("text").cast("binary")).alias("clean_md5"),
    )


def op7_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_classes(table(spark, sf_dir, "documents")).drop("text_hash")


def op9_ppm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_scores(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def conversation_nodes(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of rebuilt ``conversations``, with the digests of their lists of ends."""
    with Workspace(conversations.sparkSession) as work:
        turns = work(ordered_turns(conversations), "turns")
        trie = prefix_trie(reopened(turns), work)
        named = trie.nodes.join(end_digests(trie.ends), KEY, "left")
        return settled(
            named.selectExpr(
                "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved saved_tokens",
                "coalesce(ends_sha256, sha2('', 256)) ends_sha256",
            )
        )


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_nodes(table(spark, sf_dir, "conversations"))


def document_proofs(docs: DataFrame) -> DataFrame:
    """Leaf, roots and digest of the proof of each document, and whether its tampered version passes."""
    with Workspace(docs.sparkSession) as work:
        leaves = work(merkle.document_leaves(docs), "digests")
        own_part = f"slice(path, 1, {merkle.height('n')})"
        proved = merkle.proofs(leaves, "source", ["doc_id"], "leaf", work)
        return proved.selectExpr(
            "doc_id", "leaf", f"{merkle.folded('leaf', own_part)} subroot", "root",
            f"{merkle.proof_digest('path')} proof_sha256", f"{merkle.folded('tampered', 'path')} folded_root",
        ).withColumn("verified", F.expr("folded_root = root"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_proofs(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_best_fit_packing, op2_cover_tree, op3_token_counts, op4_sharding, op5_token_files, op6_line_dedup, op7_piece_codec,
        op8_ngram_join, op9_ppm_scores, op10_quality_rules,
        op11_decontamination, op12_conversation_trie, op13_merkle_manifest,
    )
}
