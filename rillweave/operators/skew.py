"""Lookup joins that stay balanced when one key owns much of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillweave.config import SkewPolicy


#: Groups of input partitions whose sketches are merged first, so that no task merges those of all.
_MERGERS = 64


def hot_keys(df: DataFrame, key: str, policy: SkewPolicy) -> DataFrame:
    """All keys with at least one in ``share`` of the rows that have a key.

    A frequent-items sketch per input partition, merged in two steps: keys are not shuffled, and
    a sketch holds ``8 * share`` counters however many keys there are. Its error is below a third of one in
    ``share``, so that no hot key is missed, and keys with less than two thirds of the rows
    that make a key hot are not listed. ``2 * share`` keys are therefore never exceeded.
    """
    counters, most = 8 * policy.share, 2 * policy.share
    return (
        df.where(F.col(key).isNotNull())
        .select(key, F.expr(f"spark_partition_id() % {_MERGERS} AS _part"))
        .groupBy("_part")
        .agg(F.expr(f"approx_top_k_accumulate({key}, {counters}) AS _sketch"), F.count(F.lit(1)).alias("_n"))
        # A group of its own: sketches of no rows at all cannot be combined.
        .groupBy(F.lit("all"))
        .agg(F.expr(f"approx_top_k_combine(_sketch, {counters}) AS _sketch"), F.sum("_n").alias("_n"))
        .selectExpr("_n", f"inline(approx_top_k_estimate(_sketch, {most})) AS (_item, _count)")
        .where(F.col("_count") * policy.share >= F.col("_n"))
        .select(F.col("_item").alias(key))
    )


def hot_groups(counted: DataFrame, n: str, policy: SkewPolicy) -> DataFrame:
    """Rows of ``counted`` (a row per group, ``n``: its size) with at least one in ``share`` of all: ``share`` rows at most."""
    total = counted.agg(F.coalesce(F.sum(n), F.lit(0))).scalar()
    return counted.where(F.col(n) * policy.share >= total)


def lookup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    scatter_by: str,
    policy: SkewPolicy,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left outer join with a table that has unique, textual keys.

    Rows with a hot key take their values from a broadcast of at most ``2 * share`` rows. The
    others join by shuffle, where rows that cannot match there (hot or null keys) are spread
    over ``scatter`` keys instead of meeting in one task.
    """
    values = [c for c in right.columns if c != key]
    listed = hot_keys(left, key, policy) if hot is None else hot
    resolved = listed.join(right, key, "left").select(
        key, F.lit(True).alias("_hot"), F.struct(*values).alias("_hot_values")
    )
    marked = left.join(F.broadcast(resolved), key, "left")
    elsewhere = F.concat(
        F.lit("\u0000"), F.pmod(F.xxhash64(scatter_by), F.lit(policy.scatter)).cast("string")
    )
    keyed = marked.withColumn(
        "_key", F.when(F.col("_hot") | F.col(key).isNull(), elsewhere).otherwise(F.col(key))
    )
    cold = right.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_cold_{c}") for c in values))
    return keyed.join(cold, "_key", "left").select(
        *left.columns,
        *(F.coalesce(F.col(f"_hot_values.{c}"), F.col(f"_cold_{c}")).alias(c) for c in values),
    )
