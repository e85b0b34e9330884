"""Merge of records that share an e-mail address, and the key rewrite that follows from it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillweave.config import SOURCE_PRIORITY, UNKNOWN_PRIORITY, SkewPolicy
from rillweave.functions.taxonomy import source_priority
from rillweave.functions.text import is_blank
from rillweave.operators.skew import hot_groups, hot_keys, lookup


def _with_email(df: DataFrame) -> DataFrame:
    return df.where(f"NOT {is_blank('email')}").select("email", "employee_id", "source_systems")


def email_groups(
    df: DataFrame,
    priority: Mapping[str, int] = SOURCE_PRIORITY,
    normalise: bool = False,
    require_distinct_prefix: bool = False,
) -> DataFrame:
    """One row per address used by several records: winner, size and joined provenance.

    The winner has the smallest source priority, then the smallest id. Provenance strings
    are joined whole, so a name can occur twice; ``normalise`` splits them first. Only as
    many distinct strings exist as there are combinations of sources.
    ``require_distinct_prefix`` leaves addresses alone whose records all come from one company,
    by the part of the id before the hyphen.
    """
    rank = F.expr(source_priority("source_systems", priority, UNKNOWN_PRIORITY))
    sources = F.collect_set("source_systems")
    if normalise:
        sources = F.array_distinct(F.split(F.array_join(sources, ","), ","))
    prefix = F.substring_index("employee_id", "-", 1)
    shared = "_first_prefix <> _last_prefix" if require_distinct_prefix else "group_size > 1"
    return (
        _with_email(df)
        .groupBy("email")
        .agg(
            F.min(F.struct(rank.alias("p"), "employee_id")).alias("_best"),
            F.count(F.lit(1)).alias("group_size"),
            F.array_join(F.array_sort(sources), ",").alias("merged_sources"),
            F.min(prefix).alias("_first_prefix"),
            F.max(prefix).alias("_last_prefix"),
        )
        .where(shared)
        .select("email", F.col("_best.employee_id").alias("winner_id"), "group_size", "merged_sources")
    )


def email_members(
    df: DataFrame, groups: DataFrame, policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    """Every record of a shared address with its group. Long form: no list grows with a group."""
    narrow = _with_email(df).select("email", "employee_id")
    hot = hot_groups(groups, "group_size", policy).select("email")
    return lookup(narrow, groups, "email", "employee_id", policy, hot).where("winner_id is not null")


def loser_map(members: DataFrame) -> DataFrame:
    """Dropped id -> surviving id."""
    return members.where("employee_id <> winner_id").select(
        F.col("employee_id").alias("loser_id"), "winner_id"
    )


def remap_reference(
    df: DataFrame,
    ids: DataFrame,
    column: str = "manager_id",
    key: str = "employee_id",
    policy: SkewPolicy = SkewPolicy(),
    hot: DataFrame | None = None,
) -> DataFrame:
    """Point a foreign key at the survivor when it names a dropped record."""
    mapping = ids.select(F.col("loser_id").alias(column), F.col("winner_id").alias("_survivor"))
    joined = lookup(df, mapping, column, key, policy, hot)
    return joined.withColumn(column, F.coalesce("_survivor", column)).select(*df.columns)


def drop_losers(df: DataFrame, members: DataFrame) -> DataFrame:
    """Keep the winner of each group, marked as merged; other records pass unchanged."""
    changes = members.select("employee_id", "winner_id", "merged_sources")
    merged = F.col("winner_id").isNotNull()
    return (
        df.join(changes, "employee_id", "left")
        .where(~merged | (F.col("winner_id") == F.col("employee_id")))
        .withColumn("source_systems", F.coalesce("merged_sources", "source_systems"))
        .withColumn("dedup_method", F.when(merged, F.lit("email_match")).otherwise(F.col("dedup_method")))
        .select(*df.columns)
    )


def filled_winners(df: DataFrame, members: DataFrame, priority: Mapping[str, int] = SOURCE_PRIORITY) -> DataFrame:
    """``df`` with what winners lack taken from their losers, best source first, then smallest id.

    A minimum picks each value, as in the exact merge: no group is held as a whole.
    """
    values = [c for c in df.columns if c not in ("employee_id", "source_systems", "dedup_method")]
    rank = F.struct(F.expr(source_priority("source_systems", priority, UNKNOWN_PRIORITY)).alias("p"), "employee_id")
    best = [F.min(F.when(F.col(c).isNotNull(), F.struct(rank.alias("r"), F.col(c).alias("v")))).alias(c) for c in values]
    found = (
        df.join(members.select("employee_id", "winner_id"), "employee_id")
        .groupBy(F.col("winner_id").alias("_winner"))
        .agg(*best)
        .select("_winner", F.struct(*(F.col(f"{c}.v").alias(c) for c in values)).alias("_best"))
    )
    joined = df.join(found, df["employee_id"] == F.col("_winner"), "left")
    return joined.withColumns({c: F.coalesce(c, f"_best.{c}") for c in values}).select(*df.columns)


def email_merge(
    df: DataFrame,
    priority: Mapping[str, int] = SOURCE_PRIORITY,
    policy: SkewPolicy = SkewPolicy(),
    normalise: bool = False,
    require_distinct_prefix: bool = False,
    coalesce: bool = False,
) -> DataFrame:
    """Drop the losers of every shared address and repoint references to them.

    ``coalesce`` keeps what only losers know: winners take the values that they lack.
    ``df`` is read several times: pass a staged table.
    """
    members = email_members(df, email_groups(df, priority, normalise, require_distinct_prefix), policy)
    records = filled_winners(df, members, priority) if coalesce else df
    hot = hot_keys(records, "manager_id", policy)
    return remap_reference(drop_losers(records, members), loser_map(members), policy=policy, hot=hot)
