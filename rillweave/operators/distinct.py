"""Approximate distinct counts that add up: one sketch per group, kept as a table and united later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A sketch has 2 ** PRECISION registers. The relative standard error of a united count is about
#: 1.04 / sqrt(2 ** PRECISION): 0.8 % for 14; 99 of 100 counts lie within three times that.
PRECISION = 14


def distinct_sketches(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("source_system",), precision: int = PRECISION
) -> DataFrame:
    """``by`` and one binary sketch per column. Write it per source and day: old days are never read again.

    Values are compared as text, nulls are left out. Sketches are built before the shuffle, so a group of
    any size costs a few kilobytes per task.
    """
    return df.groupBy(*by).agg(*(F.hll_sketch_agg(F.col(c).cast("string"), precision).alias(c) for c in columns))


def distinct_estimates(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by`` and the distinct count (long) of each column over the united ``sketches``; those of one table
    or of several, made with the same precision. A value that occurs in several sketches counts once."""
    return sketches.groupBy(*by).agg(*(F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns))
