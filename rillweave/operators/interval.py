"""Neighbourhoods in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillweave.functions.dates import MICROS_PER_DAY, epoch_micros


def window_micros(days: int) -> int:
    return days * MICROS_PER_DAY


def bucket_of(micros: str, days: int) -> str:
    """Buckets as wide as the window, a day at least: partners lie in the same or an adjacent one."""
    width = window_micros(max(days, 1))
    return f"cast(({micros} - pmod({micros}, {width})) div {width} AS int)"


def neighbour_slots(bucket: str) -> Column:
    """Generator: the bucket and the two beside it."""
    return F.expr(f"explode(array({bucket} - 1, {bucket}, {bucket} + 1))")


def interval_partners(df: DataFrame, column: str, days: int) -> DataFrame:
    """Per instant: how many records fall on it and how many partners each of them has
    within ``days`` before or after (bounds included).

    Pairs are counted, not listed: records collapse to instants first, then a sliding
    range frame runs inside each bucket over that bucket and its neighbours. A date shared
    by a third of all records is one row, and a bucket holds at most three windows' worth
    of distinct instants.
    """
    width = window_micros(days)
    instants = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("records"))
        .withColumn("_t", F.expr(epoch_micros(column)))
        .withColumn("_bucket", F.expr(bucket_of("_t", days)))
    )
    frame = Window.partitionBy("_slot").orderBy("_t").rangeBetween(-width, width)
    return (
        instants.withColumn("_slot", neighbour_slots("_bucket"))
        .withColumn("_reach", F.sum("records").over(frame))
        .where("_slot = _bucket")
        .select(column, "records", (F.col("_reach") - 1).alias("partners"))
    )
