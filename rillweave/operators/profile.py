"""Profiling aggregates: the tables behind the six charts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillweave.config import SkewPolicy
from rillweave.functions.dates import MICROS_PER_DAY, epoch_micros, timestamp
from rillweave.operators.skew import hot_groups

TENURE_BINS = 25
TENURE_MAX_YEARS = 50
DENSITY_BINS = 100


def top_counts(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent values, nulls left out; ties by value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("employees"))
        .orderBy(F.desc("employees"), column)
        .limit(k)
    )


def headcount_by_department(df: DataFrame) -> DataFrame:
    return top_counts(df, "department", 15)


def headcount_by_country(df: DataFrame) -> DataFrame:
    return top_counts(df, "country", 20)


def enrollment_rate(df: DataFrame, k: int = 15) -> DataFrame:
    """Share of each department with a benefits plan, in percent; departments without any drop out."""
    rate = F.rint(F.col("enrolled") / F.col("total") * 100 * 10) / 10
    return (
        df.where(F.col("department").isNotNull())
        .groupBy("department")
        .agg(F.count("plan_type").alias("enrolled"), F.count(F.lit(1)).alias("total"))
        .where("enrolled > 0")
        .withColumn("rate", rate)
        .orderBy(F.desc("rate"), "department")
        .limit(k)
    )


def _equal_width_bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """Bin of x among equal-width bins; the last one includes its right edge.

    The position is checked against the computed edges, which a plain division can miss
    by one unit in the last place.
    """
    step = (high - low) / bins
    guess = F.least(F.floor((x - low) / (high - low) * bins), F.lit(bins - 1).cast("bigint"))
    return (
        F.when(x < low + guess * step, guess - 1)
        .when((guess < bins - 1) & (x >= low + (guess + 1) * step), guess + 1)
        .otherwise(guess)
        .cast("int")
    )


def tenure_histogram(df: DataFrame, as_of: date | str) -> DataFrame:
    """Years of service between 0 and 50 in 25 equal bins, empty bins included.

    Tenure counts whole days, so everything behind the first count has at most
    50 × 366 rows.
    """
    spark = df.sparkSession
    elapsed = F.expr(f"{epoch_micros(timestamp(as_of))} - {epoch_micros('hire_date')}")
    years = F.col("days") / 365.25
    days = (
        df.where(F.col("hire_date").isNotNull())
        .groupBy(F.floor(elapsed / MICROS_PER_DAY).alias("days"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(years.alias("x"), "n")
        .where(F.col("x").between(0, TENURE_MAX_YEARS))
    )
    whole = Window.partitionBy(F.lit(0))
    flat = F.min("x").over(whole) == F.max("x").over(whole)
    spanned = days.select(
        "x",
        "n",
        (F.min("x").over(whole) - F.when(flat, 0.5).otherwise(0.0)).alias("low"),
        (F.max("x").over(whole) + F.when(flat, 0.5).otherwise(0.0)).alias("high"),
    )
    filled = (
        spanned.groupBy(
            _equal_width_bin(F.col("x"), F.col("low"), F.col("high"), TENURE_BINS).alias("bin")
        )
        .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    )
    bins = spark.range(0, TENURE_BINS, 1, 1).select(F.col("id").cast("int").alias("bin"))
    low, high = F.min("low").over(whole), F.max("high").over(whole)
    step = (high - low) / TENURE_BINS
    last = F.col("bin") == TENURE_BINS - 1
    return bins.join(filled, "bin", "left").select(
        "bin",
        (low + F.col("bin") * step).alias("from_years"),
        F.when(last, high).otherwise(low + (F.col("bin") + 1) * step).alias("to_years"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("employees"),
    )


def _values(df: DataFrame, by: str, value: str) -> DataFrame:
    x = F.col(value).try_cast("double")
    rows = df.select(F.col(by).alias("g"), F.nanvl(x, F.lit(None).cast("double")).alias("x"))
    return rows.where("g IS NOT NULL AND x IS NOT NULL")


def _with_group_facts(rows: DataFrame, facts: DataFrame, policy: SkewPolicy) -> DataFrame:
    """Attach per-group facts. Those of hot groups, a bounded list, are broadcast; rows of any
    further group join by shuffle."""
    listed = F.broadcast(hot_groups(facts, "n", policy))
    rest = rows.join(listed.select("g"), "g", "left_anti").join(facts, "g")
    return rows.join(listed, "g").unionByName(rest)


def salary_distribution(
    df: DataFrame,
    by: str = "employment_type",
    value: str = "salary_usd_annual",
    accuracy: int = 20_000,
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """Count, minimum, exact median and maximum per group.

    An approximate quantile brackets the median; what lies below the bracket is only
    counted, so a group of any size leaves a few ten-thousandths of its rows to sort.
    """
    rows = _values(df, by, value)
    margin = 2.0 / accuracy
    facts = (
        rows.groupBy("g")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("x").alias("low"),
            F.max("x").alias("high"),
            F.percentile_approx("x", [0.5 - margin, 0.5 + margin], accuracy).alias("bracket"),
        )
    )
    x, lower, upper = F.col("x"), F.col("bracket")[0], F.col("bracket")[1]
    folded = (
        _with_group_facts(rows, facts, policy)
        .where(x <= upper)
        .groupBy("g", "n", "low", "high", F.when(x < lower, F.lit(float("-inf"))).otherwise(x).alias("v"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    upto = F.sum("c").over(Window.partitionBy("g").orderBy("v"))

    def at(rank: Column) -> Column:
        covers = (F.col("upto") >= rank) & (F.col("upto") - F.col("c") < rank)
        return F.max(F.when(covers, F.col("v")))

    middle = (at(F.floor((F.col("n") + 1) / 2)) + at(F.floor(F.col("n") / 2) + 1)) / 2
    return (
        folded.withColumn("upto", upto)
        .groupBy("g", "n", "low", "high")
        .agg(middle.alias("median"))
        .select(
            F.col("g").alias(by),
            F.col("n").alias("employees"),
            F.col("low").alias("min_salary"),
            F.coalesce("median", F.raise_error(F.lit("median outside its bracket")).cast("double")).alias("median_salary"),
            F.col("high").alias("max_salary"),
        )
    )


def salary_density(
    df: DataFrame,
    by: str = "employment_type",
    value: str = "salary_usd_annual",
    bins: int = DENSITY_BINS,
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """Shape of each distribution: occupied equal-width bins between its minimum and maximum."""
    rows = _values(df, by, value).where(F.abs("x") < float("inf"))
    facts = rows.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    low, high = F.col("low"), F.col("high")
    bin_number = F.when(low == high, F.lit(0)).otherwise(
        _equal_width_bin(F.col("x"), low, F.when(low != high, high), bins)
    )
    return (
        _with_group_facts(rows, facts, policy)
        .groupBy("g", "low", "high", bin_number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("employees"))
        .select(
            F.col("g").alias(by),
            "bin",
            (low + F.col("bin") * ((high - low) / bins)).alias("from_salary"),
            "employees",
        )
    )


def quality_summary(report: DataFrame) -> DataFrame:
    """Passed and failed rows per check."""
    return report.select("position", "check", "passed", "failed")
