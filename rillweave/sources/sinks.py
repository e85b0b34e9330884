"""Outputs: partitioned Parquet, CSV reports and the dead-letter table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Prefix of the id -> company; every other id belongs to the last one (fixed values).
COMPANY_BY_PREFIX = {"GT": "GlobalTech"}
OTHER_COMPANY = "AcquiredCo"


def company_origin(
    employee_id: Column,
    by_prefix: dict[str, str] | None = None,
    other: str = OTHER_COMPANY,
) -> Column:
    origin = F.lit(other)
    for prefix, company in reversed((by_prefix or COMPANY_BY_PREFIX).items()):
        origin = F.when(employee_id.startswith(prefix), F.lit(company)).otherwise(origin)
    return origin


def without_time_zone(df: DataFrame) -> DataFrame:
    """Zoned timestamps as wall-clock time."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def write_golden(df: DataFrame, path: str) -> None:
    """Parquet by company; only the partitions present in ``df`` are replaced."""
    (
        without_time_zone(df)
        .withColumn("company_origin", company_origin(F.col("employee_id")))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("company_origin")
        .parquet(path)
    )


# Values are written as they are, quotes doubled.
_CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV).csv(path)


def append_dead_letters(df: DataFrame, path: str) -> None:
    df.write.mode("append").options(**_CSV).csv(path)
