"""Payroll records without a counterpart in an HR system."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillweave.config import API, GHOST_REASON, HRIS, PAYROLL
from rillweave.functions.text import full_name


def ghost_report(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("employee_id").alias("payroll_employee_id"),
        F.expr(full_name("first_name", "last_name")).alias("name"),
        "salary_usd_annual",
        F.lit(GHOST_REASON).alias("ghost_flag_reason"),
    )


def ghosts(df: DataFrame) -> DataFrame:
    """Golden records whose provenance names payroll and no HR system."""
    sources = F.col("source_systems")
    return ghost_report(
        df.where(sources.contains(PAYROLL) & ~sources.contains(HRIS) & ~sources.contains(API))
    )


def payroll_only_ids(records: DataFrame) -> DataFrame:
    """The same question put to source records: payroll ids that no HR source knows."""
    ids = records.where("employee_id IS NOT NULL")
    payroll = ids.where(F.col("source_system") == PAYROLL).select("employee_id").distinct()
    known = ids.where(F.col("source_system").isin(HRIS, API)).select("employee_id").distinct()
    return payroll.join(known, "employee_id", "left_anti")
