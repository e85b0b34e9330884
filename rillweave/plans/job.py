"""The whole job: read, quarantine, clean, resolve, validate, export."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillweave.config import API, BENEFITS, DEFAULT, HRIS, PAYROLL, IntegrationConfig
from rillweave.operators.profile import (
    enrollment_rate,
    headcount_by_country,
    headcount_by_department,
    quality_summary,
    salary_density,
    salary_distribution,
    tenure_histogram,
)
from rillweave.operators.quality import GateFailed, run_validation
from rillweave.plans.clean import apply_layers, cleaning_layers, unmapped_departments
from rillweave.plans.resolve import Resolution, resolve
from rillweave.plans.staging import Staging
from rillweave.sources.extracts import EXTRACTORS, READ_ERRORS, Extract, failure_kind, union_sources, unreadable_extract
from rillweave.sources.readers import (
    BENEFIT_COLUMNS,
    PAYROLL_COLUMNS,
    read_csv,
    read_json_records,
    read_parquet,
    read_xml,
)
from rillweave.sources.sinks import append_dead_letters, write_csv, write_golden

HRIS_COLUMNS = (
    "employee_id", "first_name", "last_name", "email", "department", "job_title",
    "hire_date", "country", "employment_type", "manager_id",
)


@dataclass(frozen=True)
class JobResult:
    report: DataFrame
    gate_passed: bool
    resolution: Resolution


def read_extracts(
    spark: SparkSession,
    paths: Mapping[str, str],
    config: IntegrationConfig = DEFAULT,
    json_layout: str = "document",
    payroll_format: str = "csv",
    csv_multi_line: bool = False,
    on_missing: str = "empty",
) -> dict[str, Extract]:
    """All sources in load order, quarantined. A missing path counts as an empty source, one that cannot
    be read as a source with a letter about it (both raise with ``on_missing="fail"``).

    ``csv_multi_line=True`` allows line breaks inside quoted fields, for files that need not be split.
    """

    def csv(path: str, columns: tuple[str, ...]) -> DataFrame:
        return read_csv(spark, path, columns, csv_multi_line, on_missing)

    def payroll(path: str) -> DataFrame:
        if payroll_format == "parquet":
            return read_parquet(spark, path, PAYROLL_COLUMNS, on_missing)
        return csv(path, PAYROLL_COLUMNS)

    readers = {
        HRIS: lambda path: csv(path, HRIS_COLUMNS),
        API: lambda path: read_json_records(spark, path, json_layout, on_missing=on_missing),
        PAYROLL: payroll,
        BENEFITS: lambda path: read_xml(spark, path, on_missing=on_missing),
    }

    def extract(name: str) -> Extract:
        try:
            return EXTRACTORS[name](readers[name](paths[name]), config)
        except READ_ERRORS as e:
            if on_missing == "fail" or not failure_kind(e):
                raise
            return unreadable_extract(spark, name, [paths[name]], e)

    return {name: extract(name) for name in config.source_order}


def _landed(extracts: Mapping[str, Extract], as_of: date | str, stage: Staging, config: IntegrationConfig, isolate: bool) -> DataFrame:
    """All records of all sources, written once. If a file stops that, each source is written alone, and one
    that cannot be read becomes a letter that names its files."""
    layers = cleaning_layers(as_of, config)

    def written(some: Mapping[str, Extract], name: str) -> DataFrame:
        frames = [apply_layers(e.landed(config), layers) for e in some.values()]
        return stage(union_sources(frames), name, partition_by="_rejected")

    try:
        return written(extracts, "landed")
    except READ_ERRORS as e:
        if not isolate or not failure_kind(e):
            raise
    parts = []
    for name, extract in extracts.items():
        try:
            parts.append(written({name: extract}, f"landed_{name}"))
        except READ_ERRORS as e:
            if not failure_kind(e):
                raise
            letter = unreadable_extract(stage.spark, name, extract.rows.inputFiles(), e)
            parts.append(written({name: letter}, f"unreadable_{name}"))
    return union_sources(parts)


def land(
    extracts: Mapping[str, Extract], as_of: date | str, stage: Staging, config: IntegrationConfig, isolate: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read and clean every source once: (cleaned records, dead letters, counts per source).

    Good and bad records are written side by side as columnar partitions, so the raw files,
    the largest and slowest input, are parsed a single time. ``isolate``: a source that fails while it
    is read does not stop the others.
    """
    landed = _landed(extracts, as_of, stage, config, isolate)
    records = landed.where("NOT _rejected").drop("_reason", "_record", "_rejected")
    letters = landed.where("_rejected").selectExpr(
        "current_timestamp() AS timestamp", "source_system AS source", "_reason AS reason", "_record AS record"
    )
    found = landed.groupBy(F.col("source_system").alias("source")).agg(
        F.expr("count(1) AS raw"), F.expr("count_if(NOT _rejected) AS clean"), F.expr("count_if(_rejected) AS dropped")
    )
    names = stage.spark.createDataFrame([(name,) for name in extracts], "source string")
    counts = names.join(found, "source", "left").fillna(0)
    return records, letters, counts


def profiles(golden: DataFrame, report: DataFrame, as_of: date | str) -> dict[str, DataFrame]:
    return {
        "headcount_department": headcount_by_department(golden),
        "headcount_country": headcount_by_country(golden),
        "salary_distribution": salary_distribution(golden),
        "salary_density": salary_density(golden),
        "tenure_histogram": tenure_histogram(golden, as_of),
        "enrollment_rate": enrollment_rate(golden),
        "quality_summary": quality_summary(report),
    }


def run_job(
    spark: SparkSession,
    paths: Mapping[str, str],
    output: str,
    as_of: date | str | None = None,
    config: IntegrationConfig = DEFAULT,
    list_pairs: bool = False,
    **reader_options,
) -> JobResult:
    """Run everything and write the outputs below ``output``.

    Probable matches are written as links between groups of records and as the records of those groups;
    ``list_pairs`` adds the list of all record pairs, whose size grows with the square of a group. The report is written before the gate. A failed gate raises ``GateFailed`` and leaves
    golden data, reports and profiles unwritten.
    """
    as_of = as_of or date.today()
    stage = Staging(spark)
    extracts = read_extracts(spark, paths, config, **reader_options)
    records, letters, counts = land(extracts, as_of, stage, config, reader_options.get("on_missing") != "fail")
    append_dead_letters(letters, f"{output}/dead_letter")
    write_csv(counts.coalesce(1), f"{output}/ingest_counts")
    # A cleaned department is a standard name or one that no rule knows.
    write_csv(unmapped_departments(records, config), f"{output}/unmapped_departments")

    resolution = resolve(records, stage, config)
    golden = stage(resolution.golden, "golden")
    report, passed = run_validation(golden, config, as_of)
    write_csv(report.coalesce(1), f"{output}/validation_report")
    if not passed:
        raise GateFailed(f"more than {config.gate_max_failures} checks failed, see {output}/validation_report")

    for name, table in profiles(golden, report, as_of).items():
        write_csv(table, f"{output}/profile/{name}")
    write_golden(golden, f"{output}/golden")
    write_csv(resolution.ghosts, f"{output}/ghosts")
    links = stage(resolution.match_links, "match_links")
    write_csv(links, f"{output}/probable_match_links")
    write_csv(resolution.match_records, f"{output}/probable_match_records")
    if list_pairs:
        write_csv(resolution.probable_matches, f"{output}/probable_matches")
    return JobResult(report, passed, replace(resolution, golden=golden, match_links=links))
