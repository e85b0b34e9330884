"""The four extracts: from raw columns to aligned, tagged and quarantined records."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillweave.config import API, BENEFITS, DEFAULT, HRIS, PAYROLL, IntegrationConfig
from rillweave.functions.text import is_blank, quote, strip
from rillweave.sources.readers import ORD_TYPE, fence

# Target column -> path in a nested record (fixed values).
API_PATHS = {
    "employee_id": "$.employee_identifier",
    "first_name": "$.name.first",
    "last_name": "$.name.last",
    "email": "$.contact.email",
    "department": "$.assignment.department",
    "job_title": "$.assignment.role",
    "hire_date": "$.assignment.hire_timestamp",
    "country": "$.assignment.location",
    "employment_type": "$.employment.type",
    "manager_id": "$.manager_employee_id",
}
# Order in which the parents are looked at; the first bad one names the error.
API_PARENTS = ("name", "contact", "assignment", "employment")

DEFAULT_COMPANY = "GlobalTech"


@dataclass(frozen=True)
class Extract:
    """Records of one source with ``_ord``, ``_reason`` (null: accepted) and maybe ``_raw``.

    ``derived`` fields were not in the source: dead letters leave them out.
    """

    name: str
    rows: DataFrame
    derived: tuple[str, ...] = ()

    @property
    def fields(self) -> list[str]:
        return [c for c in self.rows.columns if not c.startswith("_")]

    def accepted(self, config: IntegrationConfig = DEFAULT) -> DataFrame:
        """Clean rows in the standard schema, tagged with source and load position."""
        tags = {
            "source_system": quote(self.name),
            "_src": str(config.source_order.index(self.name)),
        }
        kept = [c for c in (*self.fields, "_ord") if c not in tags]
        return align(self.rows.where("_reason IS NULL"), config.standard_columns, kept, tags)

    def _record(self) -> str:
        """The fields of a record as JSON, or its raw text where it could not be flattened."""
        fields = ", ".join(f"cast(`{c}` AS string) AS `{c}`" for c in self.fields if c not in self.derived)
        if not fields:
            return "_raw"
        record = f"to_json(struct({fields}), map('ignoreNullFields', 'false'))"
        return f"coalesce(_raw, {record})" if "_raw" in self.rows.columns else record

    def rejected(self) -> DataFrame:
        """Dead letters: one uniform row per bad record, its fields kept as JSON."""
        return self.rows.where("_reason IS NOT NULL").selectExpr(
            "current_timestamp() AS timestamp",
            f"{quote(self.name)} AS source",
            "_reason AS reason",
            f"{self._record()} AS record",
        )

    def landed(self, config: IntegrationConfig = DEFAULT) -> DataFrame:
        """Good and bad records together, aligned; bad ones carry ``_reason`` and ``_record``."""
        tags = {
            "source_system": quote(self.name),
            "_src": str(config.source_order.index(self.name)),
            "_record": f"CASE WHEN _reason IS NOT NULL THEN {self._record()} END",
            "_rejected": "_reason IS NOT NULL",
        }
        kept = [c for c in (*self.fields, "_ord", "_reason") if c not in tags]
        return align(self.rows, config.standard_columns, kept, tags)

    def counts(self) -> DataFrame:
        dropped = F.count("_reason")
        return self.rows.agg(F.count(F.lit(1)).alias("raw"), dropped.alias("dropped")).select(
            F.lit(self.name).alias("source"),
            "raw",
            (F.col("raw") - F.col("dropped")).alias("clean"),
            "dropped",
        )


def align(
    df: DataFrame,
    columns: Sequence[str],
    kept: Sequence[str] | None = None,
    tags: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add the missing standard columns as null; extra columns stay, behind them.

    ``kept`` restricts the columns of ``df``, ``tags`` adds columns by expression.
    """
    given = {c: f"`{c}`" for c in (df.columns if kept is None else kept)} | dict(tags or {})
    standard = [f"{given.get(c, 'cast(NULL AS string)')} AS `{c}`" for c in columns]
    return df.selectExpr(*standard, *(f"{x} AS `{c}`" for c, x in given.items() if c not in columns))


def missing_fields_reason(
    df: DataFrame, required: Sequence[str], null_is_missing: bool = False
) -> Column:
    """``Missing required fields: ['a', 'b']`` or null. A null passes unless told otherwise."""

    def missing(c: str) -> str:
        if c not in df.columns:
            return "true"
        return f"coalesce({is_blank(c)}, {null_is_missing})"

    names = ", ".join(f"CASE WHEN {missing(c)} THEN {quote(repr(c))} END" for c in required)
    listed = f"concat_ws(', ', {names})"
    return F.expr(
        f"CASE WHEN {listed} <> '' THEN concat('Missing required fields: [', {listed}, ']') END"
    )


def _unreadable(df: DataFrame, what: str) -> Column:
    """The reason for rows that the reader could not parse."""
    if "_raw" not in df.columns:
        return F.lit(None).cast("string")
    problem = F.coalesce("_problem", F.lit(what)) if "_problem" in df.columns else F.lit(what)
    return F.when(F.col("_raw").isNotNull(), F.concat(F.lit("Parse error: "), problem))


_BAD_ROW = "row does not fit the header"


def _quarantined(df: DataFrame, name: str, config: IntegrationConfig, derived: tuple[str, ...] = ()) -> Extract:
    missing = missing_fields_reason(df, config.required_fields[name], config.null_is_missing)
    return Extract(name, df.withColumn("_reason", F.coalesce(_unreadable(df, _BAD_ROW), missing)), derived)


def hris_extract(raw: DataFrame, config: IntegrationConfig = DEFAULT) -> Extract:
    """CSV rows. The reader cannot tell an empty field from null, here both are empty text."""
    kept = [c for c in raw.columns if c in ("_ord", "_raw", "_problem")]
    fields = [c for c in raw.columns if c not in kept]
    filled = raw.selectExpr(*(f"coalesce(`{c}`, '') AS `{c}`" for c in fields), *kept)
    return _quarantined(filled, HRIS, config)


def payroll_extract(raw: DataFrame, config: IntegrationConfig = DEFAULT) -> Extract:
    """Tabular rows, nulls kept. The paying company decides the id namespace later."""
    company = F.col("source") if "source" in raw.columns else F.lit(DEFAULT_COMPANY)
    derived = "payroll_company_source"
    return _quarantined(raw.withColumn(derived, company), PAYROLL, config, (derived,))


def benefits_extract(raw: DataFrame, config: IntegrationConfig = DEFAULT) -> Extract:
    """XML elements. An absent text field counts as empty, an absent premium as null."""
    texts = ("employee_id", "plan_type", "coverage_level", "enrollment_date")
    rows = raw.withColumns({c: F.expr(strip(f"coalesce({c}, '')")) for c in texts})
    missing = F.when(F.col("employee_id") == "", F.lit("Missing employee_id"))
    unreadable = _unreadable(raw, "element is not well-formed")
    return Extract(BENEFITS, rows.withColumn("_reason", F.coalesce(unreadable, missing)))


def _leaf(path: str) -> Column:
    """Absent gives empty text, an explicit null gives null."""
    value = f"try_variant_get(doc, '{path}', 'variant')"
    text = f"coalesce(try_variant_get(doc, '{path}', 'string'), to_json({value}))"
    return F.expr(
        f"CASE WHEN {value} IS NULL THEN '' WHEN NOT is_variant_null({value}) THEN {text} END"
    )


def _parse_error() -> Column:
    """Why a record cannot be flattened: it, or a parent object in it, is no object."""

    def no_object(value: str) -> str:
        return f"NOT startswith(schema_of_variant({value}), 'OBJECT')"

    cases = [f"WHEN doc IS NULL OR {no_object('doc')} THEN 'Parse error: record is not an object'"]
    for parent in API_PARENTS:
        value = f"try_variant_get(doc, '$.{parent}', 'variant')"
        cases.append(
            f"WHEN {value} IS NOT NULL AND {no_object(value)} "
            f"THEN 'Parse error: {parent} is not an object'"
        )
    return F.expr(f"CASE {' '.join(cases)} END")


def api_extract(raw: DataFrame, config: IntegrationConfig = DEFAULT) -> Extract:
    """Nested records (variant column ``doc``) flattened to standard names."""
    unread = F.col("_raw") if "_raw" in raw.columns else F.lit(None).cast("string")
    unreadable = _unreadable(raw, "no JSON record")
    flat = raw.select(
        *(_leaf(path).alias(c) for c, path in API_PATHS.items()),
        "_ord",
        "doc",
        unread.alias("_raw"),
        F.coalesce(unreadable, _parse_error()).alias("_error"),
    )
    raw_text = F.when(F.col("_error").isNotNull(), F.coalesce("_raw", F.to_json("doc")))
    rows = fence(flat.withColumn("_raw", raw_text).drop("doc"))
    missing = missing_fields_reason(rows, config.required_fields[API], config.null_is_missing)
    return Extract(API, rows.withColumn("_reason", F.coalesce("_error", missing)).drop("_error"))


def unreadable_extract(spark: SparkSession, name: str, files: Sequence[str], error: Exception) -> Extract:
    """A source that could not be read: one letter with its files and the kind of failure."""
    rows = spark.createDataFrame(
        [(json.dumps({"files": list(files)}), f"Source unreadable: {failure_kind(error)}")], "_raw string, _reason string"
    )
    return Extract(name, rows.withColumn("_ord", F.lit(None).cast(ORD_TYPE)))


def failure_kind(error: Exception) -> str | None:
    """The condition of an error that comes from a file, null for any other (a lost cluster, a full disk)."""
    if isinstance(error, PySparkException) and (error.getCondition() or "").startswith(_READ_FAILURES):
        return error.getCondition().split(".")[0]
    named = re.search(rf"\[((?:{'|'.join(_READ_FAILURES)})\w*)|{re.escape(_BAD_CHECKSUM)}", str(error))
    return named and (named[1] or "FAILED_READ_FILE")


#: What Spark raises when a file cannot be read, while planning or in a task.
READ_ERRORS = (PySparkException, Py4JJavaError)
#: Raised as it is, without a condition, by readers of file footers.
_BAD_CHECKSUM = "org.apache.hadoop.fs.ChecksumException: Checksum error"
_READ_FAILURES = ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "MALFORMED", "UNABLE_TO_INFER_SCHEMA", "PARQUET_TYPE", "PARQUET_CONVERSION")

EXTRACTORS = {
    HRIS: hris_extract,
    API: api_extract,
    PAYROLL: payroll_extract,
    BENEFITS: benefits_extract,
}


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def accepted_records(extracts: Sequence[Extract], config: IntegrationConfig = DEFAULT) -> list[DataFrame]:
    return [e.accepted(config) for e in extracts]


def dead_letters(extracts: Sequence[Extract]) -> DataFrame:
    return union_sources([e.rejected() for e in extracts])


def ingest_counts(extracts: Sequence[Extract]) -> DataFrame:
    """Raw, clean and dropped rows per source, with a row for empty sources too."""
    return union_sources([e.counts() for e in extracts])
