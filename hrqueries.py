"""The registered queries: every operator run on the fixture views of a data directory."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures import fixture, nested_records
from rillweave.config import DEFAULT, SOURCE_PRIORITY, UNKNOWN_PRIORITY
from rillweave.functions.similarity import token_sort_ratio
from rillweave.functions.taxonomy import source_priority
from rillweave.functions.text import nfc, strip, title_case
from rillweave.operators import profile
from rillweave.operators.email_merge import email_groups, email_members, email_merge, loser_map, remap_reference
from rillweave.operators.ghosts import ghosts
from rillweave.operators.interval import interval_partners
from rillweave.operators.quality import DataQuality, gate
from rillweave.operators.survivorship import nullify_sentinels
from rillweave.plans import clean as cleaning
from rillweave.plans.resolve import exact, merged, resolve
from rillweave.plans.staging import Staging
from rillweave.sources.extracts import (
    Extract,
    accepted_records,
    api_extract,
    benefits_extract,
    dead_letters,
    hris_extract,
    ingest_counts,
    payroll_extract,
    union_sources,
)
from rillweave.sources.readers import fence, read_csv, read_json_records, read_xml
from rillweave.sources.sinks import company_origin

# "Today" of every query, so that results do not depend on the day they run.
AS_OF = "2026-12-03"

HRIS_FIELDS = (
    "employee_id", "first_name", "last_name", "email", "department", "job_title",
    "hire_date", "country", "employment_type", "manager_id",
)
BENEFIT_FIELDS = (
    "employee_id", "plan_type", "coverage_level", "enrollment_date",
    "premium_employee", "premium_employer",
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# --- inputs ----------------------------------------------------------------------


def extracts(spark: SparkSession, sf: str) -> list[Extract]:
    return [
        hris_extract(fixture(spark, sf, "fx_hris")),
        api_extract(nested_records(fixture(spark, sf, "fx_api"))),
        payroll_extract(fixture(spark, sf, "fx_payroll")),
        benefits_extract(fixture(spark, sf, "fx_benefits")),
    ]


def aligned(spark: SparkSession, sf: str) -> DataFrame:
    return union_sources(accepted_records(extracts(spark, sf)))


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    frames = {e.name: e.accepted() for e in extracts(spark, sf)}
    return cleaning.clean_all(frames, AS_OF)


def survivors(spark: SparkSession, sf: str) -> DataFrame:
    return merged(cleaned(spark, sf), Staging(spark))


def quality(spark: SparkSession, sf: str) -> DataQuality:
    stage = Staging(spark)
    return DataQuality(stage(merged(cleaned(spark, sf), stage), "merged"), as_of=AS_OF)


def _ordered(df: DataFrame, *columns) -> DataFrame:
    """Columns of a source view with its input order under a plain name."""
    return df.select(F.col("_ord").alias("ord"), *columns)


# --- sources -----------------------------------------------------------------------


@query
def scan_csv_hris(spark: SparkSession, sf: str) -> DataFrame:
    view = fixture(spark, sf, "fx_hris")
    verbatim = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    line = F.to_csv(F.struct(*HRIS_FIELDS), verbatim)
    schema = ", ".join(f"{c} string" for c in HRIS_FIELDS)
    parsed = view.select(F.from_csv(line, schema, verbatim).alias("r"), "_ord").select("r.*", "_ord")
    return _ordered(hris_extract(parsed).rows, *HRIS_FIELDS)


@query
def flatten_json(spark: SparkSession, sf: str) -> DataFrame:
    flat = api_extract(nested_records(fixture(spark, sf, "fx_api"))).rows
    return _ordered(flat, *HRIS_FIELDS)


@query
def scan_payroll(spark: SparkSession, sf: str) -> DataFrame:
    rows = payroll_extract(fixture(spark, sf, "fx_payroll")).accepted()
    return _ordered(
        rows, "employee_id", "payroll_company_source", "base_salary", "currency",
        "pay_frequency", "bonus_target_pct", "effective_date", "source_system",
    )


@query
def scan_xml_benefits(spark: SparkSession, sf: str) -> DataFrame:
    view = fixture(spark, sf, "fx_benefits")
    element = F.concat(
        F.lit("<enrollment>"),
        *(F.concat(F.lit(f"<{c}>"), F.col(c), F.lit(f"</{c}>")) for c in BENEFIT_FIELDS),
        F.lit("</enrollment>"),
    )
    schema = ", ".join(f"{c} string" for c in BENEFIT_FIELDS)
    parsed = view.select(F.from_xml(element, schema, {"rowTag": "enrollment"}).alias("r"), "_ord")
    return _ordered(benefits_extract(parsed.select("r.*", "_ord")).accepted(), *BENEFIT_FIELDS)


@query
def align_schema(spark: SparkSession, sf: str) -> DataFrame:
    rows = payroll_extract(fixture(spark, sf, "fx_payroll")).accepted()
    return _ordered(rows, *DEFAULT.standard_columns, "source")


@query
def ingest_counts_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return ingest_counts(extracts(spark, sf))


QUERIES["ingest_counts"] = QUERIES.pop("ingest_counts_by_source")


@query
def quarantine_required(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        e.rows.where("_reason IS NOT NULL").select(
            F.lit(e.name).alias("source"), F.col("_ord").alias("ord"), F.col("_reason").alias("reason")
        )
        for e in extracts(spark, sf)
    ]
    return union_sources(parts)


@query
def quarantine_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Nested records damaged in several ways; the good ones pass."""
    view = fixture(spark, sf, "fx_api")
    text = F.expr(
        """CASE _ord % 5
             WHEN 0 THEN '"' || name_first || '"'
             WHEN 1 THEN '{"employee_identifier":"' || employee_identifier || '","name":null}'
             WHEN 2 THEN '{"employee_identifier":"' || employee_identifier || '","name":{"first":"a","last":"b"},"contact":"' || contact_email || '"}'
             WHEN 3 THEN '{"employee_identifier":"' || employee_identifier || '","name":{"first":"a"},"contact":{"email":"' || contact_email || '"}}'
             ELSE '{"employee_identifier":"' || employee_identifier || '","name":{"first":"a","last":null},"contact":{"email":"' || contact_email || '"}}'
           END"""
    )
    rows = api_extract(view.select(F.try_parse_json(text).alias("doc"), "_ord")).rows
    return _ordered(rows, "employee_id", "last_name", F.col("_reason").alias("reason"))


def _letters(extract: Extract) -> DataFrame:
    return extract.rejected().select("reason", "record")


@query
def quarantine_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Letters of CSV files in which some rows have a field too many, or too few."""
    header = ",".join(HRIS_FIELDS)
    line = f"""CASE WHEN _ord % 17 = 3 THEN concat_ws(',', {header}, 'surplus')
        WHEN _ord % 19 = 4 THEN concat_ws(',', employee_id, email) ELSE concat_ws(',', {header}) END"""
    path = f"{Staging(spark).path}/hris"
    # One column whose name is the header line, unquoted.
    plain = {"header": True, "sep": "\u0001", "quote": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    fixture(spark, sf, "fx_hris").select(F.expr(line).alias(header)).write.options(**plain).csv(path)
    return _letters(hris_extract(read_csv(spark, path, HRIS_FIELDS, on_missing="fail")))


_FOLDERS = 64


def _page_files(view: DataFrame, size: int, page: str) -> str:
    """Writes one file per page of ``size`` records (column ``item``); ``page`` is its text, from ``items``.

    Files share a fixed number of folders: a folder per file costs more than the file.
    """
    pages = view.groupBy(F.expr(f"_ord div {size}").alias("page")).agg(F.sort_array(F.collect_list(F.struct("_ord", "item"))).alias("rows"))
    path = f"{Staging(view.sparkSession).path}/pages"
    text = pages.withColumn("items", F.expr("rows.item")).select("page", F.expr(page).alias("value"))
    shared = text.select(F.expr(f"page % {_FOLDERS}").alias("folder"), "value")
    shared.write.option("maxRecordsPerFile", 1).partitionBy("folder").text(path)
    return path


@query
def quarantine_document(spark: SparkSession, sf: str) -> DataFrame:
    """Letters of JSON documents of which every third is cut off."""
    item = """'{"employee_identifier":"' || employee_identifier || '","name":{"first":"' || name_first || '"},"contact":{"email":"' || contact_email || '"}}'"""
    view = fixture(spark, sf, "fx_api").withColumn("item", F.expr(item))
    path = _page_files(view, 10, """'{"employees":[' || array_join(items, ',') || if(page % 3 = 1, '', ']}')""")
    return _letters(api_extract(read_json_records(spark, path, on_missing="fail")))


@query
def flatten_large_json(spark: SparkSession, sf: str) -> DataFrame:
    """Records of large JSON documents, which several tasks read."""
    nested = nested_records(fixture(spark, sf, "fx_api")).withColumn("item", F.to_json("doc"))
    path = _page_files(nested, 20_000, """'{"pages":[{"page":1},{"page":2}],"employees":[' || array_join(items, ',') || '],"total":{"records":' || size(items) || '}}'""")
    records = read_json_records(spark, path, "large_document", on_missing="fail")
    return api_extract(records).accepted().select(*HRIS_FIELDS)


@query
def quarantine_xml(spark: SparkSession, sf: str) -> DataFrame:
    """Letters of XML files of which every fourth ends within an element."""
    item = "'<enrollment><employee_id>' || employee_id || '</employee_id><plan_type>' || plan_type || '</plan_type></enrollment>'"
    view = fixture(spark, sf, "fx_benefits").withColumn("item", F.expr(item))
    path = _page_files(view, 500, "'<r>' || array_join(items, '') || if(page % 4 = 1, '<enrollment><employee_id>9', '</r>')")
    return _letters(benefits_extract(read_xml(spark, path, on_missing="fail")))


@query
def dead_letter(spark: SparkSession, sf: str) -> DataFrame:
    return dead_letters(extracts(spark, sf)).select("source", "reason", "record")


@query
def union_all_sources(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered(
        aligned(spark, sf), "employee_id", "source_system", "email", "base_salary",
        "plan_type", "source", "payroll_company_source",
    )


QUERIES["union_sources"] = QUERIES.pop("union_all_sources")


# --- cleaning ----------------------------------------------------------------------


@query
def nfc_names(spark: SparkSession, sf: str) -> DataFrame:
    """Names with their diaeresis written as a combining mark, composed again."""
    parts = {"\u00eb": "e\u0308", "\u00fc": "u\u0308"}
    apart = {
        c: f"replace(replace({c}, '\u00eb', '{parts[chr(0xEB)]}'), '\u00fc', '{parts[chr(0xFC)]}')"
        for c in cleaning.NAME_COLUMNS
    }
    rows = fence(fixture(spark, sf, "fx_hris").withColumns({c: F.expr(x) for c, x in apart.items()}))
    return _ordered(rows, *(F.expr(f"{strip(nfc(c))} AS {c}") for c in cleaning.NAME_COLUMNS))


@query
def normalize_names(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered(cleaning.normalize_names(fixture(spark, sf, "fx_hris")), "first_name", "last_name")


@query
def namespace_ids(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.namespace_employee_ids(aligned(spark, sf))
    return _ordered(rows, "source_system", "employee_id")


@query
def namespace_manager(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.namespace_employee_ids(aligned(spark, sf))
    return _ordered(rows, "source_system", "manager_id")


@query
def normalize_emp_type(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered(
        cleaning.normalize_employment_types(aligned(spark, sf)), "source_system", "employment_type"
    )


@query
def map_departments(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered(cleaning.map_departments(aligned(spark, sf)), "source_system", "department")


@query
def unmapped_values(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.unmapped_departments(aligned(spark, sf))


@query
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.normalize_dates(aligned(spark, sf), AS_OF)
    return _ordered(rows, "source_system", "hire_date", "effective_date", "enrollment_date")


@query
def flag_dates(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.normalize_dates(aligned(spark, sf), AS_OF)
    return _ordered(rows, "source_system", "hire_date_flag")


@query
def parse_salary(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.normalize_salaries(aligned(spark, sf))
    return _ordered(rows, "source_system", "base_salary")


@query
def annualize_salary(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.normalize_salaries(aligned(spark, sf))
    return _ordered(rows, "source_system", "salary_usd_annual")


@query
def nullify_sentinel_text(spark: SparkSession, sf: str) -> DataFrame:
    return _ordered(
        nullify_sentinels(fixture(spark, sf, "fx_hris")), "employee_id", "department", "country", "manager_id"
    )


QUERIES["nullify_sentinels"] = QUERIES.pop("nullify_sentinel_text")


@query
def title_case_names(spark: SparkSession, sf: str) -> DataFrame:
    view = fixture(spark, sf, "fx_hris")
    rows = view.selectExpr("_ord", "concat(trim(first_name), ' ', last_name) AS name", "email")
    return _ordered(rows, *(F.expr(f"{title_case(c)} AS {c}") for c in ("name", "email")))


QUERIES["title_case"] = QUERIES.pop("title_case_names")


@query
def company_origin_of_ids(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaning.namespace_employee_ids(aligned(spark, sf))
    return _ordered(rows, "source_system", company_origin(F.col("employee_id")).alias("company_origin"))


QUERIES["company_origin"] = QUERIES.pop("company_origin_of_ids")


@query
def priority_of_sources(spark: SparkSession, sf: str) -> DataFrame:
    rank = source_priority("source_systems", SOURCE_PRIORITY, UNKNOWN_PRIORITY)
    return exact(cleaned(spark, sf)).selectExpr("employee_id", "source_systems", f"{rank} AS priority")


QUERIES["source_priority"] = QUERIES.pop("priority_of_sources")


@query
def clean_all(spark: SparkSession, sf: str) -> DataFrame:
    rows = cleaned(spark, sf)
    return _ordered(rows, *DEFAULT.standard_columns, "source", "hire_date_flag", "salary_usd_annual")


# --- entity resolution ---------------------------------------------------------------


@query
def dedup_exact(spark: SparkSession, sf: str) -> DataFrame:
    return exact(cleaned(spark, sf))


@query
def dedup_provenance(spark: SparkSession, sf: str) -> DataFrame:
    return exact(cleaned(spark, sf)).select("employee_id", "source_systems", "dedup_method")


def _exact_staged(spark: SparkSession, sf: str) -> DataFrame:
    return Staging(spark)(exact(cleaned(spark, sf)), "exact")


@query
def dup_groups(spark: SparkSession, sf: str) -> DataFrame:
    staged = _exact_staged(spark, sf)
    return email_members(staged, email_groups(staged)).select("email", "employee_id", "group_size")


@query
def dedup_email(spark: SparkSession, sf: str) -> DataFrame:
    return survivors(spark, sf)


@query
def dedup_email_coalesced(spark: SparkSession, sf: str) -> DataFrame:
    """Merges across companies alone, in which winners take what they lack from losers."""
    return email_merge(_exact_staged(spark, sf), require_distinct_prefix=True, coalesce=True)


@query
def remap_fk(spark: SparkSession, sf: str) -> DataFrame:
    """Every record's manager before and after the losers are merged away."""
    staged = _exact_staged(spark, sf)
    ids = loser_map(email_members(staged, email_groups(staged)))
    rows = staged.select("employee_id", "manager_id", F.col("manager_id").alias("old_manager_id"))
    return remap_reference(rows, ids)


@query
def interval_self_join(spark: SparkSession, sf: str) -> DataFrame:
    return interval_partners(survivors(spark, sf), "hire_date", DEFAULT.date_window_days)


@query
def token_sort_similarity(spark: SparkSession, sf: str) -> DataFrame:
    """How alike a name and its "last, first" form are."""
    view = fixture(spark, sf, "fx_hris")
    forms = view.selectExpr(
        "_ord",
        "lower(concat(first_name, ' ', last_name)) AS name",
        "lower(concat(last_name, ', ', first_name)) AS listed",
    )
    return _ordered(forms, token_sort_ratio("name", "listed").alias("score"))


@query
def fuzzy_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return resolve(cleaned(spark, sf), Staging(spark)).probable_matches


@query
def fuzzy_links(spark: SparkSession, sf: str) -> DataFrame:
    """The review list in short: links between cells of records, with their numbers of pairs."""
    return resolve(cleaned(spark, sf), Staging(spark)).match_links


@query
def fuzzy_records(spark: SparkSession, sf: str) -> DataFrame:
    """The records of the linked cells."""
    return resolve(cleaned(spark, sf), Staging(spark)).match_records


@query
def flag_probable(spark: SparkSession, sf: str) -> DataFrame:
    golden_rows = resolve(cleaned(spark, sf), Staging(spark)).golden
    return golden_rows.select("employee_id", "probable_match_flag")


@query
def ghost_employees(spark: SparkSession, sf: str) -> DataFrame:
    return ghosts(survivors(spark, sf))


QUERIES["ghosts"] = QUERIES.pop("ghost_employees")


@query
def golden(spark: SparkSession, sf: str) -> DataFrame:
    return resolve(cleaned(spark, sf), Staging(spark)).golden


# --- quality -----------------------------------------------------------------------------


@query
def dq_not_null(spark: SparkSession, sf: str) -> DataFrame:
    checks = quality(spark, sf)
    for column in ("employee_id", "first_name", "last_name", "email", "department", "country"):
        checks.check_not_null(column)
    return checks.check_not_null("no_such_column").report()


@query
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality(spark, sf).check_unique("email").check_unique("employee_id").check_unique("no_such_column").report()


@query
def dq_in_set(spark: SparkSession, sf: str) -> DataFrame:
    checks = quality(spark, sf).check_values_in_set("employment_type", DEFAULT.valid_employment_types)
    return checks.check_values_in_set("currency", DEFAULT.valid_currencies).report()


@query
def dq_regex(spark: SparkSession, sf: str) -> DataFrame:
    checks = quality(spark, sf).check_regex("email", DEFAULT.email_pattern, "email format (RFC 5321)")
    return checks.check_regex(
        "employee_id", DEFAULT.employee_id_pattern, "employee_id format GT-XXXXXX or AC-XXXXXX"
    ).report()


@query
def dq_numeric_range(spark: SparkSession, sf: str) -> DataFrame:
    return quality(spark, sf).check_numeric_range(
        "salary_usd_annual", DEFAULT.salary_min_usd, DEFAULT.salary_max_usd
    ).report()


@query
def dq_date_range(spark: SparkSession, sf: str) -> DataFrame:
    checks = quality(spark, sf).check_date_range("hire_date", DEFAULT.hire_date_min)
    return checks.check_date_range("effective_date", "2012-01-01", "2018-12-31").report()


@query
def dq_ref_integrity(spark: SparkSession, sf: str) -> DataFrame:
    return quality(spark, sf).check_referential_integrity("manager_id", "employee_id").report()


@query
def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality(spark, sf).run_all_checks().report()


@query
def dq_gate(spark: SparkSession, sf: str) -> DataFrame:
    return gate(dq_report(spark, sf), DEFAULT.gate_max_failures)


@query
def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return profile.quality_summary(dq_report(spark, sf))


# --- profile -----------------------------------------------------------------------------


@query
def headcount_department(spark: SparkSession, sf: str) -> DataFrame:
    return profile.headcount_by_department(survivors(spark, sf))


@query
def headcount_country(spark: SparkSession, sf: str) -> DataFrame:
    return profile.headcount_by_country(survivors(spark, sf))


@query
def salary_distribution(spark: SparkSession, sf: str) -> DataFrame:
    stage = Staging(spark)
    return profile.salary_distribution(stage(merged(cleaned(spark, sf), stage), "merged"))


@query
def salary_density(spark: SparkSession, sf: str) -> DataFrame:
    stage = Staging(spark)
    return profile.salary_density(stage(merged(cleaned(spark, sf), stage), "merged"))


@query
def tenure_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return profile.tenure_histogram(survivors(spark, sf), AS_OF)


@query
def enrollment_rate(spark: SparkSession, sf: str) -> DataFrame:
    return profile.enrollment_rate(survivors(spark, sf))
