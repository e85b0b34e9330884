"""Cleaning of aligned records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillweave.config import DEFAULT, IntegrationConfig
from rillweave.functions.dates import from_iso_order, iso_order, layout_number, out_of_range_flag, readable
from rillweave.functions.ids import id_number, id_prefix, namespaced
from rillweave.functions.money import annual_usd, positive, round_cents, to_double, without_symbols
from rillweave.functions.taxonomy import category, known_department
from rillweave.functions.text import clean_name, nullify, strip, title_case
from rillweave.sources.extracts import union_sources

NAME_COLUMNS = ("first_name", "last_name")
ID_COLUMNS = ("employee_id", "manager_id")
DATE_COLUMNS = ("hire_date", "effective_date", "enrollment_date")
NUMERIC_EXTRAS = ("bonus_target_pct", "premium_employee", "premium_employer")


Layers = list[dict[str, str]]


def side_by_side(*steps: Layers) -> list[dict[str, Column]]:
    """Parsed expressions of steps that are independent of each other: their layers of equal
    depth go together."""
    return [
        {c: F.expr(text) for part in parts for c, text in part.items()}
        for parts in zip_longest(*steps, fillvalue={})
    ]


def apply_layers(df: DataFrame, layers: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Apply expressions in layers: what a later layer uses several times is computed once.

    Columns whose name starts with ``_t_`` are dropped at the end.
    """
    for layer in layers:
        df = df.withColumns(layer)
    return df.drop(*(c for c in df.columns if c.startswith("_t_")))


def with_layers(df: DataFrame, *steps: Layers) -> DataFrame:
    return apply_layers(df, side_by_side(*steps))


def name_layers() -> Layers:
    return [{c: clean_name(c) for c in NAME_COLUMNS}]


def id_layers(config: IntegrationConfig = DEFAULT) -> Layers:
    """A reference (manager) may be absent; blank and spelled-out nulls count as absent too."""
    context = ("source_system", "payroll_company_source", config.id_namespace)
    parts = {f"_t_{c}_number": id_number(c) for c in ID_COLUMNS}
    parts |= {f"_t_{c}_prefix": id_prefix(c, *context) for c in ID_COLUMNS}
    return [
        {c: strip(c) for c in ID_COLUMNS},
        {"manager_id": nullify("manager_id", config.null_sentinels)},
        parts,
        {c: namespaced(c, f"_t_{c}_prefix", f"_t_{c}_number") for c in ID_COLUMNS},
    ]


def employment_type_layers(config: IntegrationConfig = DEFAULT) -> Layers:
    c = "employment_type"
    value = category(c, "_t_title", config.employment_types)
    return [{c: strip(c)}, {"_t_title": title_case(c)}, {c: value}]


def _known_department_layers(config: IntegrationConfig) -> Layers:
    """Stripped department, null when empty, and the standard name found for it."""
    c = "department"
    known = known_department(c, config.departments, config.standard_departments)
    return [{c: strip(c)}, {c: nullify(c, ("", "nan"))}, {"_t_known": known}]


def department_layers(config: IntegrationConfig = DEFAULT) -> Layers:
    """Unknown names stay as they are."""
    return [*_known_department_layers(config), {"department": "coalesce(_t_known, department)"}]


def date_layers(columns: Sequence[str], config: IntegrationConfig = DEFAULT) -> Layers:
    return [
        {c: strip(c) for c in columns},
        {f"_t_{c}": layout_number(c, config.date_rules) for c in columns},
        {c: iso_order(c, f"_t_{c}", config.date_rules) for c in columns},
        {c: from_iso_order(c) for c in columns},
        {c: readable(c) for c in columns},
    ]


def hire_date_layers(as_of: date | str, config: IntegrationConfig = DEFAULT) -> Layers:
    flag = out_of_range_flag("hire_date", "hire_date", config.hire_date_min, as_of)
    return [*date_layers(DATE_COLUMNS, config), {"hire_date_flag": flag}]


def salary_layers(config: IntegrationConfig = DEFAULT) -> Layers:
    base, annual = "base_salary", "salary_usd_annual"
    usd = annual_usd(base, "currency", "pay_frequency", config.fx_to_usd, config.periods_per_year)
    return [
        {base: without_symbols(base)},
        {base: to_double(base)},
        {base: positive(base)},
        {annual: usd},
        {annual: round_cents(annual)},
    ]


def numeric_layers() -> Layers:
    return [{c: f"try_cast({c} AS double)" for c in NUMERIC_EXTRAS}]


def normalize_names(df: DataFrame) -> DataFrame:
    return with_layers(df, name_layers())


def namespace_employee_ids(df: DataFrame, config: IntegrationConfig = DEFAULT) -> DataFrame:
    return with_layers(df, id_layers(config))


def normalize_employment_types(df: DataFrame, config: IntegrationConfig = DEFAULT) -> DataFrame:
    return with_layers(df, employment_type_layers(config))


def map_departments(df: DataFrame, config: IntegrationConfig = DEFAULT) -> DataFrame:
    return with_layers(df, department_layers(config))


def unmapped_departments(df: DataFrame, config: IntegrationConfig = DEFAULT) -> DataFrame:
    """Department names no rule knows, with their frequency."""
    layers = [*_known_department_layers(config), {"known": "_t_known"}]
    return (
        with_layers(df.select("department"), layers)
        .where("known IS NULL AND department IS NOT NULL")
        .groupBy("department")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def normalize_dates(
    df: DataFrame, as_of: date | str, config: IntegrationConfig = DEFAULT
) -> DataFrame:
    return with_layers(df, hire_date_layers(as_of, config))


def normalize_salaries(df: DataFrame, config: IntegrationConfig = DEFAULT) -> DataFrame:
    return with_layers(df, salary_layers(config))


def cleaning_layers(
    as_of: date | str, config: IntegrationConfig = DEFAULT
) -> list[dict[str, Column]]:
    """All cleaning steps; one narrow stage."""
    return side_by_side(
        name_layers(),
        id_layers(config),
        employment_type_layers(config),
        department_layers(config),
        hire_date_layers(as_of, config),
        salary_layers(config),
        numeric_layers(),
    )


def clean_all(
    frames: Mapping[str, DataFrame], as_of: date | str, config: IntegrationConfig = DEFAULT
) -> DataFrame:
    """Clean every source and union by name.

    Cleaning before the union lets Catalyst drop the steps for columns a source lacks.
    """
    layers = cleaning_layers(as_of, config)
    ordered = [frames[name] for name in config.source_order if name in frames]
    return union_sources([apply_layers(df, layers) for df in ordered])
