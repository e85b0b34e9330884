"""Fixture views: the given tables dressed up as four messy extracts (FIXTURES.md, part B).

The statements run unchanged on Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillweave.sources.readers import fence


FX_HRIS = r"""
SELECT c_custkey AS ord, CASE WHEN c_custkey % 211 = 5 THEN '' ELSE CAST(c_custkey + 1 AS STRING) END AS employee_id,
 CASE (c_custkey * 7) % 10 WHEN 0 THEN 'alice' WHEN 1 THEN 'BOB' WHEN 2 THEN '  Carol ' WHEN 3 THEN 'jean-luc' WHEN 4 THEN 'o''neil' WHEN 5 THEN 'mary ann' WHEN 6 THEN 'dIEGO' WHEN 7 THEN 'zoë' WHEN 8 THEN 'li' ELSE 'ANNE-marie' END AS first_name,
 (CASE (c_custkey * 13) % 11 WHEN 0 THEN 'smith' WHEN 1 THEN 'o''brien' WHEN 2 THEN 'van-der-berg' WHEN 3 THEN 'JONES' WHEN 4 THEN 'd''angelo' WHEN 5 THEN 'müller' WHEN 6 THEN 'Garcia' WHEN 7 THEN 'lee' WHEN 8 THEN 'smith-jones' WHEN 9 THEN 'NGUYEN' ELSE 'kowalski' END)
   || (CASE WHEN c_custkey % 9 = 0 THEN 's' ELSE '' END) AS last_name,
 CASE WHEN c_custkey % 97 = 3 THEN ' ' WHEN c_custkey % 53 = 1 THEN CASE WHEN c_custkey % 2 = 0 THEN 'no-at-sign' ELSE 'bad' || CAST(c_custkey AS STRING) || '.example' END WHEN c_custkey % 41 = 0 THEN 'shared' || CAST(c_custkey % 60 AS STRING) || '@contractor.example' ELSE 'u' || CAST(c_custkey AS STRING) || '@globaltech.example' END AS email,
 CASE c_custkey % 12 WHEN 0 THEN 'ENG-01' WHEN 1 THEN 'Engineering' WHEN 2 THEN 'engineering' WHEN 3 THEN 'HR' WHEN 4 THEN 'MKT-03' WHEN 5 THEN 'Information Technology' WHEN 6 THEN 'R&D' WHEN 7 THEN 'Mystery Unit' WHEN 8 THEN '' WHEN 9 THEN 'FIN-02' WHEN 10 THEN 'Cust Succ' ELSE 'OPS-01' END AS department,
 c_mktsegment || ' Analyst' AS job_title,
 CASE c_custkey % 6
  WHEN 0 THEN CAST(2005 + (c_custkey * 31) % 18 AS STRING) || '-' || LPAD(CAST(1 + (c_custkey * 17) % 12 AS STRING), 2, '0') || '-' || LPAD(CAST(1 + (c_custkey * 11) % 28 AS STRING), 2, '0')
  WHEN 1 THEN CAST(2005 + (c_custkey * 31) % 18 AS STRING) || '-' || LPAD(CAST(1 + (c_custkey * 17) % 12 AS STRING), 2, '0') || '-' || LPAD(CAST(1 + (c_custkey * 11) % 28 AS STRING), 2, '0') || 'T09:30:00'
  WHEN 2 THEN CAST(1 + (c_custkey * 17) % 12 AS STRING) || '/' || CAST(1 + (c_custkey * 11) % 28 AS STRING) || '/' || CAST(2005 + (c_custkey * 31) % 18 AS STRING)
  WHEN 3 THEN LPAD(CAST(1 + (c_custkey * 11) % 28 AS STRING), 2, '0') || '-Mar-' || CAST(2005 + (c_custkey * 31) % 18 AS STRING)
  WHEN 4 THEN CASE WHEN c_custkey % 7 = 0 THEN '1960-01-01' ELSE '12-25-2015' END
  ELSE CASE WHEN c_custkey % 5 = 0 THEN 'garbage' WHEN c_custkey % 5 = 1 THEN '2099-01-01' ELSE '25/12/2015' END END AS hire_date,
 CASE WHEN c_custkey % 29 = 0 THEN '' ELSE 'NATION_' || CAST(c_nationkey AS STRING) END AS country,
 CASE c_custkey % 7 WHEN 0 THEN 'Full-Time' WHEN 1 THEN 'FT' WHEN 2 THEN 'CONTRACTOR' WHEN 3 THEN 'Part Time' WHEN 4 THEN 'FULL-TIME' WHEN 5 THEN 'pt' ELSE 'Contractor' END AS employment_type,
 CASE WHEN c_custkey % 10 = 0 THEN '' ELSE CAST((c_custkey * 3) % 1600 + 1 AS STRING) END AS manager_id
FROM customer
"""


FX_API = r"""
SELECT s_suppkey AS ord, 'ACQ_' || LPAD(CAST(s_suppkey + 1 AS STRING), 5, '0') AS employee_identifier,
 CASE s_suppkey % 5 WHEN 0 THEN 'alice' WHEN 1 THEN 'bob' WHEN 2 THEN 'ZOË' WHEN 3 THEN 'jean-luc' ELSE 'Li' END AS name_first,
 CASE s_suppkey % 4 WHEN 0 THEN 'smyth' WHEN 1 THEN 'o''brien' WHEN 2 THEN 'Kowalsky' ELSE 'lee' END AS name_last,
 CASE WHEN s_suppkey % 3 = 0 THEN 'shared' || CAST(s_suppkey % 60 AS STRING) || '@contractor.example' ELSE 's' || CAST(s_suppkey AS STRING) || '@acquired.example' END AS contact_email,
 CASE s_suppkey % 4 WHEN 0 THEN 'Tech' WHEN 1 THEN 'Biz Dev' WHEN 2 THEN 'sales' ELSE 'Acctg' END AS assignment_department,
 'Role ' || CAST(s_suppkey % 6 AS STRING) AS assignment_role,
 CAST(2005 + (s_suppkey * 31) % 18 AS STRING) || '-' || LPAD(CAST(1 + (s_suppkey * 17) % 12 AS STRING), 2, '0') || '-' || LPAD(CAST(1 + (s_suppkey * 5) % 28 AS STRING), 2, '0') || 'T00:00:00' AS assignment_hire_timestamp,
 'NATION_' || CAST(s_nationkey AS STRING) AS assignment_location,
 CASE s_suppkey % 3 WHEN 0 THEN 'FT' WHEN 1 THEN 'PT' ELSE 'CT' END AS employment_type,
 'ACQ_' || LPAD(CAST((s_suppkey * 7) % 100 + 1 AS STRING), 5, '0') AS manager_employee_id
FROM supplier
"""


FX_PAYROLL = r"""
SELECT o_orderkey AS ord,
 CASE WHEN o_orderkey % 503 = 7 THEN CAST(NULL AS STRING) WHEN o_orderkey % 89 = 0 THEN CAST(900000 + o_orderkey % 50 AS STRING) WHEN o_orderkey % 6 = 0 THEN CAST(o_custkey % 10 + 1 AS STRING) ELSE CAST(o_custkey + 1 AS STRING) END AS employee_id,
 CASE WHEN o_orderkey % 89 <> 0 AND o_orderkey % 6 = 0 THEN 'AcquiredCo Inc' ELSE 'GlobalTech' END AS source,
 CASE o_orderkey % 8 WHEN 0 THEN '$' || CAST(CAST(FLOOR(o_totalprice) AS BIGINT) AS STRING) WHEN 1 THEN '€ 85,000.50' WHEN 2 THEN '-5' WHEN 3 THEN '(500)' WHEN 4 THEN ' ' ELSE CAST(CAST(FLOOR(o_totalprice) AS BIGINT) AS STRING) END AS base_salary,
 CASE o_orderkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'eur ' WHEN 2 THEN 'GBP' WHEN 3 THEN 'CHF' ELSE CAST(NULL AS STRING) END AS currency,
 CASE o_orderkey % 6 WHEN 0 THEN 'Annual' WHEN 1 THEN 'Monthly' WHEN 2 THEN 'Bi-Weekly' WHEN 3 THEN 'Weekly' WHEN 4 THEN 'MONTHLY' ELSE CAST(NULL AS STRING) END AS pay_frequency,
 CAST(o_orderkey % 25 AS STRING) AS bonus_target_pct,
 CAST(2010 + o_orderkey % 12 AS STRING) || '-06-01' AS effective_date
FROM orders
"""


FX_BENEFITS = r"""
SELECT event_id AS ord, CASE WHEN event_id % 301 = 4 THEN ' ' ELSE ' ' || CAST((event_id * 7) % 1600 + 1 AS STRING) END AS employee_id,
 CASE event_type WHEN 'click' THEN 'Health Insurance' WHEN 'view' THEN '401(k)' ELSE 'Dental' END AS plan_type,
 CASE event_id % 4 WHEN 0 THEN 'Individual' WHEN 1 THEN 'Family' WHEN 2 THEN 'Employee+Spouse' ELSE 'Employee+Child' END AS coverage_level,
 CAST(2015 + event_id % 9 AS STRING) || '-01-01' AS enrollment_date,
 CAST(event_id % 400 AS STRING) AS premium_employee, CAST(event_id % 900 AS STRING) AS premium_employer
FROM events
"""


VIEWS = {
    "fx_hris": ("customer", FX_HRIS),
    "fx_api": ("supplier", FX_API),
    "fx_payroll": ("orders", FX_PAYROLL),
    "fx_benefits": ("events", FX_BENEFITS),
}

# The columns the views use.
SCHEMAS = {
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double",
    "events": "event_id bigint, event_type string",
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view; its input order ``ord`` becomes ``_ord``.

    The fence makes the view behave like a scanned file: its expressions run once per row.
    """
    table, sql = VIEWS[name]
    source = spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")
    view = spark.sql(sql.replace(f"FROM {table}", "FROM {source}"), source=source)
    return fence(view.withColumnRenamed("ord", "_ord"))


def fixture_sql() -> str:
    """The views as DuckDB common table expressions."""
    return ",\n".join(f"{name} AS ({sql.strip()})" for name, (_, sql) in VIEWS.items())


def records_json() -> str:
    """SQL expression for one nested record of the ``fx_api`` view as JSON text."""
    return """to_json(named_struct(
        'employee_identifier', employee_identifier,
        'name', named_struct('first', name_first, 'last', name_last),
        'contact', named_struct('email', contact_email),
        'assignment', named_struct('department', assignment_department, 'role', assignment_role,
            'hire_timestamp', assignment_hire_timestamp, 'location', assignment_location),
        'employment', named_struct('type', employment_type),
        'manager_employee_id', manager_employee_id))"""


def nested_records(view: DataFrame) -> DataFrame:
    """The ``fx_api`` view as nested records in a variant column."""
    return fence(view.select(F.parse_json(F.expr(records_json())).alias("doc"), "_ord"))
