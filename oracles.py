"""SQL oracles: the registered queries written independently in DuckDB SQL.

They share with the Spark code only the fixture views and the fixed values.
"""

from __future__ import annotations

from fixtures import fixture_sql
from rillweave import config as c

AS_OF = "2026-12-03"


def _case_map(x: str, mapping: dict) -> str:
    def lit(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v)

    return f"CASE {x} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items()) + " END"


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _capitalize(x: str) -> str:
    return f"(upper({x}[1]) || lower({x}[2:]))"


def _name(x: str) -> str:
    inner = f"array_to_string(list_transform(string_split(seg, ''''), lambda p: {_capitalize('p')}), '''')"
    return f"array_to_string(list_transform(string_split(trim(nfc_normalize({x})), '-'), lambda seg: {inner}), '-')"


def _title(x: str) -> str:
    return (
        f"array_to_string(list_transform(range(1, len({x}) + 1), lambda i: "
        f"CASE WHEN i = 1 OR NOT regexp_matches({x}[i - 1], '\\p{{L}}') THEN upper({x}[i]) ELSE lower({x}[i]) END), '')"
    )


def _id(x: str) -> str:
    number = "CAST(regexp_extract({}, '[0-9]+') AS BIGINT)"
    s = f"trim({x})"
    prefix = (
        "CASE source_system WHEN 'acquiredco_api' THEN 'AC' WHEN 'payroll' THEN "
        "CASE WHEN lower(coalesce(payroll_company_source, '')) LIKE '%acquired%' THEN 'AC' ELSE 'GT' END ELSE 'GT' END"
    )
    return (
        f"CASE WHEN regexp_full_match({s}, '(GT|AC)-\\d{{6}}') THEN {s} "
        f"WHEN {s} LIKE 'ACQ_%' THEN 'AC-' || printf('%06d', {number.format(s)}) "
        f"WHEN regexp_full_match({s}, '\\d+') THEN {prefix} || '-' || printf('%06d', {number.format(s)}) ELSE {s} END"
    )


_FORMATS = "['%Y-%m-%d', '%Y-%m-%dT%H:%M:%S', '%m/%d/%Y', '%d-%b-%Y', '%d/%m/%Y', '%m-%d-%Y']"


def _date(x: str) -> str:
    return f"try_strptime(trim({x}), {_FORMATS})"


def _money(x: str) -> str:
    return f"TRY_CAST(regexp_replace({x}, '[£€$,\\s]', '', 'g') AS DOUBLE)"


def _cents(x: str) -> str:
    return f"(floor({x}) * 100 + round_even(({x} - floor({x})) * 100, 0)) / 100"


_STANDARD = {d: d for d in c.STANDARD_DEPARTMENTS}
_FOLDED = {d.lower(): d for d in c.STANDARD_DEPARTMENTS}
_KNOWN_DEPARTMENT = (
    f"coalesce({_case_map('trim(department)', _STANDARD)}, {_case_map('trim(department)', c.DEPARTMENT_CODES)}, "
    f"{_case_map('trim(department)', c.DEPARTMENT_ALIASES)}, {_case_map('lower(trim(department))', _FOLDED)})"
)
_TYPE = f"""CASE WHEN trim(employment_type) <> '' THEN coalesce(
    {_case_map('trim(employment_type)', c.EMPLOYMENT_TYPES)},
    {_case_map(_title('trim(employment_type)'), c.EMPLOYMENT_TYPES)}, {_title('trim(employment_type)')}) END"""
_FX = f"coalesce({_case_map('upper(trim(currency))', c.FX_TO_USD)}, 1.0)::DOUBLE"
_TIMES = f"coalesce({_case_map('trim(pay_frequency)', c.PERIODS_PER_YEAR)}, 1)::DOUBLE"

_NULLS = {k: f"CAST(NULL AS VARCHAR) AS {k}" for k in c.STANDARD_COLUMNS}


def _aligned(given: dict[str, str], source: str) -> str:
    cols = [f"{given[k]} AS {k}" if k in given else _NULLS[k] for k in c.STANDARD_COLUMNS]
    return ", ".join(cols) + f", ord, {source} AS source"


_HR = ("employee_id", "first_name", "last_name", "email", "department", "job_title", "hire_date",
       "country", "employment_type", "manager_id")
_API = {
    "employee_id": "employee_identifier", "first_name": "name_first", "last_name": "name_last",
    "email": "contact_email", "department": "assignment_department", "job_title": "assignment_role",
    "hire_date": "assignment_hire_timestamp", "country": "assignment_location",
    "employment_type": "employment_type", "manager_id": "manager_employee_id",
}
_PAY = ("employee_id", "base_salary", "currency", "pay_frequency", "bonus_target_pct", "effective_date")
_BEN = ("employee_id", "plan_type", "coverage_level", "enrollment_date")


def _missing(names) -> str:
    parts = ", ".join(f"CASE WHEN trim({n}) = '' THEN '''{n}''' END" for n in names)
    return f"list_filter([{parts}], lambda m: m IS NOT NULL)"


def _reason(names) -> str:
    m = _missing(names)
    return f"CASE WHEN len({m}) > 0 THEN 'Missing required fields: [' || array_to_string({m}, ', ') || ']' END"


_BASE = f"""
{fixture_sql()},
tagged_hris AS (SELECT *, {_reason(c.REQUIRED_FIELDS[c.HRIS])} AS reason FROM fx_hris),
tagged_payroll AS (SELECT *, {_reason(c.REQUIRED_FIELDS[c.PAYROLL])} AS reason FROM fx_payroll),
tagged_benefits AS (SELECT *, CASE WHEN trim(employee_id) = '' THEN 'Missing employee_id' END AS reason FROM fx_benefits),
aligned AS MATERIALIZED (
 SELECT {_aligned({k: k for k in _HR} | {"source_system": "'globaltech_hris'"}, 'CAST(NULL AS VARCHAR)')}, 1 AS p FROM tagged_hris WHERE reason IS NULL
 UNION ALL
 SELECT {_aligned(_API | {"source_system": "'acquiredco_api'"}, 'CAST(NULL AS VARCHAR)')}, 2 AS p FROM fx_api
 UNION ALL
 SELECT {_aligned({k: k for k in _PAY} | {"source_system": "'payroll'", "payroll_company_source": "source"}, 'source')}, 3 AS p FROM tagged_payroll WHERE reason IS NULL
 UNION ALL
 SELECT {_aligned({k: f"trim({k})" for k in _BEN} | {k: k for k in ("premium_employee", "premium_employer")} | {"source_system": "'benefits'"}, 'CAST(NULL AS VARCHAR)')}, 4 AS p FROM tagged_benefits WHERE reason IS NULL
)"""

_CLEAN = f"""{_BASE},
parsed AS (
 SELECT ord, p, source, source_system, payroll_company_source, job_title, country, email, currency, pay_frequency, plan_type, coverage_level,
  {_id('employee_id')} AS employee_id,
  CASE WHEN trim(manager_id) NOT IN {_in(c.NULL_SENTINELS)} THEN {_id('manager_id')} END AS manager_id,
  {_name('first_name')} AS first_name, {_name('last_name')} AS last_name,
  {_TYPE} AS employment_type,
  CASE WHEN trim(department) NOT IN ('', 'nan') THEN coalesce({_KNOWN_DEPARTMENT}, trim(department)) END AS department,
  {_date('hire_date')} AS hire_date, {_date('effective_date')} AS effective_date, {_date('enrollment_date')} AS enrollment_date,
  CASE WHEN {_money('base_salary')} > 0 THEN {_money('base_salary')} END AS base_salary,
  TRY_CAST(bonus_target_pct AS DOUBLE) AS bonus_target_pct,
  TRY_CAST(premium_employee AS DOUBLE) AS premium_employee, TRY_CAST(premium_employer AS DOUBLE) AS premium_employer
 FROM aligned),
cleaned AS MATERIALIZED (
 SELECT *, CASE WHEN hire_date < TIMESTAMP '1970-01-01' THEN 'hire_date before 1970-01-01'
   WHEN hire_date > TIMESTAMP '{AS_OF}' THEN 'hire_date after {AS_OF}' END AS hire_date_flag,
  {_cents(f'(base_salary * {_FX} * {_TIMES})')} AS salary_usd_annual
 FROM parsed)"""

_TEXTS = ("first_name", "last_name", "email", "department", "job_title", "country", "employment_type",
          "manager_id", "currency", "pay_frequency", "plan_type", "coverage_level", "payroll_company_source",
          "hire_date_flag", "source")
_TYPED = ("hire_date", "base_salary", "bonus_target_pct", "effective_date", "enrollment_date",
          "premium_employee", "premium_employer", "salary_usd_annual")
_GOLDEN = ("employee_id", *_TEXTS, *_TYPED, "source_systems", "dedup_method")


def _first(x: str, text: bool) -> str:
    usable = f"{x} NOT IN {_in(c.NULL_SENTINELS)}" if text else f"{x} IS NOT NULL"
    return f"first({x} ORDER BY p, ord) FILTER (WHERE {usable}) AS {x}"


_EXACT = f"""{_CLEAN},
grouped AS (
 SELECT employee_id, {', '.join(_first(x, True) for x in _TEXTS)}, {', '.join(_first(x, False) for x in _TYPED)},
  array_to_string(list_sort(list(DISTINCT source_system)), ',') AS source_systems
 FROM cleaned WHERE employee_id NOT IN {_in(c.NULL_SENTINELS)} GROUP BY employee_id),
exact AS MATERIALIZED (
 SELECT *, CASE WHEN source_systems LIKE '%,%' THEN 'exact_id' ELSE 'single_source' END AS dedup_method,
  CASE WHEN source_systems LIKE '%globaltech_hris%' THEN 1 WHEN source_systems LIKE '%acquiredco_api%' THEN 2
   WHEN source_systems LIKE '%payroll%' THEN 3 ELSE 4 END AS priority
 FROM grouped)"""

_MERGED = f"""{_EXACT},
ranked AS (
 SELECT employee_id, email, source_systems,
  row_number() OVER (PARTITION BY email ORDER BY priority, employee_id) AS rn,
  count(*) OVER (PARTITION BY email) AS group_size,
  first(employee_id) OVER (PARTITION BY email ORDER BY priority, employee_id) AS winner_id
 FROM exact WHERE trim(email) <> ''),
joined_sources AS (
 SELECT winner_id, array_to_string(list_sort(list(DISTINCT source_systems)), ',') AS merged
 FROM ranked WHERE group_size > 1 GROUP BY winner_id),
losers AS (SELECT employee_id AS loser_id, winner_id FROM ranked WHERE group_size > 1 AND rn > 1),
merged AS MATERIALIZED (
 SELECT e.* EXCLUDE (priority) REPLACE (
   coalesce(m.winner_id, e.manager_id) AS manager_id,
   coalesce(j.merged, e.source_systems) AS source_systems,
   CASE WHEN j.merged IS NOT NULL THEN 'email_match' ELSE e.dedup_method END AS dedup_method)
 FROM exact e
 LEFT JOIN joined_sources j ON j.winner_id = e.employee_id
 LEFT JOIN losers m ON m.loser_id = e.manager_id
 WHERE e.employee_id NOT IN (SELECT loser_id FROM losers))"""


def _lcs(a: str, b: str) -> str:
    return (
        f"list_last(list_reduce(list_prepend(list_resize([0], len({b}) + 1, 0)::BIGINT[], list_transform(string_split({a}, ''), lambda ca: [unicode(ca)::BIGINT])), "
        f"lambda row, ca: list_reduce(list_prepend([0]::BIGINT[], list_transform(range(1, len({b}) + 1), lambda j: [j]::BIGINT[])), "
        f"lambda acc, j: list_append(acc, CASE WHEN unicode({b}[j[1]]) = ca[1] THEN row[j[1]] + 1 ELSE greatest(acc[-1], row[j[1] + 1]) END))))"
    )


def _score(a: str, b: str) -> str:
    total = f"(len({a}) + len({b}))"
    return f"(1.0::DOUBLE - ({total} - 2 * {_lcs(a, b)})::DOUBLE / {total}) * 100.0::DOUBLE"


def _tokens(x: str) -> str:
    return f"array_to_string(list_sort(string_split_regex(trim({x}), '\\s+')), ' ')"


_PAIRS = f"""{_MERGED},
people AS MATERIALIZED (
 SELECT employee_id, hire_date, source_systems, name, {_tokens('name')} AS key
 FROM (SELECT *, lower(trim(coalesce(first_name, '') || ' ' || coalesce(last_name, ''))) AS name FROM merged WHERE hire_date IS NOT NULL)),
near AS MATERIALIZED (
 SELECT a.employee_id AS id1, b.employee_id AS id2, a.name AS n1, b.name AS n2, a.key AS k1, b.key AS k2,
  (epoch_us(b.hire_date) - epoch_us(a.hire_date)) // 86400000000 AS days, a.source_systems AS s1, b.source_systems AS s2
 FROM people a JOIN people b ON (a.hire_date, a.employee_id) < (b.hire_date, b.employee_id)
  AND b.hire_date <= a.hire_date + INTERVAL 30 DAY),
key_pairs AS MATERIALIZED (SELECT DISTINCT least(k1, k2) AS ka, greatest(k1, k2) AS kb FROM near),
scored AS MATERIALIZED (SELECT ka, kb, {_score('ka', 'kb')} AS score FROM key_pairs),
pairs AS MATERIALIZED (
 SELECT id1, id2, n1, n2, days, s1, s2, score FROM near JOIN scored ON ka = least(k1, k2) AND kb = greatest(k1, k2) WHERE score >= 88)"""

_CELLS = f"""{_PAIRS},
placed AS MATERIALIZED (SELECT *, CAST(floor(epoch_us(hire_date) / 2592000000000) AS INTEGER) AS bucket FROM people),
cells AS (SELECT bucket, key, count(*) AS n FROM placed GROUP BY bucket, key),
linked AS MATERIALIZED (
 SELECT least((p.bucket, p.key), (q.bucket, q.key)) AS one, greatest((p.bucket, p.key), (q.bucket, q.key)) AS two,
  one[1] AS bucket_1, one[2] AS name_1, two[1] AS bucket_2, two[2] AS name_2, score
 FROM pairs JOIN placed p ON p.employee_id = id1 JOIN placed q ON q.employee_id = id2)"""

_FLAGGED = f"""{_PAIRS},
golden AS (SELECT *, employee_id IN (SELECT id1 FROM pairs UNION SELECT id2 FROM pairs) AS probable_match_flag FROM merged)"""

_CHECK_NAMES = {
    "employee_id": 1, "first_name": 2, "last_name": 3, "email": 4, "department": 5, "country": 6,
}


def _check(position: int, name: str, description: str, total: str, failed: str, where: str = "", skip: bool = False) -> str:
    return (
        f"SELECT {position} AS position, '{name}' AS \"check\", '{description}' AS description, "
        f"({total})::BIGINT AS total, ({failed})::BIGINT AS failed, {skip} AS skip FROM merged {where}"
    )


def _not_null(i: int, col: str) -> str:
    return _check(i, f"not_null.{col}", f"{col} must not be null", "count(*)", f"count(*) FILTER (WHERE {col} IS NULL)")


def _unique(i: int, col: str) -> str:
    return _check(i, f"unique.{col}", f"{col} must be unique across all records", "count(*)", f"count(*) - count(DISTINCT {col})")


def _among(i: int, name: str, description: str, col: str, bad: str) -> str:
    return _check(i, name, description, f"count({col})", f"count(*) FILTER (WHERE {col} IS NOT NULL AND ({bad}))")


def _types(i: int) -> str:
    return _among(i, "values_in_set.employment_type", "employment_type ∈ {Contractor, Full-Time, Part-Time}",
                  "employment_type", "employment_type NOT IN ('Full-Time', 'Part-Time', 'Contractor')")


def _currencies(i: int) -> str:
    return _among(i, "values_in_set.currency", "currency ∈ {EUR, GBP, USD}", "currency", "currency NOT IN ('USD', 'EUR', 'GBP')")


def _emails(i: int) -> str:
    return _among(i, "regex.email", "email format (RFC 5321)", "email",
                  "NOT regexp_full_match(email, '[a-zA-Z0-9._%+\\-]+@[a-zA-Z0-9.\\-]+\\.[a-zA-Z]{2,}')")


def _ids(i: int) -> str:
    return _among(i, "regex.employee_id", "employee_id format GT-XXXXXX or AC-XXXXXX", "employee_id",
                  "NOT regexp_full_match(employee_id, '(GT|AC)-[0-9]{6}')")


def _salaries(i: int) -> str:
    return _among(i, "numeric_range.salary_usd_annual", "salary_usd_annual between 15,000 and 10,000,000",
                  "salary_usd_annual", "salary_usd_annual NOT BETWEEN 15000 AND 10000000")


def _hires(i: int) -> str:
    return _among(i, "date_range.hire_date", "hire_date between 1970-01-01 and today", "hire_date",
                  f"hire_date NOT BETWEEN TIMESTAMP '1970-01-01' AND TIMESTAMP '{AS_OF}'")


def _managers(i: int) -> str:
    return _among(i, "ref_integrity.manager_id", "Every manager_id must exist as an employee_id", "manager_id",
                  "manager_id NOT IN (SELECT employee_id FROM merged)")


def _report(checks: list[str]) -> str:
    return f"""checks AS ({' UNION ALL '.join(checks)}),
report AS (
 SELECT position, "check", description, total, total - failed AS passed, failed,
  round(CASE WHEN total > 0 THEN (total - failed) / total ELSE 0.0 END::DOUBLE, 4) AS pass_rate,
  CASE WHEN skip THEN 'SKIP' WHEN total > 0 AND (total - failed) / total >= 0.95 THEN 'PASS' ELSE 'FAIL' END AS status
 FROM checks)"""


_FIFTEEN = [
    *(_not_null(i, col) for col, i in _CHECK_NAMES.items()),
    _unique(7, "email"), _unique(8, "employee_id"), _types(9), _currencies(10), _emails(11), _ids(12),
    _salaries(13), _hires(14), _managers(15),
]


def _quality(checks: list[str], result: str = "SELECT * FROM report") -> str:
    return f"WITH {_MERGED}, {_report(checks)} {result}"


_TENURE = f"""WITH {_MERGED},
years AS (
 SELECT floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(hire_date)) / 86400000000.0) / 365.25::DOUBLE AS x FROM merged WHERE hire_date IS NOT NULL),
kept AS (SELECT x FROM years WHERE x BETWEEN 0 AND 50),
span AS (SELECT min(x) AS low, max(x) AS high, (max(x) - min(x)) / 25 AS step FROM kept),
edges AS (
 SELECT i::INTEGER AS bin, low + i * step AS from_years, CASE WHEN i = 24 THEN high ELSE low + (i + 1) * step END AS to_years
 FROM span, range(25) AS r(i))
SELECT bin, from_years, to_years,
 (SELECT count(*) FROM kept WHERE x >= from_years AND (x < to_years OR (bin = 24 AND x <= to_years))) AS employees
FROM edges"""

_SALARY = f"""WITH {_MERGED},
ranked_salaries AS (
 SELECT employment_type, salary_usd_annual AS x,
  row_number() OVER (PARTITION BY employment_type ORDER BY salary_usd_annual) AS rn,
  count(*) OVER (PARTITION BY employment_type) AS n
 FROM merged WHERE employment_type IS NOT NULL AND salary_usd_annual IS NOT NULL)"""

ORACLES: dict[str, str] = {
    "scan_csv_hris": f"WITH {_BASE} SELECT ord, {', '.join(_HR)} FROM fx_hris",
    "flatten_json": f"WITH {_BASE} SELECT ord, {', '.join(f'{v} AS {k}' for k, v in _API.items())} FROM fx_api",
    "flatten_large_json": f"WITH {_BASE} SELECT {', '.join(f'{v} AS {k}' for k, v in _API.items())} FROM fx_api",
    "scan_payroll": f"WITH {_BASE} SELECT ord, {', '.join(_PAY)}, payroll_company_source, source_system FROM aligned WHERE p = 3",
    "scan_xml_benefits": f"WITH {_BASE} SELECT ord, {', '.join(_BEN)}, premium_employee, premium_employer FROM aligned WHERE p = 4",
    "align_schema": f"WITH {_BASE} SELECT * EXCLUDE (p) FROM aligned WHERE p = 3",
    "ingest_counts": f"""WITH {_BASE}
        SELECT 'globaltech_hris' AS source, count(*) AS raw, count(*) - count(reason) AS clean, count(reason) AS dropped FROM tagged_hris
        UNION ALL SELECT 'acquiredco_api', count(*), count(*), 0 FROM fx_api
        UNION ALL SELECT 'payroll', count(*), count(*) - count(reason), count(reason) FROM tagged_payroll
        UNION ALL SELECT 'benefits', count(*), count(*) - count(reason), count(reason) FROM tagged_benefits""",
    "quarantine_required": f"""WITH {_BASE}
        SELECT 'globaltech_hris' AS source, ord, reason FROM tagged_hris WHERE reason IS NOT NULL
        UNION ALL SELECT 'payroll', ord, reason FROM tagged_payroll WHERE reason IS NOT NULL
        UNION ALL SELECT 'benefits', ord, reason FROM tagged_benefits WHERE reason IS NOT NULL""",
    "quarantine_parse": f"""WITH {_BASE}
        SELECT ord, CASE ord % 5 WHEN 0 THEN '' ELSE employee_identifier END AS employee_id,
         CASE ord % 5 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN 'b' WHEN 3 THEN '' ELSE NULL END AS last_name,
         CASE ord % 5 WHEN 0 THEN 'Parse error: record is not an object' WHEN 1 THEN 'Parse error: name is not an object'
          WHEN 2 THEN 'Parse error: contact is not an object' WHEN 3 THEN 'Missing required fields: [''last_name'']' END AS reason
        FROM fx_api""",
    "quarantine_csv": f"""WITH {_BASE}
        SELECT CASE WHEN ord % 17 = 3 OR ord % 19 = 4 THEN 'Parse error: row does not fit the header' ELSE reason END AS reason,
         CASE WHEN ord % 17 = 3 THEN concat_ws(',', {', '.join(_HR)}, 'surplus') WHEN ord % 19 = 4 THEN concat_ws(',', employee_id, email)
          ELSE to_json(struct_pack({', '.join(f'{k} := {k}' for k in _HR)}))::VARCHAR END AS record
        FROM tagged_hris WHERE ord % 17 = 3 OR ord % 19 = 4 OR reason IS NOT NULL""",
    "quarantine_document": f"""WITH {_BASE},
        items AS (SELECT *, '{{"employee_identifier":"' || employee_identifier || '","name":{{"first":"' || name_first || '"}},"contact":{{"email":"' || contact_email || '"}}}}' AS item FROM fx_api)
        SELECT 'Parse error: no JSON record' AS reason, '{{"employees":[' || string_agg(item, ',' ORDER BY ord) || chr(10) AS record
        FROM items WHERE (ord // 10) % 3 = 1 GROUP BY ord // 10
        UNION ALL SELECT 'Missing required fields: [''last_name'']',
         to_json(struct_pack(employee_id := employee_identifier, first_name := name_first, last_name := '', email := contact_email, department := '',
          job_title := '', hire_date := '', country := '', employment_type := '', manager_id := ''))::VARCHAR
        FROM items WHERE (ord // 10) % 3 <> 1""",
    "quarantine_xml": f"""WITH {_BASE}
        SELECT 'Parse error: element is not closed' AS reason, '<enrollment><employee_id>9' || chr(10) AS record
        FROM fx_benefits WHERE (ord // 500) % 4 = 1 GROUP BY ord // 500
        UNION ALL SELECT reason, to_json(struct_pack({', '.join(f'{k} := trim({k})' for k in _BEN if k in ('employee_id', 'plan_type'))},
         coverage_level := '', enrollment_date := '', premium_employee := NULL::VARCHAR, premium_employer := NULL::VARCHAR))::VARCHAR
        FROM tagged_benefits WHERE reason IS NOT NULL""",
    "dead_letter": f"""WITH {_BASE}
        SELECT 'globaltech_hris' AS source, reason, to_json(struct_pack({', '.join(f'{k} := {k}' for k in _HR)}))::VARCHAR AS record FROM tagged_hris WHERE reason IS NOT NULL
        UNION ALL SELECT 'payroll', reason, to_json(struct_pack(employee_id := employee_id, source := source, base_salary := base_salary, currency := currency, pay_frequency := pay_frequency, bonus_target_pct := bonus_target_pct, effective_date := effective_date))::VARCHAR FROM tagged_payroll WHERE reason IS NOT NULL
        UNION ALL SELECT 'benefits', reason, to_json(struct_pack({', '.join(f'{k} := trim({k})' for k in _BEN)}, premium_employee := premium_employee, premium_employer := premium_employer))::VARCHAR FROM tagged_benefits WHERE reason IS NOT NULL""",
    "union_sources": f"WITH {_BASE} SELECT ord, employee_id, source_system, email, base_salary, plan_type, source, payroll_company_source FROM aligned",
    "nfc_names": f"WITH {_BASE} SELECT ord, trim(first_name) AS first_name, trim(last_name) AS last_name FROM fx_hris",
    "normalize_names": f"WITH {_BASE} SELECT ord, {_name('first_name')} AS first_name, {_name('last_name')} AS last_name FROM fx_hris",
    "namespace_ids": f"WITH {_CLEAN} SELECT ord, source_system, employee_id FROM cleaned",
    "namespace_manager": f"WITH {_CLEAN} SELECT ord, source_system, manager_id FROM cleaned",
    "normalize_emp_type": f"WITH {_CLEAN} SELECT ord, source_system, employment_type FROM cleaned",
    "map_departments": f"WITH {_CLEAN} SELECT ord, source_system, department FROM cleaned",
    "unmapped_values": f"WITH {_BASE} SELECT trim(department) AS department, count(*) AS records FROM aligned WHERE trim(department) NOT IN ('', 'nan') AND {_KNOWN_DEPARTMENT} IS NULL GROUP BY 1",
    "parse_dates": f"WITH {_CLEAN} SELECT ord, source_system, hire_date, effective_date, enrollment_date FROM cleaned",
    "flag_dates": f"WITH {_CLEAN} SELECT ord, source_system, hire_date_flag FROM cleaned",
    "parse_salary": f"WITH {_CLEAN} SELECT ord, source_system, base_salary FROM cleaned",
    "annualize_salary": f"WITH {_CLEAN} SELECT ord, source_system, salary_usd_annual FROM cleaned",
    "nullify_sentinels": f"WITH {_BASE} SELECT ord, " + ", ".join(f"CASE WHEN {x} NOT IN {_in(c.NULL_SENTINELS)} THEN {x} END AS {x}" for x in ("employee_id", "department", "country", "manager_id")) + " FROM fx_hris",
    "title_case": f"WITH {_BASE}, forms AS (SELECT ord, trim(first_name) || ' ' || last_name AS name, email FROM fx_hris) SELECT ord, {_title('name')} AS name, {_title('email')} AS email FROM forms",
    "company_origin": f"WITH {_CLEAN} SELECT ord, source_system, CASE WHEN employee_id LIKE 'GT%' THEN 'GlobalTech' ELSE 'AcquiredCo' END AS company_origin FROM cleaned",
    "source_priority": f"WITH {_EXACT} SELECT employee_id, source_systems, priority FROM exact",
    "clean_all": f"WITH {_CLEAN} SELECT ord, {', '.join(c.STANDARD_COLUMNS)}, source, hire_date_flag, salary_usd_annual FROM cleaned",
    "dedup_exact": f"WITH {_EXACT} SELECT {', '.join(_GOLDEN)} FROM exact",
    "dedup_provenance": f"WITH {_EXACT} SELECT employee_id, source_systems, dedup_method FROM exact",
    "dup_groups": f"WITH {_MERGED} SELECT email, employee_id, group_size FROM ranked WHERE group_size > 1",
    "dedup_email": f"WITH {_MERGED} SELECT {', '.join(_GOLDEN)} FROM merged",
    "dedup_email_coalesced": f"""WITH {_EXACT},
        addressed AS (SELECT email, first(employee_id ORDER BY priority, employee_id) AS winner_id, array_to_string(list_sort(list(DISTINCT source_systems)), ',') AS merged
         FROM exact WHERE trim(email) <> '' GROUP BY email HAVING count(DISTINCT split_part(employee_id, '-', 1)) > 1),
        placed AS (SELECT e.*, coalesce(a.winner_id, e.employee_id) AS survivor, a.merged FROM exact e LEFT JOIN addressed a ON a.email = e.email),
        filled AS (SELECT survivor AS employee_id, {', '.join(f'first({x} ORDER BY priority, employee_id) FILTER (WHERE {x} IS NOT NULL) AS {x}' for x in (*_TEXTS, *_TYPED))},
          coalesce(any_value(merged), any_value(source_systems)) AS source_systems,
          CASE WHEN any_value(merged) IS NULL THEN any_value(dedup_method) ELSE 'email_match' END AS dedup_method
         FROM placed GROUP BY survivor)
        SELECT f.* REPLACE (coalesce(l.survivor, f.manager_id) AS manager_id)
        FROM filled f LEFT JOIN placed l ON l.employee_id = f.manager_id AND l.survivor <> l.employee_id""",
    "remap_fk": f"WITH {_MERGED} SELECT employee_id, coalesce(l.winner_id, manager_id) AS manager_id, manager_id AS old_manager_id FROM exact LEFT JOIN losers l ON l.loser_id = manager_id",
    "interval_self_join": f"""WITH {_MERGED}
        SELECT hire_date, count(*) AS records,
         (SELECT count(*) FROM merged b WHERE b.hire_date BETWEEN a.hire_date - INTERVAL 30 DAY AND a.hire_date + INTERVAL 30 DAY) - 1 AS partners
        FROM merged a WHERE hire_date IS NOT NULL GROUP BY hire_date""",
    "token_sort_similarity": f"""WITH {_BASE},
        forms AS (SELECT ord, {_tokens("lower(first_name || ' ' || last_name)")} AS a, {_tokens("lower(last_name || ', ' || first_name)")} AS b FROM fx_hris)
        SELECT ord, {_score('a', 'b')} AS score FROM forms""",
    "fuzzy_pairs": f"""WITH {_PAIRS} SELECT id1 AS record_1_id, id2 AS record_2_id, {_title('n1')} AS record_1_name, {_title('n2')} AS record_2_name,
        score AS similarity_score, days::INTEGER AS hire_date_diff_days, s1 AS record_1_source, s2 AS record_2_source, 'REVIEW' AS recommended_action FROM pairs""",
    "fuzzy_links": f"""WITH {_CELLS}
        SELECT bucket_1, name_1, bucket_2, name_2, any_value(score) AS similarity_score, any_value(a.n) AS records_1, any_value(b.n) AS records_2, count(*) AS n_pairs
        FROM linked JOIN cells a ON a.bucket = bucket_1 AND a.key = name_1 JOIN cells b ON b.bucket = bucket_2 AND b.key = name_2
        GROUP BY bucket_1, name_1, bucket_2, name_2""",
    "fuzzy_records": f"""WITH {_CELLS} SELECT bucket, key AS name, employee_id, hire_date, source_systems FROM placed p
        WHERE EXISTS (SELECT 1 FROM linked WHERE (bucket_1 = p.bucket AND name_1 = p.key) OR (bucket_2 = p.bucket AND name_2 = p.key))""",
    "flag_probable": f"WITH {_FLAGGED} SELECT employee_id, probable_match_flag FROM golden",
    "ghosts": f"""WITH {_MERGED} SELECT employee_id AS payroll_employee_id, trim(coalesce(first_name, '') || ' ' || coalesce(last_name, '')) AS name,
        salary_usd_annual, 'Payroll record with no matching HRIS entry' AS ghost_flag_reason
        FROM merged m WHERE EXISTS (SELECT 1 FROM cleaned x WHERE x.employee_id = m.employee_id AND x.source_system = 'payroll')
         AND NOT EXISTS (SELECT 1 FROM cleaned x WHERE x.employee_id = m.employee_id AND x.source_system IN ('globaltech_hris', 'acquiredco_api'))""",
    "golden": f"WITH {_FLAGGED} SELECT {', '.join(_GOLDEN)}, probable_match_flag FROM golden",
    "dq_not_null": _quality([*(_not_null(i, col) for col, i in _CHECK_NAMES.items()),
                             _check(7, "not_null.no_such_column", "no_such_column must not be null", "count(*)", "count(*)")]),
    "dq_unique": _quality([_unique(1, "email"), _unique(2, "employee_id"),
                           _check(3, "unique.no_such_column", "no_such_column must be unique", "0 * count(*)", "0 * count(*)", skip=True)]),
    "dq_in_set": _quality([_types(1), _currencies(2)]),
    "dq_regex": _quality([_emails(1), _ids(2)]),
    "dq_numeric_range": _quality([_salaries(1)]),
    "dq_date_range": _quality([_hires(1), _among(2, "date_range.effective_date", "effective_date between 2012-01-01 and 2018-12-31", "effective_date",
                                                 "effective_date NOT BETWEEN TIMESTAMP '2012-01-01' AND TIMESTAMP '2018-12-31'")]),
    "dq_ref_integrity": _quality([_managers(1)]),
    "dq_report": _quality(_FIFTEEN),
    "dq_gate": _quality(_FIFTEEN, "SELECT count(*) FILTER (WHERE status = 'FAIL') AS failures, 2 AS max_failures, count(*) FILTER (WHERE status = 'FAIL') <= 2 AS passed FROM report"),
    "dq_summary": _quality(_FIFTEEN, 'SELECT position, "check", passed, failed FROM report'),
    "headcount_department": f"WITH {_MERGED} SELECT department, count(*) AS employees FROM merged WHERE department IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
    "headcount_country": f"WITH {_MERGED} SELECT country, count(*) AS employees FROM merged WHERE country IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
    "salary_distribution": f"""{_SALARY} SELECT employment_type, count(*) AS employees, min(x) AS min_salary,
        (max(x) FILTER (WHERE rn = (n + 1) // 2) + max(x) FILTER (WHERE rn = n // 2 + 1)) / 2 AS median_salary, max(x) AS max_salary
        FROM ranked_salaries GROUP BY employment_type""",
    "salary_density": f"""{_SALARY},
        spans AS (SELECT employment_type, min(x) AS low, (max(x) - min(x)) / 100 AS step FROM ranked_salaries GROUP BY 1),
        edges AS (SELECT employment_type, low, step, i::INTEGER AS bin, low + i * step AS a, low + (i + 1) * step AS b FROM spans, range(100) AS r(i))
        SELECT e.employment_type, bin, a AS from_salary, count(*) AS employees
        FROM ranked_salaries s JOIN edges e ON e.employment_type = s.employment_type
         AND ((step = 0 AND bin = 0) OR (step > 0 AND x >= a AND (x < b OR bin = 99)))
        GROUP BY ALL""",
    "tenure_histogram": _TENURE,
    "enrollment_rate": f"""WITH {_MERGED} SELECT department, count(plan_type) AS enrolled, count(*) AS total,
        round_even(count(plan_type)::DOUBLE / count(*) * 100 * 10, 0) / 10 AS rate
        FROM merged WHERE department IS NOT NULL GROUP BY 1 HAVING count(plan_type) > 0 ORDER BY rate DESC, department LIMIT 15""",
}
