import random
import sys
import unicodedata
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rillweave.config import DEFAULT, NULL_SENTINELS
from rillweave.functions import money, text
from rillweave.functions.similarity import indel_distance, lcs_length, lcs_lengths, token_sort, token_sort_ratio
from rillweave.functions.taxonomy import source_priority
from rillweave.plans import clean
from rillweave.plans.clean import with_layers

PEOPLE = "i int, employee_id string, manager_id string, source_system string, payroll_company_source string"


def test_names(evaluate):
    cases = {
        "alice": "Alice", "BOB": "Bob", "smith": "Smith", "JONES": "Jones", "o'brien": "O'Brien",
        "d'angelo": "D'Angelo", "van-der-berg": "Van-Der-Berg", "smith-jones": "Smith-Jones",
        "mary ann": "Mary ann", "  Carol ": "Carol", "": "", " \t ": "", "zoë": "Zoë", None: None,
        "FULL-TIME": "Full-Time", "(abc": "(abc", " li ": "Li",
    }
    assert evaluate(text.clean_name("x"), list(cases)) == list(cases.values())


def test_title_case_is_pythons(evaluate):
    values = ["FULL-TIME", "o'brien", "3rd floor", "zoë müller", "a_b c", "x1y2", "中a b", "part time", "", "ẞ ß"]
    assert evaluate(text.title_case("x"), values) == [v.title() for v in values]


def test_nfc_safe_ranges_need_no_normalisation():
    for low, high in text.NFC_SAFE_RANGES:
        for code in range(low, high + 1):
            c = chr(code)
            assert unicodedata.is_normalized("NFC", c) and unicodedata.combining(c) == 0
    # No safe character is the second part of a composition.
    safe = [range(low, high + 1) for low, high in text.NFC_SAFE_RANGES]
    for code in range(sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            assert not any(int(parts[1], 16) in r for r in safe)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aé ́ \t'-Bΐ가z", max_size=8), min_size=1, max_size=60))
def test_nfc_and_strip_are_pythons(evaluate, values):
    expected = [unicodedata.normalize("NFC", v).strip() for v in values]
    assert evaluate(text.strip(text.nfc("x")), values) == expected


def test_nullify(evaluate):
    assert evaluate(text.nullify("x", NULL_SENTINELS), ["", "nan", "None", "<NA>", "NaN", None, " "]) == [
        None, None, None, None, "NaN", None, " ",
    ]


def _ids(spark, rows):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], PEOPLE)
    done = clean.namespace_employee_ids(frame).orderBy("i").collect()
    return [(r.employee_id, r.manager_id) for r in done]


def test_namespaces(spark):
    cases = [
        (("42", None, "globaltech_hris", None), ("GT-000042", None)),
        (("1042", " ", "acquiredco_api", None), ("AC-001042", None)),
        (("ACQ_00001", "ACQ_02436", "acquiredco_api", None), ("AC-000001", "AC-002436")),
        (("acq_7", "nan", "globaltech_hris", None), ("AC-000007", None)),
        (("GT-001042", "AC-000001", "acquiredco_api", None), ("GT-001042", "AC-000001")),
        (("5", "None", "payroll", "AcquiredCo Inc"), ("AC-000005", None)),
        (("5", "<NA>", "payroll", "GlobalTech"), ("GT-000005", None)),
        ((" 7 ", "8", "benefits", None), ("GT-000007", "GT-000008")),
        (("1234567", "-5", "globaltech_hris", None), ("GT-1234567", "GT--00005")),
        (("+5", "000", "globaltech_hris", None), ("GT-000005", "GT-000000")),
        (("ACQ_", "ACQ_x1", "payroll", None), ("AC-000000", "AC-x1")),
        (("abc", "1_0", "globaltech_hris", None), ("abc", "1_0")),
        (("9" * 30, "ACQ_0", "globaltech_hris", None), ("GT-" + "9" * 30, "AC-000000")),
        ((None, None, "payroll", None), (None, None)),
    ]
    assert _ids(spark, [c for c, _ in cases]) == [e for _, e in cases]
    again = [(a, b, c[2], c[3]) for c, (a, b) in cases if a and a[:3] in ("GT-", "AC-") and len(a) == 9]
    assert [a for a, _ in _ids(spark, again)] == [r[0] for r in again]


def _layers(spark, column, values, *layers, result=None):
    frame = spark.createDataFrame(list(enumerate(values)), f"i int, {column} string")
    return [r[result or column] for r in with_layers(frame, *layers).orderBy("i").collect()]


def test_employment_types(spark):
    cases = {
        "FT": "Full-Time", "PT": "Part-Time", "CONTRACTOR": "Contractor", "Full-Time": "Full-Time",
        "Part Time": "Part-Time", "FULL-TIME": "Full-Time", "part time": "Part-Time", "pt": "Pt", "intern 2ND": "Intern 2Nd",
        " CT ": "Contractor", " ": None, None: None,
    }
    assert _layers(spark, "employment_type", list(cases), clean.employment_type_layers()) == list(cases.values())


def test_departments(spark):
    cases = {
        "ENG-01": "Engineering", "MKT-03": "Marketing", "Engineering": "Engineering", "Finance": "Finance",
        "Information Technology": "IT", "HR": "Human Resources", "hr": "hr", "engineering": "Engineering",
        "ZZZ-99": "ZZZ-99", " R&D ": "Research & Development", "": None, "nan": None, None: None, "it": "IT",
    }
    assert _layers(spark, "department", list(cases), clean.department_layers()) == list(cases.values())
    frame = spark.createDataFrame([(k,) for k in cases], "department string")
    assert sorted(r.department for r in clean.unmapped_departments(frame).collect()) == ["ZZZ-99", "hr"]


def test_dates(spark):
    cases = {
        "2022-01-15": datetime(2022, 1, 15), "2022-1-5": datetime(2022, 1, 5),
        "2021-06-09T00:00:00": datetime(2021, 6, 9), "2021-06-09T10:30:05": datetime(2021, 6, 9, 10, 30, 5),
        "03/04/2020": datetime(2020, 3, 4), "25/12/2020": datetime(2020, 12, 25), "12-25-2015": datetime(2015, 12, 25),
        "05-MAR-2020": datetime(2020, 3, 5), "5-jul-2020": datetime(2020, 7, 5), "5-Foo-2020": None,
        "02/30/2020": None, "31/04/2020": None, "2021-02-29": None, "garbage": None, " ": None, None: None,
        "2021-06-09 10:00:00": datetime(2021, 6, 9, 10), "2021-06-09T10:00:00.25": datetime(2021, 6, 9, 10, 0, 0, 250000),
        "20220115": datetime(2022, 1, 15), "25-12-2020": datetime(2020, 12, 25), "January 5, 2020": datetime(2020, 1, 5),
        "5 Sept 2020": datetime(2020, 9, 5), "2022": datetime(2022, 1, 1), "2020/1/5": datetime(2020, 1, 5),
        "2021-06-09T10:00:00Z": None, "2999-01-01": None, "1600-01-01": None, " 2022-01-15\t": datetime(2022, 1, 15),
    }
    assert _layers(spark, "hire_date", list(cases), clean.date_layers(("hire_date",))) == list(cases.values())


def test_date_flags(spark):
    values = ["1960-01-01", "2022-01-01", "2026-12-03", "2026-12-03T10:00:00", None, "1970-01-01"]
    frame = spark.createDataFrame([(i, v, None, None) for i, v in enumerate(values)], "i int, hire_date string, effective_date string, enrollment_date string")
    flags = [r.hire_date_flag for r in clean.normalize_dates(frame, "2026-12-03").orderBy("i").collect()]
    assert flags == ["hire_date before 1970-01-01", None, None, "hire_date after 2026-12-03", None, None]


@pytest.mark.parametrize("zone", ["America/Sao_Paulo", "UTC"])
def test_dates_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # Midnight does not exist there on this day.
        assert _layers(spark, "hire_date", ["04-Nov-2018"], clean.date_layers(("hire_date",))) == [datetime(2018, 11, 4)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def _salaries(spark, rows):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, base_salary string, currency string, pay_frequency string")
    return [(r.base_salary, r.salary_usd_annual) for r in clean.normalize_salaries(frame).orderBy("i").collect()]


def test_salaries(spark):
    cases = [
        (("85000", "USD", "Annual"), (85000.0, 85000.0)),
        (("5000", "EUR", "Monthly"), (5000.0, 65400.0)),
        (("$85,000", "USD", "Annual"), (85000.0, 85000.0)),
        ((" € 85,000.50 ", "eur ", "Bi-Weekly"), (85000.5, round(85000.5 * 1.09 * 26, 2))),
        (("100", "CHF", "MONTHLY"), (100.0, 100.0)), (("100", None, None), (100.0, 100.0)),
        ((None, "USD", "Annual"), (None, None)), (("-5", "USD", "Annual"), (None, None)), (("0", "USD", "Annual"), (None, None)),
        (("(500)", "USD", "Annual"), (None, None)), (("nan", "USD", "Annual"), (None, None)), (("100d", "USD", "Annual"), (None, None)),
        (("inf", "USD", "Annual"), (float("inf"), float("inf"))), (("1e3", "GBP", "Weekly"), (1000.0, 66040.0)), ((" ", "USD", "Annual"), (None, None)),
    ]
    assert _salaries(spark, [c for c, _ in cases]) == [e for _, e in cases]


def test_cents_round_like_python(evaluate):
    rng = random.Random(5)
    values = [107950.635, 92650.545, 2675.675, 1e13 + 0.125, 128.125, 128.375]
    values += [round(rng.uniform(64, 1e7), 3) for _ in range(3000)] + [rng.randrange(70000, 10**8) / 1000 for _ in range(2000)]
    assert evaluate(money.round_cents("x"), values, "i int, x double") == [round(v, 2) for v in values]


def test_source_priority(evaluate):
    expression = source_priority("x", DEFAULT.source_priority, 99)
    values = ["payroll", "benefits, acquiredco_api", "new", "new,benefits", "payroll,globaltech_hris"]
    assert evaluate(expression, values) == [3, 2, 99, 4, 1]


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for ca in a:
        new = [0]
        for j, cb in enumerate(b, 1):
            new.append(row[j - 1] + 1 if ca == cb else max(new[-1], row[j]))
        row = new
    return row[-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("abcé \U0001F600", max_size=70), st.text("abcé \U0001F600", max_size=140)), min_size=1, max_size=12))
def test_lcs(pairs):
    xs, ys = zip(*pairs, strict=True)
    assert lcs_lengths(xs, ys).tolist() == lcs_lengths(ys, xs).tolist() == [_lcs(a, b) for a, b in pairs]


def test_lcs_of_long_texts():
    rng = random.Random(3)
    text = lambda k: "".join(rng.choices("ab\U00010348", k=k))
    pairs = [(text(a), text(b)) for a in (0, 1, 63, 64, 65, 128, 200, 321) for b in (0, 64, 129, 400)]
    assert lcs_lengths(*zip(*pairs, strict=True)).tolist() == [_lcs(a, b) for a, b in pairs]


def test_lcs_column(spark):
    pairs = [("abc\U0001F600", "b\U0001F600"), ("", "a"), (None, "a"), ("a", None)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    rows = frame.select("i", lcs_length("a", "b").alias("l"), indel_distance("a", "b").alias("d")).orderBy("i").collect()
    assert [(r.l, r.d) for r in rows] == [(2, 2), (0, 1), (None, None), (None, None)]


def test_token_sort_ratio(spark):
    frame = spark.createDataFrame([(0, "ann  lee", "lee ann"), (1, "", ""), (2, "a", ""), (3, "abcd", "abce")], "i int, a string, b string")
    scores = [r.s for r in frame.select("i", token_sort_ratio("a", "b").alias("s")).orderBy("i").collect()]
    assert scores == [100.0, 100.0, 0.0, 75.0]
    assert frame.selectExpr(f"{token_sort('a')} AS t").first().t == "ann lee"
