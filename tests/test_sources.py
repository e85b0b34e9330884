import collections
import gzip
import json
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rillweave.config import API, STANDARD_COLUMNS, IntegrationConfig
from rillweave.sources import extracts as ex
from rillweave.sources import readers, sinks

HRIS_COLUMNS = (
    "employee_id", "first_name", "last_name", "email", "department", "job_title",
    "hire_date", "country", "employment_type", "manager_id",
)


@pytest.fixture
def csv_file(tmp_path):
    path = tmp_path / "hris.csv"
    path.write_text(
        "employee_id,first_name,last_name,email,department,job_title,hire_date,country,employment_type,manager_id\n"
        '1,alice,"sm""ith",a@x.example,Eng,"Data\nEngineer",2020-01-01,US,FT,\n'
        "2,bob,,b@x.example,Eng,Dev,2020-01-01,US,FT,1\n"
        '"",carl, ,,Eng,Dev,2020-01-01,US,FT,1\n',
        encoding="utf-8",
    )
    return str(path)


def test_csv(spark, csv_file):
    extract = ex.hris_extract(readers.read_csv(spark, csv_file, HRIS_COLUMNS, multi_line=True))
    good = extract.accepted()
    assert good.columns[: len(STANDARD_COLUMNS)] == list(STANDARD_COLUMNS)
    row = good.collect()
    assert [(r.employee_id, r.last_name, r.job_title, r.manager_id, r.source_system) for r in row] == [
        ("1", 'sm"ith', "Data\nEngineer", "", "globaltech_hris")
    ]
    bad = {r.reason: json.loads(r.record) for r in extract.rejected().collect()}
    assert set(bad) == {"Missing required fields: ['last_name']", "Missing required fields: ['employee_id', 'last_name', 'email']"}
    assert bad["Missing required fields: ['last_name']"]["first_name"] == "bob"
    assert extract.counts().first().asDict() == {"source": "globaltech_hris", "raw": 3, "clean": 1, "dropped": 2}


def test_csv_without_line_breaks_stays_splittable_and_keeps_its_order(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("employee_id,base_salary\n" + "".join(f"{i},{i}00\n" for i in range(500)))
    rows = readers.read_csv(spark, str(path), readers.PAYROLL_COLUMNS).orderBy("_ord").collect()
    assert [r.employee_id for r in rows] == [str(i) for i in range(500)]


def test_split_files_keep_their_order(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("employee_id,base_salary\n" + "".join(f"{i},{'9' * 50}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        frame = readers.read_csv(spark, str(path), readers.PAYROLL_COLUMNS, multi_line=False)
        assert frame.rdd.getNumPartitions() > 3
        assert [r.employee_id for r in frame.orderBy("_ord").collect()] == [str(i) for i in range(3000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


RECORDS = [
    {"employee_identifier": "ACQ_1", "name": {"first": "a", "last": "b"}, "contact": {"email": "e"},
     "assignment": {"department": "Tech"}, "employment": {"type": "FT"}, "manager_employee_id": "ACQ_2"},
    7,
    {"employee_identifier": "ACQ_3", "name": None, "contact": {"email": "e"}},
    {"employee_identifier": "ACQ_4", "name": {"first": "a", "last": None}, "contact": {"email": "e"}},
    {"employee_identifier": "ACQ_5", "contact": {"email": "e"}},
    {"employee_identifier": 6, "name": {"first": "a", "last": "b"}, "contact": {"email": "e"}, "employment": "FT"},
    {"employee_identifier": 8, "name": {"first": "a", "last": "b"}, "contact": {"email": "e"}},
]


@pytest.mark.parametrize("layout", ["document", "lines"])
def test_nested_json(spark, tmp_path, layout):
    path = tmp_path / "api.json"
    if layout == "document":
        path.write_text(json.dumps({"total_records": len(RECORDS), "employees": RECORDS}, indent=1))
    else:
        path.write_text("\n".join(json.dumps(r) for r in RECORDS))
    extract = ex.api_extract(readers.read_json_records(spark, str(path), layout))
    good = {r.employee_id: r for r in extract.accepted().collect()}
    assert set(good) == {"ACQ_1", "ACQ_4", "8"}
    assert good["ACQ_1"].department == "Tech" and good["ACQ_1"].job_title == "" and good["ACQ_1"].manager_id == "ACQ_2"
    assert good["ACQ_4"].last_name is None
    bad = {(r.reason, r.record if r.reason.startswith("Parse") else "") for r in extract.rejected().collect()}
    assert {r for r, _ in bad} == {
        "Parse error: record is not an object", "Parse error: name is not an object",
        "Parse error: employment is not an object", "Missing required fields: ['first_name', 'last_name']",
    }
    assert ("Parse error: record is not an object", "7") in bad
    strict = ex.api_extract(readers.read_json_records(spark, str(path), layout), IntegrationConfig(null_is_missing=True))
    assert "ACQ_4" not in {r.employee_id for r in strict.accepted().collect()}


def accounted(extract):
    """Letters by reason, after checking that every raw row is either clean or dropped."""
    counts = extract.counts().first()
    letters = [(r.reason, r.record) for r in extract.rejected().collect()]
    assert counts.raw == counts.clean + counts.dropped
    assert (counts.clean, counts.dropped) == (extract.accepted().count(), len(letters))
    return letters


def test_unreadable_json_documents_are_letters(spark, tmp_path):
    for name, text in {"a": '{"employees": []}', "b": "{not json", "c": '{"people": [1]}', "d": json.dumps({"employees": RECORDS[:1]})}.items():
        (tmp_path / f"{name}.json").write_text(text)
    extract = ex.api_extract(readers.read_json_records(spark, str(tmp_path)))
    reason = "Parse error: no JSON record"
    assert sorted(accounted(extract)) == [(reason, '{"people": [1]}'), (reason, "{not json")]
    assert [r.employee_id for r in extract.accepted().collect()] == ["ACQ_1"]


def _json_records(rng, n):
    texts = ["a } b", '"},{"', "\\", 'x\\"{[', "\n}", "", "é{"]
    return [{"id": i, "t": rng.choice(texts) * rng.randrange(3), "n": {"a": [{"b": rng.choice([1, None, "]"])}] * rng.randrange(3)}} for i in range(n)]


def test_text_after_a_json_value_is_not_lost(spark, tmp_path):
    for name, text in {"a": '{"employees":[{"a":1}]}{"employees":[{"a":2}]}', "b": '{"employees":[{"a":1}]}}', "c": '{"employees":[{"a":1}]}\n'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    for layout in ("document", "large_document"):
        rows = readers.read_json_records(spark, str(tmp_path), layout).selectExpr("to_json(doc) AS doc", "_raw", "_ord.file").collect()
        assert {r.file[-6]: r.doc for r in rows} == {"a": None, "b": None, "c": '{"a":1}'} and len(rows) == 3
    (tmp_path / "l.jsonl").write_text('{"a":1}{"a":2}\n{"a":3} \n')
    rows = readers.read_json_records(spark, str(tmp_path / "l.jsonl"), "lines").selectExpr("to_json(doc) AS doc", "_raw").collect()
    assert [tuple(r) for r in rows] == [(None, '{"a":1}{"a":2}'), ('{"a":3}', None)]


def test_large_json_documents_equal_whole_ones(spark, tmp_path):
    rng = random.Random(2)
    for k, indent in enumerate([None, 1, None, 2]):
        document = {"meta": [{"z": 1}, {"z": 2}], "total": {"q": {"r": 1}}, "employees": _json_records(rng, 100), "more": [{"y": 1}, {"y": 5}]}
        (tmp_path / f"d{k}.json").write_text(json.dumps(document, indent=indent, ensure_ascii=k > 1) + "\n" * (k % 2))
    (tmp_path / "e.json").write_text('{"employees": []}')
    (tmp_path / "f.json").write_text('{"employees":[1,{"a":2}, null, {"b":3},{"c":4},[{"x":1},{"x":2}],5,{"d":6},{"e":7}]}')

    def read(layout):
        rows = readers.read_json_records(spark, str(tmp_path), layout).selectExpr("_ord", "to_json(doc) AS doc", "_raw")
        return [(r._ord.file, r.doc, r._raw) for r in rows.orderBy("_ord").collect()]

    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        assert spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions() > 6
        split = read("large_document")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert split == read("document") and len(split) == 409


def test_faults_in_large_json_documents_are_letters(spark, tmp_path):
    documents = {
        "bad record": '{"employees":[{"a":1},{"a":oops},{"a":3}]}', "no array": '{"people":[{"a":1},{"a":2}]}', "no json": "{not json",
        "cut in a record": '{"employees":[{"a":1},{"a":2},{"a":', "cut after a record": '{"employees":[{"a":1},{"a":2}',
        "cut at the end": '{"employees":[{"a":1},{"a":2},{"a":3}]', "surplus": '{"employees":[{"a":1},{"a":2}]}}', "blank": " \n", "empty": "",
        "good": '{"employees":[{"a":1},{"a":2}]}\n',
    }
    for name, text in documents.items():
        (tmp_path / f"{name.replace(' ', '_')}.json").write_text(text)
    rows = readers.read_json_records(spark, str(tmp_path), "large_document").selectExpr("_ord.file", "to_json(doc) AS doc", "_raw").collect()
    found = {}
    for r in rows:
        found.setdefault(r.file.rsplit("/", 1)[1].removesuffix(".json").replace("_", " "), []).append(r.doc or r._raw.rsplit("/", 1)[-1])
    good = ['{"a":1}', '{"a":2}']
    expected = {name: [f"{name.replace(' ', '_')}.json"] for name in documents}
    expected |= {"good": good, "bad record": ['{"a":1}', '{"a":3}', '{"a":oops}']}
    assert {k: sorted(v) for k, v in found.items()} == expected


def test_unreadable_json_line_is_a_letter(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": \n' + json.dumps(RECORDS[0]) + "\n\n")
    extract = ex.api_extract(readers.read_json_records(spark, str(tmp_path), "lines"))
    assert accounted(extract) == [("Parse error: no JSON record", '{"x": ')]


def test_csv_rows_that_do_not_fit_are_letters(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        'employee_id,source,base_salary\n1,x,10\n2,y\n3,z,30,more\n4,5" pipe,40\n5,"two\nlines",50\n6,w,60\n'
    )
    extract = ex.payroll_extract(readers.read_csv(spark, str(tmp_path), readers.PAYROLL_COLUMNS))
    letters = accounted(extract)
    assert {r for r, _ in letters} == {"Parse error: row does not fit the header"}
    assert sorted(t for _, t in letters) == ["2,y", "3,z,30,more", '5,"two', 'lines",50']
    assert sorted((r.employee_id, r.source) for r in extract.accepted().collect()) == [("1", "x"), ("4", '5" pipe'), ("6", "w")]


def test_csv_headers_count_per_file(spark, tmp_path):
    for name, text in {
        "a": "employee_id,source,base_salary\n1,x,10\n", "b": "\ufeffbase_salary,employee_id,extra\n20,2,e\nbase_salary,employee_id\n", "c": "", "d": "\n \n",
        "e": "source\n\nemployee_id\n", "f g": 'base_salary,"employee_id"\n30,3\n',
    }.items():
        (tmp_path / f"{name}.csv").write_text(text)
    extract = ex.payroll_extract(readers.read_csv(spark, str(tmp_path), readers.PAYROLL_COLUMNS))
    letters = accounted(extract)
    assert sorted((r, t.rsplit("/")[-1]) for r, t in letters) == [
        ("Parse error: file is empty", "c.csv"), ("Parse error: file is empty", "d.csv"),
        ("Parse error: row does not fit the header", "base_salary,employee_id"),
    ]
    rows = extract.accepted().orderBy("_ord").collect()
    assert [(r.employee_id, r.source, r.base_salary, r.extra) for r in rows] == [
        ("1", "x", "10", None), ("2", None, "20", "e"), (None, "employee_id", None, None), ("3", None, "30", None),
    ]


def test_csv_open_quotes_are_letters(spark, tmp_path):
    good = ["1,a,b", '2,"a, ""b""",c', '3,a"b,c', '4,"",""', '5,"a"x,b"']
    bad = ['6,a,"x', '7,b,"""', '8,c,"x""', '9,d,"a,b']
    (tmp_path / "p.csv").write_text("\n".join(["employee_id,source,base_salary", *good, *bad, '10,"a,b']))
    extract = ex.payroll_extract(readers.read_csv(spark, str(tmp_path), readers.PAYROLL_COLUMNS))
    assert sorted(accounted(extract)) == sorted(
        [("Parse error: quote is not closed", t) for t in bad] + [("Parse error: row does not fit the header", '10,"a,b')]
        + [("Missing required fields: ['base_salary']", json.dumps({"employee_id": "4", "source": "", "base_salary": ""}, separators=(",", ":")))]
        * (extract.accepted().where("employee_id = '4'").count() == 0)
    )
    assert {"1", "2", "3", "5"} <= {r.employee_id for r in extract.accepted().collect()}


def test_empty_json_document_is_a_letter(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    (tmp_path / "b.json").write_text(json.dumps({"employees": RECORDS[:1]}))
    extract = ex.api_extract(readers.read_json_records(spark, str(tmp_path)))
    [(reason, text)] = accounted(extract)
    assert reason == "Parse error: no JSON record" and text.endswith("/a.json")
    assert [r.employee_id for r in extract.accepted().collect()] == ["ACQ_1"]


def _enrolled(*ids):
    return "".join(f"<enrollment><employee_id>{i}</employee_id></enrollment>" for i in ids)


def test_malformed_xml_elements_are_letters_of_their_own(spark, tmp_path):
    files = {
        "a": f"<?xml version='1.0'?><!-- <x> --><r>{_enrolled(1)}<enrollment><employee_id>2</employee_id><plan_type>x{_enrolled(3)}</r>\n",
        "b": f"<r>{_enrolled(4)}<enrollment><a></enrollment>{_enrolled(5)}</r><!-- end -->",
        "c": f"<r>{_enrolled(6)}<enrollment n='1'><employee_id>7</employee_id></enrollment ><enrollment><employee_id>8</employee_id></enrollment></r>",
        "d": f"<r>{_enrolled(9)}",  # cut between elements
        "e": f"<r>{_enrolled(10)}<enrollment><employee_id>11</employee_id>",  # cut within one
        "f": f"<r>{_enrolled(12)}</",
        "g": "", "h": "<r/>", "i": "<r></r>", "j": _enrolled(13), "k": f"<r><enrollment/>{_enrolled(14)}<enrollmentx>1</enrollmentx></r>",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.xml").write_text(text)
    extract = ex.benefits_extract(readers.read_xml(spark, str(tmp_path)))
    letters = sorted((r.removeprefix("Parse error: "), t.rsplit("/")[-1] if t.startswith("file:") else t) for r, t in accounted(extract))
    nothing = json.dumps({c: "" if c in readers.BENEFIT_COLUMNS[:4] else None for c in readers.BENEFIT_COLUMNS}, separators=(",", ":"))
    assert letters == sorted([
        ("Missing employee_id", nothing), ("element is not closed", "<enrollment><employee_id>2</employee_id><plan_type>x"),
        ("element is not closed", "<enrollment><employee_id>11</employee_id>"), ("element is not well-formed", "<enrollment><a></enrollment>"),
        ("file is cut off", "d.xml"), ("file is cut off", "f.xml"), ("file is empty", "g.xml"),
    ])
    assert sorted(int(r.employee_id) for r in extract.accepted().collect()) == [1, 3, 4, 5, 6, 7, 8, 9, 10, 12, 13, 14]


def test_small_xml_files_are_judged_by_tasks(spark, tmp_path, monkeypatch):
    """The driver looks at large and at compressed files alone, however many there are of others."""
    looked = []
    ends = readers._ends
    monkeypatch.setattr(readers, "_ends", lambda s, urls, wanted: looked.extend(urls) or ends(s, urls, wanted))
    for i in range(40):
        end = ["</r>", "<enrollment><employee_id>9", "", "</r>\n<!-- x -->"][i % 4]
        (tmp_path / f"s {i}.xml").write_text(f"<r>{_enrolled(i)}{end}")
    (tmp_path / "empty.xml").write_text("")
    (tmp_path / "large.xml").write_text(f"<r>{_enrolled(100)}{' ' * (2 << 20)}<enrollment><employee_id>8")
    (tmp_path / "packed.xml.gz").write_bytes(gzip.compress(f"<r>{_enrolled(101)}".encode()))
    rows = readers.read_xml(spark, str(tmp_path)).selectExpr("employee_id", "_raw", "_problem").collect()
    assert {u.rsplit("/", 1)[1] for u in looked} == {"large.xml", "packed.xml.gz"}
    assert sorted(int(r.employee_id) for r in rows if r._problem is None) == [*range(40), 100, 101]
    problems = collections.Counter(r._problem for r in rows if r._problem)
    assert problems == {"element is not closed": 11, "file is cut off": 10, "file is empty": 1}


def test_one_xml_file_is_read_by_several_tasks(spark, tmp_path):
    (tmp_path / "a.xml").write_text(f"<r>{_enrolled(*range(2000))}</r>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        frame = readers.read_xml(spark, str(tmp_path))
        assert frame.rdd.getNumPartitions() > 3
        assert [r.employee_id for r in frame.orderBy("_ord").collect()] == [str(i) for i in range(2000)]
        assert frame.where("_raw is not null").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_follow_each_other_by_name(spark, tmp_path):
    for folder in ("x", "another"):
        (tmp_path / folder).mkdir()
        for k in range(6):
            (tmp_path / folder / f"{k}.csv").write_text(f"employee_id,base_salary\n{k}a,1\n{k}b,1\n")
        rows = readers.read_csv(spark, str(tmp_path / folder), readers.PAYROLL_COLUMNS).orderBy("_ord").collect()
        assert [r.employee_id for r in rows] == [f"{k}{c}" for k in range(6) for c in "ab"]


def test_payroll_letters_hold_only_fields_of_the_source(spark):
    rows = spark.createDataFrame([("1", " ", 1)], "employee_id string, base_salary string, _ord int")
    assert json.loads(ex.payroll_extract(rows).rejected().first().record) == {"employee_id": "1", "base_salary": " "}


def test_xml(spark, tmp_path):
    path = tmp_path / "b.xml"
    path.write_text(
        "<benefits_enrollments>"
        "<enrollment><employee_id> 5 </employee_id><plan_type>Health</plan_type><premium_employee>1.5</premium_employee></enrollment>"
        "<enrollment><employee_id/><plan_type>Dental</plan_type></enrollment>"
        "</benefits_enrollments>"
    )
    extract = ex.benefits_extract(readers.read_xml(spark, str(path)))
    assert [(r.employee_id, r.plan_type, r.coverage_level, r.premium_employee, r.premium_employer) for r in extract.accepted().collect()] == [
        ("5", "Health", "", "1.5", None)
    ]
    assert [r.reason for r in extract.rejected().collect()] == ["Missing employee_id"]


def test_payroll_company_defaults(spark):
    with_company = spark.createDataFrame([("1", "X", "5", 1), (None, "Y", "6", 2), ("2", "Z", " ", 3)], "employee_id string, source string, base_salary string, _ord int")
    rows = {r.base_salary: r for r in ex.payroll_extract(with_company).accepted().collect()}
    assert set(rows) == {"5", "6"} and rows["5"].payroll_company_source == "X" and rows["5"].source == "X"
    without = ex.payroll_extract(with_company.drop("source")).accepted()
    assert {r.payroll_company_source for r in without.collect()} == {"GlobalTech"}
    no_salary = ex.payroll_extract(with_company.drop("base_salary"))
    assert no_salary.accepted().count() == 0


@pytest.mark.parametrize("read", [
    lambda s, p, **o: readers.read_csv(s, p, HRIS_COLUMNS, **o),
    lambda s, p, **o: readers.read_parquet(s, p, HRIS_COLUMNS, **o),
    lambda s, p, **o: readers.read_xml(s, p, **o),
    lambda s, p, **o: readers.read_json_records(s, p, **o),
])
def test_missing_sources(spark, tmp_path, read):
    path = str(tmp_path / "absent")
    assert read(spark, path).count() == 0
    with pytest.raises(AnalysisException):
        read(spark, path, on_missing="fail").count()


def test_missing_source_still_has_the_standard_schema(spark, tmp_path):
    empty = ex.api_extract(readers.read_json_records(spark, str(tmp_path / "absent")))
    assert empty.name == API
    assert empty.accepted().columns[: len(STANDARD_COLUMNS)] == list(STANDARD_COLUMNS)


def test_dead_letters_append(spark, csv_file, tmp_path):
    extract = ex.hris_extract(readers.read_csv(spark, csv_file, HRIS_COLUMNS, multi_line=True))
    path = str(tmp_path / "dead")
    sinks.append_dead_letters(ex.dead_letters([extract]), path)
    sinks.append_dead_letters(ex.dead_letters([extract]), path)
    rows = spark.read.csv(path, header=True, escape='"', multiLine=True).collect()
    assert len(rows) == 4 and {r.source for r in rows} == {"globaltech_hris"}
    assert {json.loads(r.record)["first_name"] for r in rows} == {"bob", "carl"}


def test_golden_sink_replaces_only_present_partitions(spark, tmp_path):
    path = str(tmp_path / "golden")
    frame = spark.createDataFrame([("GT-000001", 1), ("AC-000001", 2), ("other", 3)], "employee_id string, v int")
    sinks.write_golden(frame.withColumn("t", F.current_timestamp()), path)
    sinks.write_golden(frame.where("v = 1").withColumn("v", F.lit(9)).withColumn("t", F.current_timestamp()), path)
    back = spark.read.parquet(path)
    assert {(r.employee_id, r.v, r.company_origin) for r in back.collect()} == {
        ("GT-000001", 9, "GlobalTech"), ("AC-000001", 2, "AcquiredCo"), ("other", 3, "AcquiredCo"),
    }
    assert dict(back.dtypes)["t"] == "timestamp_ntz"


def test_csv_sink_keeps_blanks_and_quotes(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_csv(spark.createDataFrame([(' a "b" ',)], "x string"), path)
    assert spark.read.csv(path, header=True, escape='"').first().x == ' a "b" '
