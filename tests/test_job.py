import json

import pytest

from rillweave.config import IntegrationConfig
from rillweave.operators.quality import GateFailed
from rillweave.plans.job import run_job


@pytest.fixture
def paths(tmp_path):
    people = [(i, f"name{i}", f"family{i}x", f"p{i}@corp.example") for i in range(1, 41)]
    people[1] = (2, "name1", "family1x", "p2@corp.example")
    (tmp_path / "hris.csv").write_text(
        "employee_id,first_name,last_name,email,department,job_title,hire_date,country,employment_type,manager_id\n"
        + "".join(f"{i},{f},{l},{e},ENG-01,Dev,2020-01-{1 + i % 28:02d},US,FT,{1 if i > 1 else ''}\n" for i, f, l, e in people)
        + "99,,x,y,ENG-01,Dev,2020-01-01,US,FT,1\n"
    )
    (tmp_path / "api.json").write_text(json.dumps({"employees": [
        {"employee_identifier": "ACQ_00001", "name": {"first": "zoë", "last": "o'brien"}, "contact": {"email": "p3@corp.example"},
         "assignment": {"department": "Tech", "role": "Dev", "hire_timestamp": "2019-01-01T00:00:00", "location": "DE"},
         "employment": {"type": "CT"}, "manager_employee_id": "ACQ_00001"}]}))
    (tmp_path / "payroll.csv").write_text(
        "employee_id,source,base_salary,currency,pay_frequency,bonus_target_pct,effective_date\n"
        + "".join(f'{i},GlobalTech,"$50,000",USD,Annual,5,2020-01-01\n' for i in range(1, 41)))
    (tmp_path / "benefits.xml").write_text(
        "<benefits_enrollments>" + "".join(f"<enrollment><employee_id>{i}</employee_id><plan_type>Dental</plan_type></enrollment>" for i in range(1, 21))
        + "</benefits_enrollments>")
    return {"globaltech_hris": str(tmp_path / "hris.csv"), "acquiredco_api": str(tmp_path / "api.json"),
            "payroll": str(tmp_path / "payroll.csv"), "benefits": str(tmp_path / "benefits.xml")}


def test_whole_job(spark, paths, tmp_path):
    out = str(tmp_path / "out")
    result = run_job(spark, paths, out, as_of="2026-12-03", list_pairs=True)
    assert result.gate_passed
    golden = {r.employee_id: r for r in spark.read.parquet(f"{out}/golden").collect()}
    assert len(golden) == 40 and "AC-000001" not in golden
    one = golden["GT-000001"]
    assert (one.first_name, one.department, one.salary_usd_annual, one.plan_type, one.company_origin) == ("Name1", "Engineering", 50000.0, "Dental", "GlobalTech")
    assert one.source_systems == "benefits,globaltech_hris,payroll" and one.dedup_method == "exact_id"
    assert golden["GT-000003"].dedup_method == "email_match"
    assert golden["GT-000003"].source_systems == "acquiredco_api,benefits,globaltech_hris,payroll"
    assert one.probable_match_flag and golden["GT-000002"].probable_match_flag
    pairs = spark.read.csv(f"{out}/probable_matches", header=True).collect()
    assert ("GT-000001", "GT-000002", "100.0") in {(r.record_1_id, r.record_2_id, r.similarity_score) for r in pairs}
    links = spark.read.csv(f"{out}/probable_match_links", header=True, inferSchema=True).collect()
    assert sum(r.n_pairs for r in links) == len(pairs)
    members = {r.employee_id for r in spark.read.csv(f"{out}/probable_match_records", header=True).collect()}
    assert {i for r in pairs for i in (r.record_1_id, r.record_2_id)} <= members
    assert spark.read.csv(f"{out}/dead_letter", header=True, escape='"').count() == 1
    assert spark.read.csv(f"{out}/validation_report", header=True, escape='"').count() == 15
    assert spark.read.csv(f"{out}/profile/tenure_histogram", header=True).count() == 25
    counts = {r.source: (r.raw, r.clean, r.dropped) for r in spark.read.csv(f"{out}/ingest_counts", header=True).collect()}
    assert counts["globaltech_hris"] == ("41", "40", "1") and counts["benefits"] == ("20", "20", "0")


def test_gate_stops_before_the_exports(spark, paths, tmp_path):
    out = tmp_path / "out"
    config = IntegrationConfig(gate_max_failures=-1)
    with pytest.raises(GateFailed):
        run_job(spark, paths, str(out), as_of="2026-12-03", config=config)
    assert (out / "validation_report").exists() and not (out / "golden").exists()


@pytest.mark.parametrize("damaged", [0, 1])
def test_unreadable_sources_do_not_stop_the_others(spark, paths, tmp_path, damaged):
    payroll = tmp_path / "payroll"
    spark.read.csv(paths["payroll"], header=True).repartition(2).write.parquet(str(payroll))
    part = sorted(payroll.glob("part-*.parquet"))[damaged]
    part.write_bytes(part.read_bytes()[:-40])
    empty = tmp_path / "hris"
    empty.mkdir()
    (empty / "0.csv").write_text("")
    text = (tmp_path / "hris.csv").read_text()
    (empty / "1.csv").write_text("\n".join(",".join(reversed(line.split(","))) for line in text.splitlines()))
    out = str(tmp_path / "out")
    config = IntegrationConfig(gate_max_failures=15)
    run_job(spark, paths | {"payroll": str(payroll), "globaltech_hris": str(empty)}, out, as_of="2026-12-03", config=config, payroll_format="parquet")
    counts = {r.source: (r.raw, r.clean, r.dropped) for r in spark.read.csv(f"{out}/ingest_counts", header=True).collect()}
    assert counts == {
        "globaltech_hris": ("42", "40", "2"), "acquiredco_api": ("1", "1", "0"), "payroll": ("1", "0", "1"), "benefits": ("20", "20", "0"),
    }
    letters = {r.reason: r for r in spark.read.csv(f"{out}/dead_letter", header=True, escape='"').collect()}
    assert {"Parse error: file is empty", "Missing required fields: ['first_name']"} < set(letters)
    [unread] = [r for k, r in letters.items() if k.startswith("Source unreadable: ")]
    assert unread.source == "payroll" and str(payroll) in unread.record
    with pytest.raises(Exception, match="FAILED_READ_FILE|CANNOT_READ|Checksum error"):
        run_job(spark, paths | {"payroll": str(payroll)}, out, as_of="2026-12-03", payroll_format="parquet", on_missing="fail")
