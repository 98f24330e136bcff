import datetime
import json

import pytest

from tributary.queries.workbook_files import workbook
from tributary.fixed_values import ROSTER_COLUMNS
from tributary.operators.quality import QualityGateError
from tributary.plans.pipeline import run_pipeline

FIRST = ["Ann", "Bob", "Cid", "Dan", "Eve", "Fay", "Gus", "Hal", "Ida", "Jon"]
LAST = ["Abel", "Brown", "Clark", "Davis", "Evans", "Foster", "Grant", "Hayes", "Irwin", "Jones"]


def roster(count):
    return [[str(i), FIRST[i % 10] + chr(97 + i // 10 % 26) * 3, LAST[i // 100 % 10], f"m{i}@x.org", "Legal", "Clerk",
             f"20{10 + i % 10}-01-01", "USA" if i % 3 else "Peru", "Full-Time", ""] for i in range(count)]


def second(i, first, last, email, day):
    return {"employee_identifier": f"ACQ_{i:05d}", "name": {"first": first, "last": last},
            "contact": {"email": email}, "assignment": {"department": "Sales", "role": "Clerk", "location": "Chile",
            "hire_timestamp": day + "T00:00:00Z"}, "manager": {"employee_id": None}, "employment_type": "PT"}


@pytest.fixture
def files(tmp_path):
    rows = roster(1100)
    rows.append(rows[5])                                        # an exact duplicate
    (tmp_path / "r.csv").write_text("\n".join([",".join(ROSTER_COLUMNS), *map(",".join, rows)]) + "\n")
    others = [
        second(1, "Zed", "Zeller", "zed@x.org", "2015-01-01"),   # unique
        second(2, "Other", "Name", " M7@x.org", "2015-01-01"),   # merged by mail
        second(3, rows[20][1], rows[20][2], None, "2010-01-15"),  # merged by name and date
        second(4, rows[30][1], rows[30][2], None, "2019-01-15"),  # reviewed: date too far
    ]
    (tmp_path / "a.json").write_text(json.dumps({"employees": others}))
    head = ["employee_id", "source", "base_salary", "currency", "pay_frequency", "bonus_target_pct", "effective_date"]
    day = datetime.date(2024, 1, 1)
    pay = [[i, "GlobalTech", 1000 + i, "USD", "Annual", 0.1, day] for i in range(1100)]
    pay += [[f"ACQ_{i:05d}", "AcquiredCo", "$1,000", "EUR", "Monthly", 0.1, day] for i in range(1, 5)]
    pay.append([5000, "GlobalTech", 1, "JPY", "Annual", 0.1, day])
    (tmp_path / "p.xlsx").write_bytes(workbook([head, *pay]))
    tags = ["employee_id", "plan_type", "coverage_level", "enrollment_date", "premium_employee", "premium_employer"]
    (tmp_path / "b.xml").write_text("<all>" + "".join(
        "<enrollment>" + "".join(f"<{t}>{i}</{t}>" for t in tags) + "</enrollment>" for i in range(550)) + "</all>")
    return [str(tmp_path / name) for name in ("r.csv", "a.json", "p.xlsx", "b.xml")]


def test_pipeline(spark, files, tmp_path):
    out = str(tmp_path / "out")
    result = run_pipeline(spark, *files, out, as_of="2024-01-01")
    summary = dict(result.summary)
    assert summary.pop("duration_seconds") > 0
    assert summary == {"input_records": 1105, "golden_records": 1102, "review_candidates": 1,
                       "ghost_records": 3, "checks_passed": 15, "checks": 15}
    golden = {r.employee_id: r for r in spark.read.parquet(result.files["golden"]).collect()}
    both = "globaltech_hris,acquiredco_hris"
    assert (golden["GT-000007"].source_systems, golden["GT-000007"].dedup_method) == (both, "exact_email")
    assert (golden["GT-000020"].source_systems, golden["GT-000020"].dedup_method) == (both, "fuzzy_name_date")
    assert golden["AC-000001"].dedup_method == "unique" and golden["AC-000001"].employment_type == "Part-Time"
    assert golden["AC-000001"].company_origin == "AcquiredCo" and golden["AC-000004"].country == "Chile"
    assert golden["GT-000000"].hire_date == datetime.datetime(2010, 1, 1)
    assert "hire_date_flag" not in golden["GT-000000"] and len(golden["GT-000000"]) == 15
    ghosts = spark.read.csv(result.files["ghosts"], header=True).collect()
    assert sorted((g.payroll_employee_id, g.salary_usd_annual) for g in ghosts) == [
        ("AC-000002", "12960.0"), ("AC-000003", "12960.0"), ("GT-005000", None)]
    review = spark.read.csv(result.files["review"], header=True).collect()
    assert [(r.record_1_id, r.record_2_id, r.recommended_action) for r in review] == [
        ("GT-000030", "AC-000004", "VERIFY_HIRE_DATE")]
    report = spark.read.csv(result.files["report"], header=True).collect()
    assert len(report) == 15 and {r.status for r in report} == {"PASS"} and report[0].check == "NOT NULL: employee_id"
    page = "\n".join(r.value for r in spark.read.text(result.files["page"], wholetext=True).collect())
    assert page.count("<tr style") == 15
    feeds = {name: feed.collect() for name, feed in result.charts.items()}
    assert [(r.department, r["count"]) for r in feeds["headcount_by_department"]] == [("Sales", 2), ("Legal", 1100)]
    assert [r.country for r in feeds["headcount_by_country"]] == ["USA", "Peru", "Chile"]
    assert [(r.department, r.enrollment_rate) for r in feeds["enrollment_by_department"]] == [("Sales", 0.0), ("Legal", 50.0)]
    assert [r.n for r in feeds["salary_by_employment_type"]] == [1100, 2]
    assert sum(r["count"] for r in feeds["tenure_distribution"]) == 1102
    assert result.inputs.dead_letters.count() == 0


def test_gate_stops_after_the_report(spark, files, tmp_path):
    out = tmp_path / "out"
    rows = roster(20)
    for row in rows:
        row[3] = "no address"
        row[4] = "Unheard-of"
    (tmp_path / "r.csv").write_text("\n".join([",".join(ROSTER_COLUMNS), *map(",".join, rows)]) + "\n")
    with pytest.raises(QualityGateError):
        run_pipeline(spark, files[0], files[1], files[2], str(tmp_path / "missing.xml"), str(out), as_of="2024-01-01")
    assert (out / "quality_report.csv").exists() and (out / "quality_report.html").exists()
    assert not (out / "golden_employees.parquet").exists()
