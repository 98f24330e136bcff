import datetime

import pytest
from pyspark.sql import functions as F

from tributary.operators import quality as q
from tributary.plans.charts import quality_summary
from tributary.sinks.exports import quality_page


def by_check(report):
    return {r["check"]: tuple(r[c] for c in ("total", "passed", "failed", "pass_rate", "status"))
            for r in report.collect()}


def test_column_checks(spark):
    df = spark.createDataFrame(
        [("GT-000001", "x", datetime.date(2020, 1, 1)), ("GT-000001", "y\n", datetime.date(1960, 1, 1)),
         ("XGT-000002", None, None), (None, "x", datetime.date(2024, 1, 1))],
        "id string, v string, d date")
    report = q.quality_report(df, [
        q.not_null("id", ""), q.unique("id", ""), q.matches("id", r"(GT|AC)-\d{6}$", ""),
        q.matches("v", "^[xy]$", ""), q.in_set("v", ["x"], ""), q.unique("v", ""),
        q.date_range("d", "1970-01-01", "2024-01-01", ""),
        q.not_null("v", "", threshold=0.75), q.column_present(df, "id", ""),
        q.column_present(df, "nope", ""), q.min_row_count(4, ""), q.flag_rate("v", "x", 0.5, ""),
    ])
    assert [r.position for r in report.orderBy("position").collect()] == list(range(1, 13))
    rows = {r.position: (r.total, r.passed, r.failed, r.pass_rate, r.status) for r in report.collect()}
    third = pytest.approx
    assert rows[1] == (4, 3, 1, 0.75, "FAIL")
    assert rows[2] == (3, 2, 1, third(0.6667), "FAIL")
    assert rows[3] == (3, 2, 1, third(0.6667), "FAIL")
    assert rows[4] == (3, 3, 0, 1.0, "PASS")          # a dollar sign accepts a final line break
    assert rows[5] == (3, 2, 1, third(0.6667), "FAIL")
    assert rows[6] == (3, 2, 1, third(0.6667), "FAIL")
    assert rows[7] == (3, 2, 1, third(0.6667), "FAIL")
    assert rows[8] == (4, 3, 1, 0.75, "PASS")
    assert rows[9] == (1, 1, 0, 1.0, "PASS")
    assert rows[10] == (1, 0, 1, 0.0, "FAIL")
    assert rows[11] == (4, 4, 0, 1.0, "PASS")
    assert rows[12] == (4, 2, 0, 0.5, "PASS")


def test_breaches(spark):
    df = spark.range(10).select(F.when(F.col("id") < 6, "bad").otherwise("ok").alias("flag"))
    rows = by_check(q.quality_report(df, [
        q.flag_rate("flag", "bad", 0.5, ""), q.min_row_count(16, ""), q.ghost_rate(spark.range(30), ""),
    ]))
    assert rows["FLAG RATE: flag=bad"] == (10, 0, 6, 0.4, "FAIL")
    assert rows["MIN ROW COUNT"] == (10, 0, 6, 0.625, "FAIL")
    assert rows["GHOST RATE: payroll vs HRIS"] == (40, 0, 30, 0.25, "FAIL")


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "a string")
    rows = by_check(q.quality_report(df, [
        q.not_null("a", ""), q.unique("a", ""), q.matches("a", "x", ""), q.flag_rate("a", "x", 0.1, ""),
        q.ghost_rate(None, ""),
    ]))
    assert all(row == (0, 0, 0, 1.0, "PASS") for row in rows.values()) and len(rows) == 5


def test_threshold_is_met_exactly(spark):
    df = spark.range(100).select(F.when(F.col("id") >= 5, "x").alias("a"))
    assert by_check(q.quality_report(df, [q.not_null("a", "")]))["NOT NULL: a"] == (100, 95, 5, 0.95, "PASS")
    worse = spark.range(1000).select(F.when(F.col("id") >= 51, "x").alias("a"))
    assert by_check(q.quality_report(worse, [q.not_null("a", "")]))["NOT NULL: a"][-1] == "FAIL"


def golden_rows(spark, count, nulls):
    n = F.col("id")
    return spark.range(count).select(
        F.format_string("GT-%06d", n).alias("employee_id"), F.lit("Ann").alias("first_name"),
        F.lit("Lee").alias("last_name"), F.format_string("m%d@x.org", n).alias("email"),
        F.lit("2020-01-01").cast("date").alias("hire_date"),
        F.when(n >= nulls, "Legal").alias("department"), F.lit("a").alias("source_systems"))


def test_suite_reproduces_known_arithmetic(spark):
    golden, ghosts = golden_rows(spark, 9099, 34), spark.range(8498)
    report = q.quality_report(golden, q.standard_checks(golden, ghosts, "2024-01-01"))
    rows = [(r["check"], r.total, r.passed, r.failed, r.pass_rate, r.status)
            for r in report.orderBy("position").collect()]
    full = (9099, 9099, 0, 1.0, "PASS")
    assert rows == [
        ("NOT NULL: employee_id", *full), ("UNIQUE: employee_id", *full), ("REGEX: employee_id", *full),
        ("NOT NULL: first_name", *full), ("NOT NULL: last_name", *full), ("NOT NULL: email", *full),
        ("REGEX: email", *full), ("UNIQUE: email", *full), ("NOT NULL: hire_date", *full),
        ("DATE RANGE: hire_date", *full),
        ("NOT NULL: department", 9099, 9065, 34, 0.9963, "PASS"),
        ("VALUES IN SET: department", 9065, 9065, 0, 1.0, "PASS"),
        ("COLUMN PRESENT: source_systems", 1, 1, 0, 1.0, "PASS"),
        ("MIN ROW COUNT", *full),
        ("GHOST RATE: payroll vs HRIS", 17597, 9099, 0, 0.5171, "PASS"),
    ]
    labels = [r.label for r in quality_summary(report).orderBy("position").collect()]
    assert labels[:3] == ["emp_id"] * 3 and labels[-2:] == ["MIN ROW COUNT", "payroll vs HRIS"]
    page = quality_page(report).first()["value"]
    assert "Total checks: 15 | Passed: 15 | Failed: 0" in page
    assert page.count("<tr style=") == 15 and page.index("NOT NULL: first_name") < page.index("MIN ROW")
    assert "<td>99.6%</td><td>34 / 9099</td>" in page and "#d4edda" in page


def test_one_pass_over_the_table(spark):
    golden = golden_rows(spark, 10, 0)
    report = q.quality_report(golden, q.standard_checks(golden, None, "2024-01-01"))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 10") == 2  # all plain checks, all uniqueness checks


@pytest.mark.parametrize("failures,opens", [(2, True), (3, False)])
def test_gate(spark, failures, opens):
    report = spark.createDataFrame([(i, "FAIL" if i < failures else "PASS") for i in range(6)],
                                   "position int, status string")
    if opens:
        q.enforce_gate(report)
    else:
        with pytest.raises(q.QualityGateError, match="3 of 6"):
            q.enforce_gate(report)
    assert not q.all_passed(report).first()[0]
    assert q.all_passed(report.where("false")).first()[0]
