import datetime
import json

import pytest
from pyspark.sql import functions as F

from tributary.queries.workbook_files import workbook
from tributary.fixed_values import NESTED_RENAMES, PAYROLL_COLUMNS, ROSTER_COLUMNS
from tributary.operators.conform import (
    conform, empty_frame, map_codes, map_codes_from, stack, unmapped_values)
from tributary.sinks import exports
from tributary.sources import readers
from tributary.sources.flatten import flatten
from tributary.sources.workbook_source import register


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def letters(read):
    return sorted((r.source, r.reason, r.record) for r in read.dead_letters.collect())


HEADER = ",".join(ROSTER_COLUMNS)


def test_delimited(spark, tmp_path, rows_of):
    path = write(tmp_path / "r.csv", HEADER + "\n"
                 '1,Ann,"Lee, Jr",a@x,Legal,"Boss\nof all",2020-01-01,USA,Full-Time,\n'
                 "2,NA, NA,null,,Clerk,2020-01-02,Peru,Part-Time,1\n"
                 "3,Short,Row\n"
                 "4,a,b,c,d,e,f,g,h,i,surplus\n"
                 "5,a,b,c,d,e,f,g,h,i,\n"
                 '6,"say ""hi""",b,c,d,e,f,g,h,7\n')
    read = readers.read_delimited(spark, path)
    rows = read.rows.orderBy("_ord").drop("_ord").collect()
    assert [tuple(r) for r in rows] == [
        ("1", "Ann", "Lee, Jr", "a@x", "Legal", "Boss\nof all", "2020-01-01", "USA", "Full-Time", None, "globaltech_hris"),
        ("2", None, " NA", None, None, "Clerk", "2020-01-02", "Peru", "Part-Time", "1", "globaltech_hris"),
        ("3", "Short", "Row", None, None, None, None, None, None, None, "globaltech_hris"),
        ("6", 'say "hi"', "b", "c", "d", "e", "f", "g", "h", "7", "globaltech_hris"),
    ]
    assert [l[1] for l in letters(read)] == ["more fields than the header"] * 2
    assert read.dead_letters.first().path.endswith("r.csv")
    assert read.rows.count() == 4 and read.rows.select("country").where("country is null").count() == 1
    assert read.schema_issues.count() == 0


def test_delimited_order_over_several_files(spark, tmp_path):
    for part in range(4):
        lines = "".join(f"{part * 100 + i},x\n" for i in range(50 + 400 * (part == 2)))
        write(tmp_path / f"part{part}.csv", "employee_id,first_name\n" + lines)
    read = readers.read_delimited(spark, str(tmp_path))
    ids = [int(r.employee_id) for r in read.rows.repartition(5).orderBy("_ord").collect()]
    assert ids == [p * 100 + i for p in range(4) for i in range(50 + 400 * (p == 2))]
    assert {r.column for r in read.schema_issues.collect()} == set(ROSTER_COLUMNS) - {"employee_id", "first_name"}


def test_delimited_files_with_different_headers(spark, tmp_path):
    write(tmp_path / "a 1.csv", "employee_id,first_name,last_name\n1,Ann,Lee\n")
    write(tmp_path / "b.csv", "last_name,employee_id,first_name\nKay,2,Bob\n")
    write(tmp_path / "c.csv", '"first_name",employee_id\n"Cy\nrus",3\n4,5,6\n')
    write(tmp_path / "d.csv", "")
    read = readers.read_delimited(spark, str(tmp_path), expected=["employee_id", "first_name", "last_name"])
    rows = read.rows.orderBy("_ord").select("employee_id", "first_name", "last_name").collect()
    assert [tuple(r) for r in rows] == [("1", "Ann", "Lee"), ("2", "Bob", "Kay"), ("3", "Cy\nrus", None)]
    assert [(l[1], l[2]) for l in letters(read)] == [("more fields than the header", "4,5,6")]
    assert [r.column for r in read.schema_issues.collect()] == ["last_name"]
    empty = readers.read_delimited(spark, str(tmp_path / "d.csv"))
    assert empty.rows.count() == 0 and [l[1] for l in letters(empty)] == ["NO_HEADER"]


def people(count, **changes):
    person = {
        "employee_identifier": "ACQ_00001", "name": {"first": "Ann", "last": "Lee"},
        "contact": {"email": "a@x"}, "assignment": {"department": "Legal", "role": "Clerk",
        "location": "Peru", "hire_timestamp": "2020-01-01T08:00:00Z"},
        "manager": {"employee_id": "ACQ_00009"}, "employment_type": "FT", **changes}
    return [{**person, "employee_identifier": f"ACQ_{i:05d}"} for i in range(count)]


@pytest.mark.parametrize("count,pages", [
    (99, [(1, 99, 0, 98)]), (100, [(1, 100, 0, 99)]), (101, [(1, 100, 0, 99), (2, 1, 100, 100)])])
def test_nested_pages(spark, tmp_path, rows_of, count, pages):
    path = write(tmp_path / "a.json", json.dumps({"employees": people(count)}, indent=1))
    read = readers.read_nested(spark, path)
    assert read.rows.count() == count and read.dead_letters.count() == 0
    assert rows_of(readers.page_statistics(read.rows).drop("_file", "_document")) == pages


def test_nested_values(spark, tmp_path):
    write(tmp_path / "a.json", json.dumps({"employees": people(1) + people(1, name=None, employment_type="??")}))
    write(tmp_path / "b.json", json.dumps({"employees": [{"employee_identifier": 7, "extra": [1]}]}))
    read = readers.read_nested(spark, str(tmp_path))
    rows = conform(read.rows, "acquiredco_hris", NESTED_RENAMES, keep=("_ord",)).orderBy("_ord").drop("_ord").collect()
    common = ("a@x", "Legal", "Clerk", "2020-01-01T08:00:00Z", "Peru")
    assert [tuple(r) for r in rows] == [
        ("ACQ_00000", "Ann", "Lee", *common, "Full-Time", "ACQ_00009", "acquiredco_hris", "AcquiredCo"),
        ("ACQ_00000", None, None, *common, None, "ACQ_00009", "acquiredco_hris", "AcquiredCo"),
        ("7", None, None, None, None, None, None, None, None, None, "acquiredco_hris", "AcquiredCo"),
    ]


def test_nested_pages_per_line(spark, tmp_path):
    pages = [people(3)[i:i + 1] for i in range(3)] + [people(2)]
    write(tmp_path / "pages.json", "\n".join(json.dumps({"employees": p}) for p in pages) + "\n{broken\n")
    read = readers.read_nested(spark, str(tmp_path), multi_line=False)
    ids = [r.employee_identifier[-1] for r in read.rows.orderBy("_ord").collect()]
    assert ids == list("01201") and [l[1] for l in letters(read)] == ["malformed document"]
    assert readers.page_statistics(read.rows).count() == 4


def test_nested_dead_letters(spark, tmp_path):
    write(tmp_path / "bad.json", '{"employees": [')
    write(tmp_path / "none.json", '{"employees": []}')
    write(tmp_path / "other.json", '{"people": [1]}')
    write(tmp_path / "ok.json", json.dumps({"employees": people(2)}))
    read = readers.read_nested(spark, str(tmp_path))
    assert read.rows.count() == 2
    assert [l[1] for l in letters(read)] == ["malformed document", "no records", "no records"]


def test_tagged(spark, tmp_path, rows_of):
    def element(**values):
        base = {"employee_id": "1", "plan_type": "A", "coverage_level": "B", "enrollment_date": "2020-01-01",
                "premium_employee": "1.5", "premium_employer": " 2 "} | values
        return "<enrollment>" + "".join(f"<{k}>{v}</{k}>" for k, v in base.items() if v is not None) + "</enrollment>"
    path = write(tmp_path / "b.xml", "<?xml version='1.0'?>\n<enrollments>\n" + "\n".join([
        element(), element(plan_type="", employee_id="2"), element(plan_type=None, coverage_level=None),
    ]) + "\n</enrollments>")
    read = readers.read_tagged(spark, path)
    assert rows_of(read.rows) == [("1", "A", "B", "2020-01-01", "1.5", " 2 ", "benefits"),
                                  ("2", None, "B", "2020-01-01", "1.5", " 2 ", "benefits")]
    assert [l[1] for l in letters(read)] == ["missing plan_type, coverage_level"]


def test_workbooks(spark, tmp_path, rows_of):
    day = datetime.date(2024, 2, 29)
    head = ["employee_id", "source", "base_salary", "currency", "pay_frequency", "bonus_target_pct", "effective_date"]
    (tmp_path / "a.xlsx").write_bytes(workbook([
        head, [7, "GlobalTech", 85000, "USD", "Annual", 0.1, day],
        ["ACQ_00001", "AcquiredCo", "$1,000", "EUR", "Monthly", None, day], ["x", "NA", "nan & <b>", "", None, None, None],
    ], blank_rows=(3,)))
    (tmp_path / "b.xlsx").write_bytes(workbook([["source", "employee_id", "bonus"], ["GlobalTech", 8, 1]]))
    (tmp_path / "c.xlsx").write_bytes(b"no archive")
    (tmp_path / "d.xlsx").write_bytes(workbook([["employee_id"], [9]])[:-30])
    read = readers.read_workbooks(spark, str(tmp_path))
    assert read.rows.columns == ["employee_id", "company_origin", *PAYROLL_COLUMNS[2:], "source"]
    assert rows_of(read.rows) == sorted([
        ("7", "GlobalTech", "85000", "USD", "Annual", "0.1", "2024-02-29", "payroll"),
        (None, None, None, None, None, None, None, "payroll"),
        ("ACQ_00001", "AcquiredCo", "$1,000", "EUR", "Monthly", None, "2024-02-29", "payroll"),
        ("x", None, "nan & <b>", None, None, None, None, "payroll"),
        ("8", "GlobalTech", None, None, None, None, None, "payroll"),
    ], key=repr)
    assert [l[1] for l in letters(read)] == ["malformed workbook"] * 2
    assert rows_of(read.schema_issues) == sorted(("payroll", c) for c in PAYROLL_COLUMNS[2:])


def test_workbook_source(spark, tmp_path):
    """A folder with a large, a broken and an empty file: a partition each, rows in batches, none of the broken one."""
    (tmp_path / "large one.xlsx").write_bytes(workbook([["k", "v"], *[[i, f"x{i}"] for i in range(12_000)]]))
    broken = workbook([["k"], *[[i] for i in range(9_000)]])
    at = broken.index(b"xl/worksheets/sheet1.xml") + 3000
    (tmp_path / "broken.xlsx").write_bytes(broken[:at] + b"?" * 40 + broken[at + 40:])
    (tmp_path / "empty.xlsx").write_bytes(b"")
    (tmp_path / "_SUCCESS").write_bytes(b"")
    register(spark)
    for path in (str(tmp_path), f"file://{tmp_path}".replace(" ", "%20")):
        read = spark.read.format("workbooks").load(path)
        assert read.rdd.getNumPartitions() == 3
        found = {r.name: (r.rows, r.errors) for r in read.groupBy(F.regexp_extract("path", "[^/]*$", 0).alias("name")).agg(
            F.count_if(F.col("row") > 1).alias("rows"), F.count("error").alias("errors")).collect()}
        assert sorted(found.values()) == [(0, 1), (0, 1), (12_000, 0)]
    last = read.where("row = 12001").first()
    assert last.cells == {"k": "11999", "v": "x11999"}
    one = spark.read.format("workbooks").load(str(tmp_path / "large one.xlsx"))
    assert one.count() == 12_001


def test_missing_paths(spark, tmp_path):
    nowhere = str(tmp_path / "nowhere")
    for reader, columns in ((readers.read_delimited, 12), (readers.read_nested, 14),
                            (readers.read_tagged, 7), (readers.read_workbooks, 8)):
        read = reader(spark, nowhere)
        assert read.rows.count() == 0 and len(read.rows.columns) in (columns, columns - 2)
        letter = read.dead_letters.first()
        assert letter.path == nowhere and "PATH" in letter.reason


def test_flatten(spark):
    df = spark.sql("select 1 as a, named_struct('x', 2, 'y', named_struct('z', array(3))) as b, cast(null as struct<k:int>) as c")
    flat = flatten(df)
    assert flat.columns == ["a", "b_x", "b_y_z", "c_k"] and tuple(flat.first()) == (1, 2, [3], None)


def test_conform_and_stack(spark, rows_of):
    df = spark.createDataFrame([("1", "x")], "employee_id string, extra string")
    fixed = conform(df, "payroll")
    assert fixed.first().company_origin == "Unknown" and "extra" not in fixed.columns
    assert stack([fixed, conform(df, "globaltech_hris")]).count() == 2
    assert stack([], spark).columns == empty_frame(spark).columns
    uneven = stack([df, spark.createDataFrame([("2",)], "employee_id string")])
    assert rows_of(uneven) == [("1", "x"), ("2", None)]


def test_codes(spark, rows_of):
    df = spark.createDataFrame([("FT",), ("XX",), ("XX",), (None,)], "t string")
    assert rows_of(map_codes(df, "t")) == sorted([("Full-Time",), (None,), (None,), (None,)], key=repr)
    assert rows_of(unmapped_values(df, "t", {"FT": "Full-Time"})) == [("XX",)]
    table = spark.createDataFrame([("FT", "Full-Time")], "code string, value string")
    assert rows_of(map_codes_from(df, "t", table)) == rows_of(map_codes(df, "t"))


GOLDEN = "employee_id string, company_origin string, hire_date date, hire_date_flag string, _ord long"


def test_golden_replaces_only_its_partitions(spark, tmp_path, rows_of):
    day = datetime.date(2020, 1, 1)
    both = spark.createDataFrame([("a", "GlobalTech", day, "ok", 1), ("b", "AcquiredCo", None, "x", 2)], GOLDEN)
    path = exports.write_golden(both, str(tmp_path))
    one = spark.createDataFrame([("c", "GlobalTech", day, "ok", 1)], GOLDEN)
    exports.write_golden(one, str(tmp_path), even_files=True)
    back = spark.read.parquet(path)
    assert rows_of(back, "employee_id", "company_origin") == [("b", "AcquiredCo"), ("c", "GlobalTech")]
    assert dict(back.dtypes) == {"employee_id": "string", "hire_date": "timestamp_ntz", "company_origin": "string"}


def test_reports(spark, tmp_path):
    ghosts = spark.createDataFrame([("g1", 12345678.0), ("g2", 0.1), ("g3", None)],
                                   "employee_id string, salary_usd_annual double")
    path = exports.write_ghost_report(ghosts, str(tmp_path))
    text = "\n".join(sorted(r.value for r in spark.read.text(path).collect()))
    assert "g1,N/A (payroll-only record),12345678.0,No matching HRIS employee record" in text
    assert "g2,N/A (payroll-only record),0.1," in text and "g3,N/A (payroll-only record),," in text
    assert exports.ghost_report(ghosts.select("employee_id")).first().salary_usd_annual is None
    review = spark.createDataFrame([("g", "a", 81.25, 3), ("g", "b", 88.0, None), ("g", "c", 87.999, 400)],
                                   "gt_employee_id string, ac_employee_id string, name_score double, date_diff_days int")
    rows = exports.review_report(review).collect()
    assert [(r.similarity_score, r.recommended_action) for r in rows] == [
        (81.2, "MANUAL_REVIEW"), (88.0, "VERIFY_HIRE_DATE"), (88.0, "MANUAL_REVIEW")]
    assert exports.write_review_report(review, str(tmp_path)) is not None
    counts = {r.recommended_action: r["count"] for r in exports.action_counts(exports.review_report(review)).collect()}
    assert counts == {"MANUAL_REVIEW": 2, "VERIFY_HIRE_DATE": 1}
    assert exports.write_ghost_report(ghosts.where("false"), str(tmp_path / "none")) is None
    assert exports.write_review_report(review.where("false"), str(tmp_path / "none")) is None
    assert not (tmp_path / "none").exists()
