import datetime
import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tributary.functions import dates, ids, money, rounding, similarity, text


def values(spark, rows, schema, column):
    numbered = [(i, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(numbered, f"_i int, {schema}").select("_i", column.alias("out"))
    return [row.out for row in df.orderBy("_i").collect()]


def test_company_a_ids(spark):
    raw = ["7", "1234567", "-5", "x1", None, "892.0", "GT-000007", " 12 ", "1_000", "-0", "007",
           "99999999999999999999999"]
    got = values(spark, [(r, "GlobalTech") for r in raw], "id string, o string",
                 ids.namespaced_id(F.col("id"), F.col("o")))
    assert got == ["GT-000007", "GT-1234567", "GT--00005", "x1", None, "GT-000892", "GT-000007",
                   "GT-000012", "GT-001000", "GT-000000", "GT-000007", "GT-99999999999999999999999"]


def test_company_b_and_other_ids(spark):
    raw = [("ACQ_00012", "AcquiredCo"), ("ACQ_x", "AcquiredCo"), ("12", "AcquiredCo"),
           ("12.0", "AcquiredCo"), (None, "AcquiredCo"), ("7", "Unknown"), ("7", None)]
    got = values(spark, raw, "id string, o string", ids.namespaced_id(F.col("id"), F.col("o")))
    assert got == ["AC-000012", "ACQ_x", "AC-000012", "12.0", None, "7", "7"]


def test_clean_name(spark):
    raw = ["élan", "o'brien-smith", "3rd", "o.brien", "a  b", None, " x,y ", "", "McDONALD"]
    got = values(spark, [(r,) for r in raw], "n string", text.clean_name(F.col("n")))
    assert got == ["Élan", "O Brien Smith", "3Rd", "O.Brien", "A B", None, "X Y", "", "Mcdonald"]


def test_full_name_is_null_if_a_part_is(spark):
    got = values(spark, [("A", "B"), (None, "B"), ("A", None)], "f string, l string",
                 text.full_name(F.col("f"), F.col("l")))
    assert got == ["A B", None, None]


def test_keys(spark):
    raw = [(" A@x.com\t",), ("a@x.com",), ("",), (None,), ("\x1fb ",)]
    assert values(spark, raw, "e string", text.match_key(F.col("e"))) == ["a@x.com", "a@x.com", "", None, "b"]
    raw = [("smith",), ("",), (None,), ("élan",), ("9a",)]
    assert values(spark, raw, "e string", text.block_key(F.col("e"))) == ["S", "?", "?", "É", "9"]
    raw = [("john smith",), ("  b   a ",), ("",), (" ",), (None,), ("ä z a Z",)]
    assert values(spark, raw, "e string", text.token_sorted(F.col("e"))) == [
        "john smith", "a b", "", "", None, "Z a z ä"]


def test_dates_agree_with_pandas(spark):
    raw = ["2019-03-15T10:00:00Z", "2019-3-5", "2019-02-30", "20190315", "0001-01-01",
           "9999-12-31", "1969-12-31", "2024-02-29", "2023-02-29", "1677-09-21", "1677-09-22",
           "2262-04-11", "2262-04-12", "", "abc", "2019-13-01", "2019-1-12 x", "19-01-01",
           "2019/01/01", "2019-01-01"]
    got = values(spark, [(r,) for r in raw] + [(None,)], "d string", dates.parsed_date(F.col("d")))
    expected = pd.to_datetime(pd.Series(raw + [None]).str[:10], errors="coerce", format="%Y-%m-%d")
    assert got == [None if pd.isna(e) else e.date() for e in expected]


def test_date_flag(spark):
    day = datetime.date
    raw = [(day(1969, 12, 31),), (day(1970, 1, 1),), (day(2024, 5, 1),), (day(2024, 5, 2),), (None,)]
    got = values(spark, raw, "d date", dates.range_flag(F.col("d"), "2024-05-01"))
    assert got == ["out_of_range", "ok", "ok", "out_of_range", "out_of_range"]


def test_amounts(spark):
    raw = ["$85,000", "€1,000", "85000d", "abc", "nan", None, " £1.5e3 ", "-3.", ".5", "", "1_0",
           "inf", "0x10", "1e400"]
    got = values(spark, [(r,) for r in raw], "s string", money.parsed_amount(F.col("s")))
    inf = float("inf")
    assert got == [85000.0, 1000.0, None, None, None, None, 1500.0, -3.0, 0.5, None, 10.0, inf, None, inf]


def test_annual_amount(spark):
    raw = [(100.0, "Monthly", "EUR"), (100.0, "Bi-Weekly", "GBP"), (100.0, "Annual", "USD"),
           (100.0, "Daily", "USD"), (100.0, "Annual", "JPY"), (None, "Annual", "USD"), (1.0, None, "USD")]
    got = values(spark, raw, "a double, f string, c string",
                 money.annual_amount(F.col("a"), F.col("f"), F.col("c")))
    assert got == [100.0 * 12 * 1.08, 100.0 * 26 * 1.27, 100.0, None, None, None, None]


def test_missing_tokens_are_untrimmed(spark):
    got = values(spark, [("NA",), (" NA",), ("",), ("null",), ("x",), (None,)], "t string",
                 text.missing_to_null(F.col("t")))
    assert got == [None, " NA", None, None, "x", None]


def table_lcs(a, b):
    previous = [0] * (len(b) + 1)
    for x in a:
        current = [0]
        for j, y in enumerate(b):
            current.append(previous[j] + 1 if x == y else max(current[-1], previous[j + 1]))
        previous = current
    return previous[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abcd é", max_size=80), st.text("abcd é", max_size=80))
def test_lcs_equals_table(a, b):
    length = similarity._lcs(a, b)
    assert length == table_lcs(a, b) == similarity._lcs(b, a)
    assert length <= min(len(a), len(b))


def test_lcs_and_score_in_spark(spark):
    pairs = [("small ring", "red widget"), ("", ""), ("", "a"), ("abc", "abc"), ("😀a", "a😀")]
    total = F.length("a") + F.length("b")
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    rows = df.select("i", similarity.lcs_length("a", "b").alias("l"), total.alias("t")).withColumn(
        "s", similarity.score(F.col("l"), F.col("t"))).orderBy("i").collect()
    assert [r.l for r in rows] == [3, 0, 0, 3, 1]
    assert [r.s for r in rows] == pytest.approx([30.0, 100.0, 0.0, 100.0, 50.0])


def test_check_label(spark):
    got = values(spark, [("NOT NULL: employee_id",), ("MIN ROW COUNT",), ("GHOST RATE: a: b",)],
                 "c string", text.check_label(F.col("c")))
    assert got == ["emp_id", "MIN ROW COUNT", "a: b"]


def test_tenure(spark):
    got = values(spark, [(datetime.date(2020, 1, 1),), (None,)], "d date",
                 dates.tenure_years(F.col("d"), "2024-01-01"))
    assert got == [1461 / 365.25, None]


def test_rounding_by_exact_value(spark):
    random.seed(2)
    numbers = [(2 * k + 1) / 20000 for k in range(3000)] + [1 - n / 997 for n in range(998)]
    numbers += [random.random() for _ in range(2000)] + [0.00015, 0.03125, 0.09375, 0.5, 1.0, 0.0, -0.00015]
    got = values(spark, [(n,) for n in numbers], "x double", rounding.rounded(F.col("x"), 4))
    assert got == [round(n, 4) for n in numbers]
    got = values(spark, [(n * 100,) for n in numbers], "x double", rounding.rounded(F.col("x"), 1))
    assert got == [round(n * 100, 1) for n in numbers]
