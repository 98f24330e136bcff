import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.operators import aggregates as ag
from tributary.operators import quantiles
from tributary.plans import charts


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_counts(spark, rows_of):
    df = frame(spark, [("a",), ("b",), ("b",), (None,), ("c",), ("c",)], "v string")
    assert rows_of(ag.value_counts(df, "v")) == [("a", 1), ("b", 2), ("c", 2)]
    assert [r.v for r in ag.top_values(df, "v", 2).collect()] == ["b", "c"]
    assert [r.v for r in charts.headcount_by_department(df, "v").collect()] == ["a", "b", "c"]
    assert [r.v for r in ag.distinct_labels(df, "v").collect()] == ["a", "b", "c"]
    assert ag.distinct_count(df, "v").first()[0] == 3
    assert ag.distinct_count(df, "v", approximate=True).first()[0] == 3
    counted = ag.conditional_counts(df, {"nulls": F.col("v").isNull(), "bs": F.col("v") == "b"})
    assert rows_of(counted) == [(1, 2)]


def test_membership_and_rate(spark, rows_of):
    df = frame(spark, [("1", "x"), ("2", "x"), (None, "x"), ("4", "y"), ("1", None)], "k string, g string")
    members = frame(spark, [("1",), ("1",), (None,), ("9",)], "k string")
    flagged = ag.membership_flag(df, members, "k", "in")
    assert rows_of(flagged) == sorted(
        [("1", "x", True), ("2", "x", False), (None, "x", False), ("4", "y", False), ("1", None, True)], key=repr)
    rates = charts.enrollment_by_department(df, members, "k", "g").collect()
    assert [(r.g, round(r.enrollment_rate, 6), r.target) for r in rates] == [
        ("y", 0.0, 80), ("x", 33.333333, 80)]


def test_summary_and_removed(spark, rows_of):
    summary = ag.stage_summary({"a": spark.range(5), "b": spark.range(0), "c": spark.range(2)})
    assert rows_of(summary) == [(5, 0, 2)]
    edges = frame(spark, [("exact_email",), ("exact_email",), ("fuzzy_name_date",)], "match_method string")
    removed = ag.removed_by_step(edges, spark.range(9), spark.range(7))
    assert rows_of(removed) == [("exact_email", 2), ("exact_id", 2), ("fuzzy_name_date", 1)]
    assert rows_of(ag.removed_by_step(edges.where("false"), spark.range(0), spark.range(0))) == [("exact_id", 0)]


@pytest.mark.parametrize("cells", [1 << 14, 5])
def test_quantiles_equal_numpy(spark, monkeypatch, cells):
    """Also with few cells a round, so that many rounds are needed."""
    monkeypatch.setattr(quantiles, "_CELLS", cells)
    random.seed(3)
    data = {g: [random.choice([random.gauss(0, 9), float(random.randint(0, 3))]) for _ in range(n)]
            for g, n in (("a", 1), ("b", 2), ("c", 3), ("d", 4), ("e", 1003), ("f", 2000))}
    data["g"] = [7.0] * 500
    df = frame(spark, [(g, v) for g, vs in data.items() for v in vs] + [("a", None), (None, 5.0)],
               "g string, v double").repartition(4)
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r.g: r for r in quantiles.exact_quantiles(df, "v", probabilities, ("g",)).collect()}
    assert set(got) == set(data)
    for g, vs in data.items():
        expected = np.percentile(vs, [p * 100 for p in probabilities])
        assert [got[g][f"q{i}"] for i in range(6)] == pytest.approx(list(expected), rel=1e-12, abs=1e-12)
        assert got[g]["n"] == len(vs)
    whole = quantiles.exact_quantiles(df.where("g is not null"), "v", [0.5]).first()
    assert whole["q0"] == pytest.approx(np.median(sum(data.values(), [])))
    assert quantiles.exact_quantiles(df.where("false"), "v", [0.5]).count() == 0


def test_quantiles_of_far_apart_values(spark):
    """Both signs, zeros, infinities and the smallest and largest doubles; nothing is ordered but cells."""
    values = [-np.inf, -1.7e308, -3.5, -3.0, -2.0**-1074, -0.0, 0.0, 2.0**-1074, 2.0**-1022, 1.0, 1.0 + 2.0**-52, 1.5, 2.0, 1e300, 1.7e308, np.inf]
    values += [None, float("nan")]
    df = frame(spark, [(v,) for v in values], "v double")
    shares = [i / 15 for i in range(16)]
    got = quantiles.exact_quantiles(df, "v", shares).first()
    ranks = [int(np.floor(p * 15)) for p in shares]
    exact = [i for i, (p, r) in enumerate(zip(shares, ranks, strict=True)) if p * 15 == r]
    assert len(exact) > 12 and [got[f"q{i}"] for i in exact if 0 < i < 15] == [values[i] for i in exact if 0 < i < 15]
    plan = quantiles.exact_quantiles(df, "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "percentile" not in plan


def test_box_statistics(spark, rows_of):
    data = {"one": [5.0], "same": [3.0] * 4, "far": [1.0, 2.0, 3.0, 4.0, 100.0, 100.0, -90.0],
            "gap": [0.0, 10.0, 10.0, 10.0, 20.0]}
    df = frame(spark, [(g, v) for g, vs in data.items() for v in vs], "g string, v double")
    boxes = {r.g: tuple(r)[1:] for r in quantiles.box_statistics(df, "v", "g").collect()}
    for g, vs in data.items():
        x = np.array(vs)
        q1, med, q3 = np.percentile(x, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = x[(x >= low) & (x <= high)]
        assert boxes[g] == pytest.approx(
            (len(vs), min(inside.min(), q1), q1, med, q3, max(inside.max(), q3), len(x) - len(inside)))
    outliers = quantiles.box_outliers(df, "v", "g", quantiles.box_statistics(df, "v", "g"))
    assert rows_of(outliers) == [("far", -90.0), ("gap", 0.0), ("gap", 20.0)]


@pytest.mark.parametrize("values", [
    [1.0], [2.0, 2.0], [0.0, 1.0, 0.05, 0.5, 0.95, 0.15, 0.3, 0.35], [i / 365.25 for i in range(900)],
    [0.1 * i for i in range(61)], [-3.0, 7.1, 7.1, 7.0999],
])
def test_histogram_equals_numpy(spark, values):
    got = quantiles.histogram(frame(spark, [(v,) for v in values] + [(None,)], "v double"), "v").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=20)
    assert [r["count"] for r in got] == list(counts)
    assert [r.bin_low for r in got] + [got[-1].bin_high] == pytest.approx(list(edges))


def test_tenure(spark, rows_of):
    day = datetime.date
    df = frame(spark, [(day(2020, 1, 1),), (day(2024, 1, 1),), (day(2024, 1, 2),), (None,), (day(2010, 1, 1),)],
               "hire_date date")
    years = sorted(r.tenure_years for r in charts.tenures(df, "2024-01-01").collect())
    assert years == [0.0, 1461 / 365.25, 5113 / 365.25]
    assert rows_of(charts.median_tenure(df, "2024-01-01")) == [(1461 / 365.25,)]
    bins = charts.tenure_distribution(df, "2024-01-01").collect()
    assert [r.bin for r in bins] == list(range(1, 21)) and sum(r["count"] for r in bins) == 3


def test_salary_chart_matches_null_ids(spark, rows_of):
    golden = frame(spark, [("a", "Full-Time"), (None, "Part-Time"), ("c", None)], "employee_id string, employment_type string")
    payroll = frame(spark, [("a", 10.0), ("a", 20.0), (None, 5.0), (None, 7.0), ("c", 1.0), ("d", 1.0), ("a", None)],
                    "employee_id string, salary_usd_annual double")
    assert rows_of(charts.paid_rows(golden, payroll), "employment_type", "salary_usd_annual") == [
        ("Full-Time", 10.0), ("Full-Time", 20.0), ("Part-Time", 5.0), ("Part-Time", 7.0)]
    boxes = charts.salary_by_employment_type(golden, payroll).collect()
    assert [(r.employment_type, r.n, r.median) for r in boxes] == [("Full-Time", 2, 15.0), ("Part-Time", 2, 6.0)]
    assert charts.salary_by_employment_type(golden, payroll.where("false")).count() == 0
    assert charts.salary_outliers(golden, payroll).count() == 0
