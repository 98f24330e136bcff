"""Data behind the six charts of the report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.fixed_values import ENROLLMENT_TARGET, HISTOGRAM_BINS, TOP_COUNTRIES
from tributary.functions.dates import tenure_years
from tributary.functions.text import check_label
from tributary.operators.aggregates import (
    ascending,
    group_rate,
    join_null_safe,
    membership_flag,
    top_values,
    value_counts,
)
from tributary.operators.quantiles import box_outliers, box_statistics, exact_quantiles, histogram
from tributary.staging import stage


def headcount_by_department(golden: DataFrame, column: str = "department") -> DataFrame:
    return ascending(value_counts(golden, column), column)


def headcount_by_country(
    golden: DataFrame, column: str = "country", limit: int = TOP_COUNTRIES
) -> DataFrame:
    return top_values(golden, column, limit)


def paid_rows(
    golden: DataFrame,
    payroll: DataFrame,
    key: str = "employee_id",
    group: str = "employment_type",
    value: str = "salary_usd_annual",
) -> DataFrame:
    """Salary and employment type of every payroll row of a golden record."""
    paid = join_null_safe(payroll.select(key, value), golden.select(key, group), key)
    return paid.select(key, group, value).dropna(subset=[group, value])


def salary_by_employment_type(
    golden: DataFrame,
    payroll: DataFrame,
    key: str = "employee_id",
    group: str = "employment_type",
    value: str = "salary_usd_annual",
) -> DataFrame:
    paid = stage(paid_rows(golden, payroll, key, group, value), "paid")
    return box_statistics(paid, value, group).orderBy(group)


def salary_outliers(golden: DataFrame, payroll: DataFrame, **columns: str) -> DataFrame:
    rows = stage(paid_rows(golden, payroll, **columns), "paid")
    group = columns.get("group", "employment_type")
    value = columns.get("value", "salary_usd_annual")
    return box_outliers(rows, value, group, box_statistics(rows, value, group))


def tenures(golden: DataFrame, as_of=None, column: str = "hire_date") -> DataFrame:
    """Years since the date, without future dates and missing ones."""
    years = golden.select(tenure_years(F.col(column), as_of).alias("tenure_years"))
    return years.where(F.col("tenure_years") >= 0)


def tenure_distribution(
    golden: DataFrame, as_of=None, column: str = "hire_date", bins: int = HISTOGRAM_BINS
) -> DataFrame:
    return histogram(tenures(golden, as_of, column), "tenure_years", bins).orderBy("bin")


def median_tenure(golden: DataFrame, as_of=None, column: str = "hire_date") -> DataFrame:
    median = exact_quantiles(tenures(golden, as_of, column), "tenure_years", [0.5])
    return median.select(F.col("q0").alias("median_years"))


def enrollment_by_department(
    golden: DataFrame,
    benefits: DataFrame,
    key: str = "employee_id",
    group: str = "department",
    target: int = ENROLLMENT_TARGET,
) -> DataFrame:
    flagged = membership_flag(golden.select(key, group), benefits, key, "enrolled")
    rates = group_rate(flagged, group, "enrolled", "enrollment_rate")
    return ascending(rates, group, "enrollment_rate").withColumn("target", F.lit(target))


def quality_summary(report: DataFrame) -> DataFrame:
    return report.select("position", check_label(F.col("check")).alias("label"), "passed", "failed")
