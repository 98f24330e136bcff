"""Cleaning of roster, payroll and benefits records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.fixed_values import COMPANY_A, DEPARTMENTS, FREQUENCY_MULTIPLIER, USD_RATE
from tributary.functions.dates import parsed_date, range_flag
from tributary.functions.ids import namespaced_id
from tributary.functions.money import annual_amount, parsed_amount
from tributary.functions.text import clean_name, full_name


def namespace_ids(
    df: DataFrame,
    columns: tuple[str, ...] = ("employee_id", "manager_id"),
    origin: str = "company_origin",
) -> DataFrame:
    """Prefix ids by company; a frame without the origin column stays as it is."""
    if origin not in df.columns:
        return df
    return df.withColumns({name: namespaced_id(F.col(name), F.col(origin)) for name in columns})


def clean_names(
    df: DataFrame,
    first: str = "first_name",
    last: str = "last_name",
    full: str = "employee_name",
) -> DataFrame:
    tidied = df.withColumns({first: clean_name(F.col(first)), last: clean_name(F.col(last))})
    return tidied.withColumn(full, full_name(F.col(first), F.col(last)))


def standardize_dates(df: DataFrame, column: str = "hire_date", as_of=None) -> DataFrame:
    parsed = df.withColumn(column, parsed_date(F.col(column)))
    return parsed.withColumn(f"{column}_flag", range_flag(F.col(column), as_of))


def unknown_categories(
    df: DataFrame,
    column: str = "department",
    key: str = "employee_id",
    known: list[str] = DEPARTMENTS,
) -> DataFrame:
    """Id and value of the rows with a non-null value outside the list."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(known)).select(key, column)


def unknown_categories_from(df: DataFrame, column: str, key: str, known: DataFrame) -> DataFrame:
    """The same with a one-column table of known values."""
    values = known.select(F.col(known.columns[0]).alias(column))
    return df.where(F.col(column).isNotNull()).select(key, column).join(values, column, "left_anti")


def clean_roster(df: DataFrame, as_of=None) -> DataFrame:
    """Ids, names and dates of the stacked roster."""
    return standardize_dates(clean_names(namespace_ids(df)), as_of=as_of)


def clean_payroll(
    df: DataFrame,
    multipliers: dict = FREQUENCY_MULTIPLIER,
    rates: dict = USD_RATE,
) -> DataFrame:
    """Annual salary in USD next to the original columns, and namespaced ids."""
    salary = annual_amount(
        parsed_amount(F.col("base_salary")),
        F.col("pay_frequency"),
        F.col("currency"),
        multipliers,
        rates,
    )
    return namespace_ids(df.withColumn("salary_usd_annual", salary), ("employee_id",))


def clean_benefits(df: DataFrame) -> DataFrame:
    """All ids belong to company A."""
    return df.withColumn("employee_id", namespaced_id(F.col("employee_id"), F.lit(COMPANY_A)))
