"""Declarative quality checks, their report and the gate.

All checks but uniqueness are measured in a single aggregation without
shuffling rows; all uniqueness checks together take one more.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.fixed_values import (
    CHECK_TEXTS,
    DEPARTMENTS,
    EMAIL_PATTERN,
    FIRST_DATE,
    GHOST_LIMIT,
    ID_PATTERN,
    MAX_FAILED_CHECKS,
    MIN_GOLDEN_ROWS,
    QUALITY_THRESHOLD,
)
from tributary.functions.dates import as_of_date
from tributary.functions.rounding import rounded

REPORT_COLUMNS = ["check", "description", "total", "passed", "failed", "pass_rate", "status"]


class QualityGateError(RuntimeError):
    """More checks failed than the gate allows."""


@dataclass(frozen=True)
class Check:
    """A check: aggregates it measures and how they turn into a report row.

    `measures` maps names to aggregate columns, `constants` to columns that need no
    aggregation; `outcome` gets both by these names and the pass threshold.
    `unique` names the column of a uniqueness check, measured by grouping instead.
    """

    label: str
    description: str
    outcome: object
    measures: dict[str, Column] = field(default_factory=dict)
    constants: dict[str, Column] = field(default_factory=dict)
    unique: str | None = None
    threshold: float | None = None


def _verdict(passes: Column) -> Column:
    return F.when(passes, "PASS").otherwise("FAIL")


def _by_threshold(measured: dict[str, Column], threshold: float) -> dict[str, Column]:
    failed, total = measured["failed"], measured["total"]
    rate = F.when(total > 0, 1 - failed / total).otherwise(F.lit(1.0))
    return {
        "total": total,
        "passed": total - failed,
        "failed": failed,
        "rate": rate,
        "status": _verdict(rate >= threshold),
    }


def _column_check(kind, column, description, fails: Column, only_filled=True, threshold=None):
    total = F.count(F.col(column)) if only_filled else F.count("*")
    label = f"{kind}: {column}"
    return Check(label, description, _by_threshold, {"failed": F.count_if(fails), "total": total},
                 threshold=threshold)


def not_null(column: str, description: str, threshold: float | None = None) -> Check:
    return _column_check("NOT NULL", column, description, F.col(column).isNull(), False, threshold)


def unique(column: str, description: str, threshold: float | None = None) -> Check:
    return Check(f"UNIQUE: {column}", description, _by_threshold, unique=column, threshold=threshold)


def matches(column: str, pattern: str, description: str, threshold: float | None = None) -> Check:
    """The pattern is anchored at the start and knows Unicode classes."""
    fits = F.col(column).cast("string").rlike(f"(?U)^(?:{pattern})")
    return _column_check("REGEX", column, description, ~fits, threshold=threshold)


def in_set(column: str, values: list, description: str, threshold: float | None = None) -> Check:
    return _column_check(
        "VALUES IN SET", column, description, ~F.col(column).isin(list(values)), threshold=threshold
    )


def date_range(column: str, first: str, last, description: str, threshold: float | None = None) -> Check:
    """Both ends belong to the range; without `last` it ends today."""
    inside = F.col(column).between(F.lit(first).cast("date"), as_of_date(last))
    return _column_check("DATE RANGE", column, description, ~inside, threshold=threshold)


def flag_rate(column: str, flag: str, max_rate: float, description: str) -> Check:
    """Fails if the share of rows with the flag exceeds `max_rate`."""

    def outcome(measured, _threshold):
        flagged, total = measured["flagged"], measured["total"]
        rate = F.when(total > 0, flagged / total).otherwise(F.lit(0.0))
        exceeded = rate > max_rate
        return {
            "total": total,
            "passed": F.when(exceeded, 0).otherwise(total - flagged),
            "failed": F.when(exceeded, flagged).otherwise(0),
            "rate": 1 - rate,
            "status": _verdict(~exceeded),
        }

    measures = {"flagged": F.count_if(F.col(column) == flag), "total": F.count("*")}
    return Check(f"FLAG RATE: {column}={flag}", description, outcome, measures)


def column_present(df: DataFrame, column: str, description: str) -> Check:
    present = column in df.columns

    def outcome(_measured, _threshold):
        return {
            "total": F.lit(1),
            "passed": F.lit(int(present)),
            "failed": F.lit(int(not present)),
            "rate": F.lit(float(present)),
            "status": _verdict(F.lit(present)),
        }

    return Check(f"COLUMN PRESENT: {column}", description, outcome)


def min_row_count(minimum: int, description: str) -> Check:
    """The number of failed rows is what is missing."""

    def outcome(measured, _threshold):
        total = measured["total"]
        enough = total >= minimum
        return {
            "total": total,
            "passed": F.when(enough, total).otherwise(0),
            "failed": F.when(enough, 0).otherwise(minimum - total),
            "rate": F.when(enough, 1.0).otherwise(total / minimum),
            "status": _verdict(enough),
        }

    return Check("MIN ROW COUNT", description, outcome, {"total": F.count("*")})


def ghost_rate(ghosts: DataFrame | None, description: str, limit: float = GHOST_LIMIT) -> Check:
    """Ghosts as a share of ghosts and golden rows together."""
    counted = F.lit(0) if ghosts is None else ghosts.agg(F.count("*")).scalar()

    def outcome(measured, _threshold):
        golden, ghost_count = measured["golden"], measured["ghosts"]
        total = golden + ghost_count
        rate = F.when(total > 0, ghost_count / total).otherwise(F.lit(0.0))
        breached = rate >= limit
        return {
            "total": total,
            "passed": F.when(breached, 0).otherwise(golden),
            "failed": F.when(breached, ghost_count).otherwise(0),
            "rate": 1 - rate,
            "status": _verdict(~breached),
        }

    return Check(
        "GHOST RATE: payroll vs HRIS", description, outcome,
        {"golden": F.count("*")}, {"ghosts": counted},
    )


def _report_row(position: int, check: Check, measured: dict[str, Column], threshold: float):
    outcome = check.outcome(measured, threshold if check.threshold is None else check.threshold)
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(check.label).alias("check"),
        F.lit(check.description).alias("description"),
        *[outcome[name].cast("bigint").alias(name) for name in ("total", "passed", "failed")],
        outcome["rate"].cast("double").alias("rate"),
        outcome["status"].alias("status"),
    )


def _duplicates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Non-null rows and surplus copies of each column, as one row of numbers."""
    values = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("column"), F.col(c).cast("string").alias("value"))
        for i, c in enumerate(columns)
    ])).alias("entry")).select("entry.*").where("value is not null")
    groups = values.groupBy("column", "value").agg(F.count("*").alias("size"))
    measures = []
    for i, _ in enumerate(columns):
        mine = F.when(F.col("column") == i, F.col("size"))
        measures.append(F.coalesce(F.sum(mine), F.lit(0)).alias(f"u{i}_total"))
        measures.append(F.coalesce(F.sum(mine - 1), F.lit(0)).alias(f"u{i}_failed"))
    return groups.agg(*measures)


def quality_report(
    df: DataFrame, checks: list[Check], threshold: float = QUALITY_THRESHOLD
) -> DataFrame:
    """One row per check in the order given, with a leading `position`."""
    plain = [(i, c) for i, c in enumerate(checks, start=1) if c.unique is None]
    uniques = [(i, c) for i, c in enumerate(checks, start=1) if c.unique is not None]
    frames = []
    if plain:
        measures = [
            column.alias(f"m{i}_{name}") for i, c in plain for name, column in c.measures.items()
        ] or [F.count("*")]
        constants = {f"m{i}_{name}": column for i, c in plain for name, column in c.constants.items()}
        rows = []
        for i, c in plain:
            names = (*c.measures, *c.constants)
            rows.append(_report_row(i, c, {name: F.col(f"m{i}_{name}") for name in names}, threshold))
        frames.append(df.agg(*measures).withColumns(constants).select(F.inline(F.array(*rows))))
    if uniques:
        columns = sorted({c.unique for _, c in uniques})
        rows = []
        for i, c in uniques:
            at = columns.index(c.unique)
            measured = {"failed": F.col(f"u{at}_failed"), "total": F.col(f"u{at}_total")}
            rows.append(_report_row(i, c, measured, threshold))
        frames.append(_duplicates(df, columns).select(F.inline(F.array(*rows))))
    report = frames[0]
    for frame in frames[1:]:
        report = report.unionByName(frame)
    rate = rounded(F.col("rate"), 4).alias("pass_rate")
    return report.select("position", *[rate if c == "pass_rate" else c for c in REPORT_COLUMNS])


def standard_checks(golden: DataFrame, ghosts: DataFrame | None, as_of=None) -> list[Check]:
    """The fifteen checks of the golden table, in report order."""
    text = CHECK_TEXTS
    return [
        not_null("employee_id", text["NOT NULL: employee_id"]),
        unique("employee_id", text["UNIQUE: employee_id"]),
        matches("employee_id", ID_PATTERN, text["REGEX: employee_id"]),
        not_null("first_name", text["NOT NULL: first_name"]),
        not_null("last_name", text["NOT NULL: last_name"]),
        not_null("email", text["NOT NULL: email"]),
        matches("email", EMAIL_PATTERN, text["REGEX: email"]),
        unique("email", text["UNIQUE: email"]),
        not_null("hire_date", text["NOT NULL: hire_date"]),
        date_range("hire_date", FIRST_DATE, as_of, text["DATE RANGE: hire_date"]),
        not_null("department", text["NOT NULL: department"]),
        in_set("department", DEPARTMENTS, text["VALUES IN SET: department"]),
        column_present(golden, "source_systems", text["COLUMN PRESENT: source_systems"]),
        min_row_count(MIN_GOLDEN_ROWS, text["MIN ROW COUNT"]),
        ghost_rate(ghosts, text["GHOST RATE: payroll vs HRIS"]),
    ]


def all_passed(report: DataFrame) -> DataFrame:
    """One row; true for an empty report."""
    passed = F.coalesce(F.bool_and(F.col("status") == "PASS"), F.lit(True))
    return report.agg(passed.alias("all_passed"))


def gate_result(report: DataFrame, max_failures: int = MAX_FAILED_CHECKS) -> DataFrame:
    """One row: number of checks, failed checks, and whether the gate lets pass."""
    failed = F.count_if(F.col("status") == "FAIL")
    return report.agg(
        F.count("*").alias("checks"),
        failed.alias("failed_checks"),
        (failed <= max_failures).alias("gate_open"),
    )


def enforce_gate(report: DataFrame, max_failures: int = MAX_FAILED_CHECKS) -> None:
    """Raise if too many checks failed; call it after the report is written."""
    row = gate_result(report, max_failures).first()
    if not row["gate_open"]:
        raise QualityGateError(
            f"{row['failed_checks']} of {row['checks']} checks failed, at most {max_failures} may"
        )
