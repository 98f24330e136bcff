"""Golden table, ghost and review reports, quality report as CSV and HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.fixed_values import (
    FAIL_COLOUR,
    GHOST_FILE,
    GHOST_NAME,
    GHOST_REASON,
    GOLDEN_FOLDER,
    PASS_COLOUR,
    REPORT_FILE,
    REPORT_PAGE,
    REVIEW_FILE,
)
from tributary.operators.aggregates import value_counts
from tributary.operators.linkage import recommended_action
from tributary.operators.quality import REPORT_COLUMNS

INTERNAL_COLUMNS = ("hire_date_flag", "_ord")

_STYLE = (
    "body{font-family:sans-serif;margin:2em} table{border-collapse:collapse} "
    "th,td{padding:6px 10px;text-align:left;border-bottom:1px solid #ccc}"
)


def plain_number(number: Column) -> Column:
    """A double as text without an exponent, `85000.0` for whole numbers."""
    digits = F.regexp_replace(number.cast("decimal(38,16)").cast("string"), "0+$", "")
    return F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)


def golden_table(golden: DataFrame) -> DataFrame:
    """Without helper columns, the date as a timestamp without zone."""
    hire_date = F.col("hire_date").try_cast("timestamp_ntz")
    return golden.drop(*INTERNAL_COLUMNS).withColumn("hire_date", hire_date)


def write_golden(golden: DataFrame, folder: str, even_files: bool = False) -> str:
    """Parquet by company; partitions that the new data lacks are left alone.

    `even_files` adds a shuffle that levels file sizes within large partitions.
    """
    path = f"{folder}/{GOLDEN_FOLDER}"
    table = golden_table(golden)
    if even_files:
        table = table.hint("rebalance", "company_origin")
    (
        table.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("company_origin")
        .parquet(path)
    )
    return path


def ghost_report(ghosts: DataFrame, key: str = "employee_id", salary: str = "salary_usd_annual"):
    amount = F.col(salary) if salary in ghosts.columns else F.lit(None).cast("double")
    return ghosts.select(
        F.col(key).alias("payroll_employee_id"),
        F.lit(GHOST_NAME).alias("name"),
        amount.alias("salary_usd_annual"),
        F.lit(GHOST_REASON).alias("ghost_flag_reason"),
    )


def review_report(review: DataFrame) -> DataFrame:
    """Scores rounded half to even at one digit."""
    return review.select(
        F.col("gt_employee_id").alias("record_1_id"),
        F.col("ac_employee_id").alias("record_2_id"),
        (F.rint(F.col("name_score") * 10) / 10).alias("similarity_score"),
        F.col("date_diff_days").alias("hire_date_diff_days"),
        recommended_action(F.col("name_score")).alias("recommended_action"),
    )


def action_counts(report: DataFrame) -> DataFrame:
    return value_counts(report, "recommended_action")


def _write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')
    return path


def write_ghost_report(ghosts: DataFrame, folder: str) -> str | None:
    """Nothing is written when there are none."""
    report = ghost_report(ghosts)
    if report.isEmpty():
        return None
    shown = report.withColumn("salary_usd_annual", plain_number(F.col("salary_usd_annual")))
    return _write_csv(shown, f"{folder}/{GHOST_FILE}")


def write_review_report(review: DataFrame, folder: str) -> str | None:
    """Nothing is written when there are none."""
    report = review_report(review)
    if report.isEmpty():
        return None
    return _write_csv(report, f"{folder}/{REVIEW_FILE}")


def write_quality_report(report: DataFrame, folder: str) -> str:
    """One file: a report has one row per check."""
    ordered = report.coalesce(1).sortWithinPartitions("position").select(*REPORT_COLUMNS)
    return _write_csv(ordered, f"{folder}/{REPORT_FILE}")


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def quality_page(report: DataFrame) -> DataFrame:
    """The report as one HTML text: counts, then a coloured row per check."""
    colour = F.when(F.col("status") == "PASS", PASS_COLOUR).otherwise(FAIL_COLOUR)
    line = F.format_string(
        '<tr style="background:%s"><td>%s</td><td><b>%s</b></td><td>%.1f%%</td>'
        "<td>%d / %d</td><td>%s</td></tr>",
        colour, _escaped(F.col("check")), F.col("status"), F.col("pass_rate") * 100,
        F.col("failed"), F.col("total"), _escaped(F.col("description")),
    )
    rows = F.array_sort(F.collect_list(F.struct("position", line.alias("line"))))
    passed, failed = F.count_if(F.col("status") == "PASS"), F.count_if(F.col("status") == "FAIL")
    head = (
        '<!DOCTYPE html>\n<html lang="en"><head><meta charset="UTF-8">'
        f"<title>Data quality report</title><style>{_STYLE}</style></head>\n"
        "<body><h1>Data quality report</h1>\n<p>Total checks: "
    )
    columns = ("Check", "Status", "Pass Rate", "Failed / Total", "Description")
    table = "<table><thead><tr>" + "".join(f"<th>{c}</th>" for c in columns) + "</tr></thead>\n<tbody>\n"
    return report.agg(F.concat(
        F.lit(head), F.count("*").cast("string"),
        F.lit(" | Passed: "), passed.cast("string"),
        F.lit(" | Failed: "), failed.cast("string"),
        F.lit("</p>\n" + table),
        F.array_join(F.transform(rows, lambda entry: entry["line"]), "\n"),
        F.lit("\n</tbody></table></body></html>"),
    ).alias("value"))


def write_quality_page(report: DataFrame, folder: str) -> str:
    path = f"{folder}/{REPORT_PAGE}"
    quality_page(report).write.mode("overwrite").text(path)
    return path


def export_all(golden: DataFrame, review: DataFrame, ghosts: DataFrame, folder: str) -> dict:
    """Write the deliverables; `None` marks a report that had no rows."""
    return {
        "golden": write_golden(golden, folder),
        "ghosts": write_ghost_report(ghosts, folder),
        "review": write_review_report(review, folder),
    }
