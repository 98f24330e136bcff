"""The whole job: sources, cleaning, dedup, checks, charts and files."""

from __future__ import annotations

import time
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tributary.fixed_values import (
    CANONICAL_COLUMNS,
    MAX_FAILED_CHECKS,
    NESTED_RENAMES,
    ROSTER_A,
    ROSTER_B,
)
from tributary.operators.aggregates import stage_summary
from tributary.operators.clean import clean_benefits, clean_payroll, clean_roster
from tributary.operators.conform import conform, stack
from tributary.operators.quality import enforce_gate, quality_report, standard_checks
from tributary.plans import charts
from tributary.plans.deduplicate import DedupResult, deduplicate
from tributary.sinks.exports import export_all, write_quality_page, write_quality_report
from tributary.sources.readers import read_delimited, read_nested, read_tagged, read_workbooks
from tributary.staging import stage


class Inputs(NamedTuple):
    roster: DataFrame
    payroll: DataFrame
    benefits: DataFrame
    dead_letters: DataFrame
    schema_issues: DataFrame


class PipelineResult(NamedTuple):
    dedup: DedupResult
    report: DataFrame
    charts: dict[str, DataFrame]
    summary: dict[str, float]
    files: dict[str, str | None]
    inputs: Inputs


def read_inputs(
    spark: SparkSession,
    roster_csv: str,
    roster_json: str,
    payroll_xlsx: str,
    benefits_xml: str,
    csv_multi_line: bool = True,
    json_multi_line: bool = True,
) -> Inputs:
    """Both rosters conformed and stacked; payroll and benefits as they are.

    The flags go to the readers: without them large files can be split.
    """
    first = read_delimited(spark, roster_csv, multi_line=csv_multi_line)
    second = read_nested(spark, roster_json, multi_line=json_multi_line)
    payroll = read_workbooks(spark, payroll_xlsx)
    benefits = read_tagged(spark, benefits_xml)
    roster = stack([
        conform(first.rows, ROSTER_A, keep=("_ord",)),
        conform(second.rows, ROSTER_B, NESTED_RENAMES, keep=("_ord",)),
    ])
    reads = (first, second, payroll, benefits)
    return Inputs(
        roster.select(*CANONICAL_COLUMNS, "_ord"),
        payroll.rows,
        benefits.rows,
        stack([read.dead_letters for read in reads]),
        stack([read.schema_issues for read in reads]),
    )


def chart_feeds(golden, payroll, benefits, report, as_of=None) -> dict[str, DataFrame]:
    return {
        "headcount_by_department": charts.headcount_by_department(golden),
        "headcount_by_country": charts.headcount_by_country(golden),
        "salary_by_employment_type": charts.salary_by_employment_type(golden, payroll),
        "salary_outliers": charts.salary_outliers(golden, payroll),
        "tenure_distribution": charts.tenure_distribution(golden, as_of),
        "median_tenure": charts.median_tenure(golden, as_of),
        "enrollment_by_department": charts.enrollment_by_department(golden, benefits),
        "quality_summary": charts.quality_summary(report),
    }


def run_pipeline(
    spark: SparkSession,
    roster_csv: str,
    roster_json: str,
    payroll_xlsx: str,
    benefits_xml: str,
    folder: str,
    as_of=None,
    max_failures: int = MAX_FAILED_CHECKS,
    csv_multi_line: bool = True,
    json_multi_line: bool = True,
) -> PipelineResult:
    """Run everything and write the deliverables to `folder`.

    The quality files are written before the gate; a closed gate raises before
    charts and exports.
    """
    started = time.monotonic()
    inputs = read_inputs(
        spark, roster_csv, roster_json, payroll_xlsx, benefits_xml, csv_multi_line, json_multi_line
    )
    roster = stage(clean_roster(inputs.roster, as_of), "roster")
    payroll = stage(clean_payroll(inputs.payroll), "payroll")
    benefits = clean_benefits(inputs.benefits)

    dedup = deduplicate(roster, payroll)
    dedup = dedup._replace(ghosts=stage(dedup.ghosts, "ghosts"))
    checks = standard_checks(dedup.golden, dedup.ghosts, as_of)
    report = stage(quality_report(dedup.golden, checks), "report")
    files = {
        "report": write_quality_report(report, folder),
        "page": write_quality_page(report, folder),
    }
    enforce_gate(report, max_failures)

    feeds = chart_feeds(dedup.golden, payroll, benefits, report, as_of)
    files |= export_all(dedup.golden, dedup.review, dedup.ghosts, folder)
    stages = {
        "input_records": roster,
        "golden_records": dedup.golden,
        "review_candidates": dedup.review,
        "ghost_records": dedup.ghosts,
        "checks_passed": report.where("status = 'PASS'"),
        "checks": report,
    }
    summary = stage_summary(stages).first().asDict()
    summary["duration_seconds"] = round(time.monotonic() - started, 1)
    return PipelineResult(dedup, report, feeds, summary, files, inputs)
