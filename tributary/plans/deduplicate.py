"""Three dedup passes, provenance and ghosts in one job."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.fixed_values import (
    CANDIDATE_LIMIT,
    CANDIDATE_SCORE,
    DATE_WINDOW_DAYS,
    MATCH_SCORE,
    ROSTER_A,
    ROSTER_B,
    SOURCE_PRIORITY,
)
from tributary.operators.dedup import (
    annotate_provenance,
    drop_rows,
    exact_dedup,
    priority_dedup,
    priority_edges,
)
from tributary.operators.linkage import linkage_rows, linked_rows, match_edges, review_list
from tributary.operators.reconcile import ghosts
from tributary.staging import stage


class DedupResult(NamedTuple):
    golden: DataFrame
    review: DataFrame
    ghosts: DataFrame
    edges: DataFrame
    distinct_ids: DataFrame


def fuzzy_step(
    df: DataFrame,
    left_source: str = ROSTER_B,
    right_source: str = ROSTER_A,
    cutoff: int = CANDIDATE_SCORE,
    limit: int = CANDIDATE_LIMIT,
    match_score: int = MATCH_SCORE,
    window_days: int = DATE_WINDOW_DAYS,
    **columns: str,
) -> DataFrame:
    """Left-source rows with candidates among the right source, written once."""
    left = linkage_rows(df.where(F.col("source") == left_source), **columns)
    right = linkage_rows(df.where(F.col("source") == right_source), **columns)
    return stage(linked_rows(left, right, cutoff, limit, match_score, window_days), "linked")


def deduplicate(
    roster: DataFrame,
    payroll: DataFrame,
    order: str = "_ord",
    priorities: dict = SOURCE_PRIORITY,
    left_source: str = ROSTER_B,
    right_source: str = ROSTER_A,
) -> DedupResult:
    """Golden rows, review list, ghosts and match edges of a cleaned roster.

    Each pass feeds several consumers, so its result is written once to the
    shared folder.  `golden` keeps the order column for its consumers.
    """
    distinct_ids = stage(exact_dedup(roster, order=order), "distinct-ids")
    by_email = stage(priority_dedup(distinct_ids, order=order, priorities=priorities), "by-email")
    email_edges = priority_edges(distinct_ids, order=order, priorities=priorities)
    linked = fuzzy_step(by_email, left_source, right_source, order=order)
    edges = stage(email_edges.unionByName(match_edges(linked)), "edges")
    matched = linked.where(F.col("match").isNotNull()).select(F.col("ord").alias(order))
    golden = stage(annotate_provenance(drop_rows(by_email, matched, order), edges), "golden")
    return DedupResult(golden, review_list(linked), ghosts(payroll, golden), edges, distinct_ids)
