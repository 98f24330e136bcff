"""Counts and rates used by logs, reports and charts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.fixed_values import TOP_COUNTRIES
from tributary.operators.skew import skew_join


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))


def descending(counts: DataFrame, column: str) -> DataFrame:
    return counts.orderBy(F.desc("count"), column)


def ascending(counts: DataFrame, column: str, measure: str = "count") -> DataFrame:
    return counts.orderBy(measure, column)


def top_values(df: DataFrame, column: str, limit: int = TOP_COUNTRIES) -> DataFrame:
    """Most frequent values, in alphabetical order on a tie."""
    return descending(value_counts(df, column), column).limit(limit)


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return df.agg(count.alias("distinct_values"))


def distinct_labels(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def conditional_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One row with the number of rows that fulfil each condition, in one pass."""
    return df.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])


def membership_flag(df: DataFrame, members: DataFrame, key: str, flag: str) -> DataFrame:
    """Adds whether the key occurs among the members; false for a null key."""
    ids = members.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_member", F.lit(True))
    joined = skew_join(df, ids, [key], how="left")
    return joined.withColumn(flag, F.coalesce("_member", F.lit(False))).drop("_member")


def group_rate(df: DataFrame, group: str, flag: str, name: str = "rate") -> DataFrame:
    """Percentage of flagged rows per non-null group."""
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg((F.avg(F.col(flag).cast("int")) * 100).alias(name))
    )


def join_null_safe(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Inner join in which null keys match each other, every pair kept."""
    return skew_join(df, other, [key], null_safe=True)


def removed_by_step(edges: DataFrame, before: DataFrame, after_exact: DataFrame) -> DataFrame:
    """Rows removed by the exact step and by each matching method."""
    exact = (
        before.select(F.lit(1).alias("n")).unionAll(after_exact.select(F.lit(-1)))
        .agg(F.lit("exact_id").alias("step"), F.coalesce(F.sum("n"), F.lit(0)).alias("removed"))
    )
    matched = edges.groupBy(F.col("match_method").alias("step")).agg(F.count("*").alias("removed"))
    return exact.unionByName(matched)


def stage_summary(stages: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named frame, zero for empty ones, as one row."""
    marks = [df.select(F.lit(name).alias("stage")) for name, df in stages.items()]
    union = reduce(lambda a, b: a.unionAll(b), marks)
    return conditional_counts(union, {name: F.col("stage") == name for name in stages})
