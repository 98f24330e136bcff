"""Duplicates by exact key, merges by shared key, and their provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.fixed_values import (
    LOWEST_PRIORITY,
    METHOD_EMAIL,
    METHOD_FUZZY,
    METHOD_UNIQUE,
    SOURCE_PRIORITY,
)
from tributary.functions.text import mapped, match_key
from tributary.operators.skew import skew_join

EDGE_COLUMNS = [
    "keeper_id", "keeper_source", "dropped_id", "dropped_source", "match_method", "match_score",
]


def exact_dedup(df: DataFrame, key: str = "employee_id", order: str = "_ord") -> DataFrame:
    """First row of each key; null is one key like any other.

    Spark keeps one row per key and task before the shuffle (window group
    limit), so a key that holds most rows does not travel.
    """
    first = Window.partitionBy(key).orderBy(order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def shared_key_rows(df: DataFrame, key: str, order: str = "_ord") -> DataFrame:
    """Rows whose non-null normalised key occurs more than once."""
    keyed = df.withColumn("_key", match_key(F.col(key)))
    shared = (
        keyed.where(F.col("_key").isNotNull())
        .groupBy("_key").agg(F.count("*").alias("_size")).where("_size > 1").select("_key")
    )
    return skew_join(keyed, shared, ["_key"], "left_semi").drop("_key")


def source_priority(source: Column, priorities: dict = SOURCE_PRIORITY) -> Column:
    return F.coalesce(mapped(source, priorities), F.lit(LOWEST_PRIORITY))


def _ranked_by_priority(df, key, order, source, priorities):
    return df.withColumns(
        {"_key": match_key(F.col(key)), "_priority": source_priority(F.col(source), priorities)}
    )


def priority_dedup(
    df: DataFrame,
    key: str = "email",
    order: str = "_ord",
    source: str = "source",
    priorities: dict = SOURCE_PRIORITY,
) -> DataFrame:
    """Per normalised key the row of the best source, the earlier one on a tie.

    Rows without a key stay; their order value takes the place of the key, so
    they do not meet in one partition.
    """
    ranked = _ranked_by_priority(df, key, order, source, priorities)
    alone = F.when(F.col("_key").isNull(), F.col(order))
    best = Window.partitionBy("_key", alone).orderBy("_priority", order)
    kept = ranked.withColumn("_rank", F.row_number().over(best)).where("_rank = 1")
    return kept.select(*df.columns)


def priority_edges(
    df: DataFrame,
    key: str = "email",
    order: str = "_ord",
    row_id: str = "employee_id",
    source: str = "source",
    priorities: dict = SOURCE_PRIORITY,
) -> DataFrame:
    """One edge per row that priority_dedup drops, from its keeper.

    Keepers are aggregated first, with partial results before the shuffle; the
    rows then look theirs up in a join that splits hot keys.
    """
    ranked = _ranked_by_priority(df, key, order, source, priorities).select(
        "_key", "_priority", F.col(order).alias("_ord"), F.col(row_id).alias("_id"),
        F.col(source).alias("_source"),
    ).where(F.col("_key").isNotNull())
    keepers = (
        ranked.groupBy("_key")
        .agg(
            F.min(F.struct("_priority", "_ord", "_id", "_source")).alias("_keeper"),
            F.count("*").alias("_size"),
        )
        .where("_size > 1")
        .select("_key", "_keeper")
    )
    dropped = skew_join(ranked, keepers, ["_key"]).where(
        F.col("_ord") != F.col("_keeper._ord")
    )
    return dropped.select(
        F.col("_keeper._id").alias("keeper_id"),
        F.col("_keeper._source").alias("keeper_source"),
        F.col("_id").alias("dropped_id"),
        F.col("_source").alias("dropped_source"),
        F.lit(METHOD_EMAIL).alias("match_method"),
        F.lit(100.0).alias("match_score"),
        F.col("_priority").alias("edge_priority"),
        F.col("_ord").alias("edge_order"),
    )


def drop_rows(df: DataFrame, dropped: DataFrame, order: str = "_ord") -> DataFrame:
    """Delete by row key; ids may be null and cannot serve for that."""
    return df.join(dropped.select(order), order, "left_anti")


def annotate_provenance(
    df: DataFrame,
    edges: DataFrame,
    row_id: str = "employee_id",
    source: str = "source",
) -> DataFrame:
    """Contributing sources in match order, and the method of the last match.

    Edges whose keeper is no longer in `df` have no effect.  They are reduced to
    one row per keeper and source before a list is built, so the list is never
    longer than the number of sources.
    """
    order = F.struct(
        (F.col("match_method") == METHOD_FUZZY).cast("int").alias("step"),
        F.col("edge_priority"),
        F.col("edge_order"),
    )
    contributions = (
        edges.where(F.col("keeper_id").isNotNull())
        .groupBy("keeper_id", "dropped_source")
        .agg(F.min(order).alias("first"), F.max(order["step"]).alias("last_step"))
        .groupBy("keeper_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("first", "dropped_source"))).alias("_added"),
            F.max("last_step").alias("_last_step"),
        )
    )
    added = F.transform("_added", lambda entry: entry["dropped_source"])
    systems = F.array_distinct(
        F.concat(F.array(source), F.coalesce(added, F.array().cast("array<string>")))
    )
    method = (
        F.when(F.col("_last_step") == 1, METHOD_FUZZY)
        .when(F.col("_last_step") == 0, METHOD_EMAIL)
        .otherwise(METHOD_UNIQUE)
    )
    joined = df.join(contributions, F.col(row_id) == F.col("keeper_id"), "left")
    return joined.select(
        *df.columns,
        F.array_join(systems, ",").alias("source_systems"),
        method.alias("dedup_method"),
    )
