"""Records of one system without a partner in another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.operators.skew import skew_join


def ghosts(
    payroll: DataFrame,
    golden: DataFrame,
    key: str = "employee_id",
) -> DataFrame:
    """Payroll rows whose id is not in the golden table; a null id is not either.

    Copies of a row are all kept.
    """
    ids = golden.select(key).where(F.col(key).isNotNull()).distinct()
    return skew_join(payroll, ids, [key], "left_anti")


def merged_ghosts(ghost_rows: DataFrame, edges: DataFrame, key: str = "employee_id") -> DataFrame:
    """Ghosts that were merged into another record rather than being unknown."""
    dropped = edges.select(F.col("dropped_id").alias(key)).where(F.col(key).isNotNull()).distinct()
    return skew_join(ghost_rows, dropped, [key], how="left_semi")


def ghost_rate(ghost_rows: DataFrame, payroll: DataFrame) -> DataFrame:
    """Number of ghosts and payroll rows, and their ratio."""
    counted = ghost_rows.select(F.lit(1).alias("ghost")).unionAll(payroll.select(F.lit(0)))
    totals = counted.agg(
        F.count_if(F.col("ghost") == 1).alias("ghosts"),
        F.count_if(F.col("ghost") == 0).alias("payroll_rows"),
    )
    rate = F.col("ghosts") / F.greatest(F.col("payroll_rows"), F.lit(1))
    return totals.withColumn("ghost_rate", rate)
