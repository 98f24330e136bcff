"""Equi-joins whose hot keys adaptive execution can split.

It splits a skewed partition only where both inputs of a join come straight from
the join's own shuffles. An aggregated lookup does not: it already lies by its
keys and is not shuffled again. Joining on a struct of the keys, which Spark does
not take for that arrangement, gives both inputs shuffles of the join. Nothing is
measured beforehand and no job starts while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.text import conjunction


def skew_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "inner",
    null_safe: bool = False,
) -> DataFrame:
    """Join `rows` to `lookup` on equally named keys.

    `how` may be any join type that keeps or drops rows of the left side.  With
    `null_safe` null keys match each other, otherwise they match nothing.
    """
    others = [name for name in lookup.columns if name not in keys]
    kept = rows.columns if how in ("left_semi", "left_anti") else [*rows.columns, *others]
    joined = F.struct(*keys)
    if not null_safe:
        joined = F.when(conjunction([F.col(name).isNotNull() for name in keys]), joined)
    left = rows.withColumn("_left_key", joined)
    right = lookup.withColumn("_right_key", joined).drop(*keys)
    return left.join(right, F.col("_left_key") == F.col("_right_key"), how).select(*kept)
