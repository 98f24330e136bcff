"""Connected components of an edge table by alternating large and small stars.

Each round replaces edges by edges to smaller neighbours, so that every
component ends as a star around its smallest node, in a number of rounds that
grows with the logarithm of the nodes. Rounds are written tables; hubs are
aggregated before they are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.staging import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())


def _chained(edges: DataFrame) -> bool:
    """Whether edges are not yet stars, each node with one edge to the smallest of its component."""
    sides = edges.select(F.col("u").alias("node"), F.lit(1).alias("side"), F.col("v").alias("to")).union(
        edges.select(F.col("v").alias("node"), F.lit(2).alias("side"), F.lit(None).cast("long").alias("to")))
    nodes = sides.groupBy("node").agg(F.bit_or("side").alias("sides"), F.min("to").alias("low"), F.max("to").alias("high"))
    return bool(nodes.filter("sides = 3 OR low < high OR node < low").take(1))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node` and its `component`, the smallest node that can be reached; one row for each node of a proper edge.

    Loops, repeated edges and edges with a null end add nothing.
    """
    current = stage(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct(), "edges")
    while _chained(current):
        current = stage(_small_star(_large_star(current)), "edges")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
