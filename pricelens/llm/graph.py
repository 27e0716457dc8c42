"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node (u > v here) and its smaller neighbours move to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) long edges -> (node, component): the least node reachable, for
    every node that has an edge.  Each round is two map-side combined
    aggregations and two skew-splittable joins, staged in the shared folder;
    rounds grow with the logarithm of the longest path."""
    def state(df):
        return df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()

    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = state(now)
    while before["n"]:
        now = staged(_small_star(_large_star(now)), "edges")
        after = state(now)
        if after == before:
            break
        before = after
    # at rest every edge points from a node to the least of its component
    pairs = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return pairs.union(pairs.select(F.col("component").alias("node"), "component").distinct())
