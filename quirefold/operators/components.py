"""Connected components of an edge table by alternating large-star and small-star steps, checkpointed between rounds.

Edges never leave the cluster; the driver only learns whether a round changed anything. Hot vertices are no trouble in
the star steps: each is an aggregation (minimum per vertex) followed by a join with one row per vertex.

Defined results: an empty edge table has no components; self edges, repeated edges and either direction are allowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.session import cut


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 50) -> DataFrame:
    """(node, component) of every vertex of ``edges``; the component is its least vertex.

    Raises if ``rounds`` rounds do not finish the components (their number grows with the logarithm of the longest path).
    """

    def mark(x: DataFrame) -> tuple:
        """Row count and order-free hash sum: equal for equal edge sets."""
        return tuple(x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    known = mark(e)
    for _ in range(rounds if known[0] else 0):
        # large star: the larger neighbours of a vertex go to the least of its neighbourhood
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the smaller neighbours of a vertex, and itself, go to the least of them
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        e = cut(large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        before, known = known, mark(e)
        if known == before:
            break
    else:
        if known[0]:
            raise RuntimeError(f"components still change after {rounds} rounds")
    nodes = edges.select(F.col(a).alias("node")).union(edges.select(F.col(b).alias("node"))).distinct()
    least = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return nodes.join(least, "node", "left").withColumn("component", F.coalesce("component", "node"))
