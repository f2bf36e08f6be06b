"""Connected components by alternating large-star and small-star joins.

Edges stay in DataFrames.  Minima are pre-aggregated before the shuffle.  Few
minima are broadcast; else every join has two plain exchanges, so AQE can split
a hub's partition.  Each round is cut by a checkpoint in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frameml.plans.lineage import BROADCAST_ROWS, cut_lineage, released_shuffles


def _state(edges: DataFrame):
    with released_shuffles(edges.sparkSession):
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(20,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node that an edge (a, b) names; component is
    the smallest node reachable.  Loops, repeated and null edges are allowed
    (a null end links nothing)."""
    edge = cut_lineage(edges.where(F.col("a") != F.col("b"))
                       .select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct())
    before = _state(edge)
    while before[0]:
        # Twice the edges bound the nodes, and large-star makes no more edges than there were.
        side = F.broadcast if 2 * before[0] <= BROADCAST_ROWS else cut_lineage
        both = edge.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(edge.select("hi", "lo"))
        least = (both.groupBy("u").agg(F.min("v").alias("m"))
                 .select(F.col("u").alias("lo"), F.least("u", "m").alias("m")))
        large = cut_lineage(edge.join(side(least), "lo").select(F.col("m").alias("lo"), "hi").distinct())
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(side(least), "hi")
                 .select(F.col("m").alias("lo"), F.explode(F.array("lo", "hi")).alias("hi"))
                 .where("lo != hi").distinct())
        edge = cut_lineage(small)
        now = _state(edge)
        if now == before:
            break
        before = now
    # Every edge is now (root, member).
    members = edge.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return members.union(edge.select("lo", "lo").distinct())
