"""Connected components of a distributed graph by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindsight.llm.work import stage

MOST_ROUNDS = 100


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (hi, lo), hi > lo.

    Large: every neighbour above a node is linked to the least of its neighbourhood. Small: every
    neighbour below it, and the node itself.
    """
    if large:
        sides = edges.select("hi", "lo").union(edges.select("lo", "hi")).toDF("node", "other")
        least = stage(sides.groupBy("node").agg(F.min("other").alias("m")).withColumn("m", F.least("m", "node")), "least")
        linked = sides.where(F.col("other") > F.col("node")).join(least, "node").select(F.col("other").alias("hi"), F.col("m").alias("lo"))
    else:
        least = stage(edges.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        linked = edges.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(least.select("hi", F.col("m").alias("lo")))
    return linked.where(F.col("hi") > F.col("lo")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each linked node and the least node of its component.

    ``edges`` has two columns of one orderable type; pairs may repeat and come either way round. Works
    by large-star and small-star steps (Kiveris et al., 2014) until nothing changes, each step a
    minimum by node and a join, written to the shared folder. Nodes without links don't appear.
    """
    a, b = edges.columns[:2]
    now = stage(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges"
    )
    if now.isEmpty():
        return now.toDF("node", "component")
    state = None
    for _ in range(MOST_ROUNDS):
        now = stage(_star(stage(_star(now, True), "large"), False), "small")
        # Equal sums of hashes: the same set of edges as before.
        was, state = state, tuple(now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if was == state:
            break
    else:
        raise RuntimeError(f"components are not settled after {MOST_ROUNDS} rounds")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(now.select("lo", "lo")).distinct()
