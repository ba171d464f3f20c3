"""Connected components of a large edge table by alternating star steps.

Every round joins each node with the least of its neighbours, which is found by
a combinable minimum; no neighbour list is ever gathered. Rounds are written to
shared storage, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stormledger.llm.common import kept


def _large_star(edges: DataFrame) -> DataFrame:
    """Hook every larger neighbour of a node to the node's least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hook a node and its smaller neighbours to the least of them; edges are u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; the component is its least node.

    ``edges`` has two columns of ids, in any order and with repeats; loops and
    nulls are left out. Rounds go on until nothing changes.
    """
    a, b = edges.columns[:2]
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    now, before = kept(now, "edges"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = mark
        now = kept(_small_star(_large_star(now).distinct()).distinct(), "stars")
