"""Connected components of a distributed edge list by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges(a, b); component is its smallest reachable node.

    Each round points every node at its smallest neighbour, then at that one's pointer, and
    replaces edges by those between pointers; a star is done after one round and a chain is
    shortened by a power. Only partial minima are shuffled, so a node of any degree is not
    gathered in one task. Edges and pointers are cut to the checkpoint folder each round.
    """
    left = durable(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    nodes = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    out = nodes.withColumn("component", F.col("node"))
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        near = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("p"))
        up = near.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        jump = durable(near.join(up, "p").select("v", F.col("pp").alias("p")))
        to = lambda c: jump.select(F.col("v").alias(c), F.col("p").alias(f"{c}_p"))
        left = durable(left.join(to("a"), "a").join(to("b"), "b").select(F.col("a_p").alias("x"), F.col("b_p").alias("y")).where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        out = out.join(to("component"), "component", "left").select("node", F.coalesce("component_p", "component").alias("component"))
    return out
