"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is a grouped minimum (combined before the shuffle) and a join on the node, so no node's
neighbours are ever gathered.  The minima are written to the shared folder before they are joined:
both sides of a join are then dealt out for it alone, so Spark can split the rows of a node that very
many edges meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def _star(edges: DataFrame, least: DataFrame) -> DataFrame:
    return edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges: longs u, v.  Returns node, root: every node of an edge with the least node of its component."""
    edges = materialise(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = materialise(_star(both.filter("v > u"), least).distinct(), "large")
        least_again = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = _star(large, least_again).unionByName(least_again.select("u", F.col("m").alias("v")))
        old, edges = edges, materialise(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        discard(old, least, large, least_again)
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
