"""Connected components of a graph of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import Staging


def smallest(edges: DataFrame) -> DataFrame:
    """node, component: the smallest node that each node of the edges a, b reaches.

    Large-star hangs a node's larger neighbours on its smallest one, small-star its smaller ones; both keep the
    components and in O(log^2) rounds leave stars. A node's neighbours are never gathered: each step is a minimum per node,
    joined back. The edges of every round are written to the shared folder.
    """
    stage = Staging(edges.sparkSession)
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        # large-star: every larger neighbour of u to the least of u and its neighbours
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small-star: every smaller neighbour of u, and u, to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = stage(small.where("a <> b").distinct())
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            break
        before = now
    stars = edges.groupBy("a").agg(F.min("b").alias("component"))
    roots = edges.select(F.col("b").alias("a"), F.col("b").alias("component")).distinct()
    return stars.unionByName(roots.join(stars, "a", "left_anti")).select(F.col("a").alias("node"), "component")
