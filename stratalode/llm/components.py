"""Connected components of a graph given by its edges, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalode.sinks import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of ``edges`` (a, b); component is the smallest node reachable.

    Alternating large-star and small-star steps: each replaces edges by edges to
    the smallest neighbour and keeps the components. Smallest neighbours are
    aggregated and joined back, so a hub is no single task's work. Every round is
    written to the shared folder, which cuts the lineage. An empty frame gives an
    empty result; loops and repeated edges do no harm.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = stage(edges, "edges")
    state = None
    while True:
        edges = stage(_small_star(_large_star(edges)), "edges")
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20, 0)"))).first()
        if new == state:
            break
        state = new
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
