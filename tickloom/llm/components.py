"""Connected components of a link table by alternating large-star and small-star steps.

Labels spread by joins and minima alone: no link, component or neighbour list is ever collected,
on the driver or in one row. The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialised, remove_path


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (
        both.filter(F.col("b") > F.col("a"))
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest node) of every node that has a link to another."""
    spark = links.sparkSession
    edges = (
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct()
    )
    edges, path = materialised(edges, "links")
    seen = None
    while True:
        # every round makes some target smaller until the state repeats: each node has one link and
        # no target has a link itself
        row = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        ).first()
        state = (row["n"], row["s"])
        if row["n"] == 0 or state == seen:
            break
        seen, before = state, path
        edges, path = materialised(_small_star(_large_star(edges)), "links")
        remove_path(spark, before)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
