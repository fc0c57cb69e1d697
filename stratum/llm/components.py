"""Connected components by alternating star contractions, all as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import reliable


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to the smallest node it knows."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("m", "a").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b")))


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node that has a link; a component is named by its smallest node.

    Edges shrink to stars in a number of rounds that grows with the logarithm of the longest path; they are done when
    every node has one edge down, to a node that has none.
    """
    edges = reliable(links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct())
    while True:
        edges = reliable(_small_star(_large_star(edges).where("a <> b").distinct()).where("a <> b").distinct())
        several = edges.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
        between = edges.select("a").join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        if several.unionAll(between).isEmpty():
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
