"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").select(
        F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a > b")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): every node of an edge, and the smallest node it is connected to.

    edges has two columns a and b of one ordered type. Each round is written to the
    shared folder; the number of rounds grows with the logarithm of the nodes. Minima
    are combined before the shuffle, so a node may have any number of neighbours.
    """
    a, b = edges.columns
    now = stage(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    state = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
        now = stage(_small_star(_large_star(now).distinct()).distinct(), "edges")
    # The smallest node of a component stands on the right only.
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
