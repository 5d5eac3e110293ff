"""Connected components of a graph given as edges, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node about it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots, each component's least node.

    Both steps keep the components and end in stars. They aggregate and join by node, and
    every round is written and read back, so nothing is recomputed from the start and no
    component ever meets in one task. Rounds grow with the logarithm of the longest chain.
    """
    edges = edges.filter("a <> b").select("a", "b").distinct()
    before = None
    while True:
        edges = materialize(edges, "components")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        edges = _small_star(_large_star(edges).filter("a <> b").distinct()).distinct()
