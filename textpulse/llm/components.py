"""Connected components of an edge table, without gathering any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpulse.llm.common import drop_written, result_only, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node are tied to the least node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("_m"))
    least = least.select("n", F.least("n", "_m").alias("m"))
    upward = edges.select(F.least("a", "b").alias("n"), F.greatest("a", "b").alias("v"))
    return upward.join(least, "n").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below are tied to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("n"), F.least("a", "b").alias("v"))
    least = down.groupBy("n").agg(F.min("v").alias("m"))
    others = down.join(least, "n").filter(F.col("v") != F.col("m"))
    others = others.select(F.col("v").alias("a"), F.col("m").alias("b"))
    return others.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))


def _state(edges: DataFrame) -> tuple:
    digest = F.bit_xor(F.xxhash64("a", "b"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())


@result_only
def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge, written; the component is its least node.

    Large-star and small-star rounds turn the edges (a, b) into one star per component. All
    steps are aggregates that reduce on the map side and equi-joins that Spark may split, so
    a node with very many neighbours is no hot spot. Loops and repeated edges do no harm.
    """
    edges = edges.select("a", "b").filter("a != b")
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "edges")
    state = _state(edges)
    while True:
        before = edges
        edges = _small_star(_large_star(edges).filter("a != b").distinct()).distinct()
        edges = written(edges, "edges")
        drop_written(before)
        after = _state(edges)
        if after == state:
            break
        state = after
    roots = edges.select(F.col("b").alias("node")).distinct()
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return written(stars.unionByName(roots.withColumn("component", F.col("node"))), "components")
