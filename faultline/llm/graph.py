"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node in ``links`` (a, b)."""
    edges = stars(links)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select("b", "b").distinct()
    )


def stars(links: DataFrame) -> DataFrame:
    """a, b: a node of ``links`` and the smallest of its component, without the smallest nodes themselves; stored.

    By alternating large and small stars.

    Each step links every neighbour of a node to the smallest one: only minima per node are aggregated, and the number
    of steps grows with the logarithm of the longest path. Nothing is collected. Loops and repeated links do no harm.
    """
    greater, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = stored(links.filter("a != b").select(greater, smaller).distinct(), "links")
    while not _all_stars(edges):
        edges = stored(_small_star(_large_star(edges)), "links")
    return edges


def _all_stars(edges: DataFrame) -> bool:
    """Every node hangs on one smaller node, which hangs on none: that is the smallest of the component."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    per_node = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return per_node.filter("hangs + holds > 1").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    near = edges.union(edges.select("b", "a"))
    least = near.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    joined = near.join(least.hint("merge"), "a").filter("b > a")
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    # dealt out once, for the minima and for the join with them
    edges = edges.repartition("a")
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    joined = edges.join(least.hint("merge"), "a")
    hung = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a != b")
    return hung.union(least.select("a", F.col("least").alias("b"))).distinct()
