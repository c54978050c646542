"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storeledger.llm.common import staged


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node hangs on the node's smallest neighbour."""
    both = _both_ways(edges)
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    hung = both.filter(F.col("v") > F.col("u")).join(least, "u")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours hang on the smallest of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").filter(F.col("v") != F.col("m"))
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
        least.select("u", F.col("m").alias("v"))
    )


def _is_settled(edges: DataFrame) -> bool:
    """Whether every node hangs on one root, and no root hangs on another node."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    roots = edges.select(F.col("v").alias("id"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    nodes = ends.unionByName(roots).groupBy("id").agg(
        F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")
    )
    return nodes.filter("hangs + holds > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of (a, b) links: the smallest id it is linked with.

    Links join two different ids; order and repeats don't matter. Each round folds a
    node's neighbours to their minimum before the shuffle, so a node with very many
    links costs no more per task than others; the number of rounds grows with the
    logarithm of the longest chain. An empty table of links gives an empty result.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = staged(edges.filter(F.col("u") != F.col("v")).distinct(), "links")
    while not _is_settled(edges):
        edges = staged(_small_star(_large_star(edges).distinct()).distinct(), "links")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
