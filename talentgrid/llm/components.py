"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentgrid.llm.frames import checkpointed, join_unique


def _is_forest(edges: DataFrame) -> bool:
    """Whether every node has one edge to a root and no root has an edge further down."""
    parents = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    if not parents.filter("n > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge to another one; root is the least node.

    ``edges`` has columns a and b of one integer type; direction, loops and repeats don't matter.
    Alternating star operations: first each node's greater neighbours, then its smaller ones, are
    linked to the least node around it.  The rounds grow with the logarithm of the longest
    path; each ends with a checkpoint.  Hubs, which the stars create, are joined by broadcast of
    the few heavy ones.
    """
    links = checkpointed(
        edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while not _is_forest(links):
        both = checkpointed(links.union(links.select("v", "u")))
        around = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = checkpointed(
            join_unique(both.filter("v > u"), around, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = join_unique(large, least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = checkpointed(
            small.filter("u != v").union(least.select("u", "m")).distinct()
        )
    roots = links.select("v").distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
