"""Connected components of a link table, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from posttags.session import materialise


def _with_least(pairs: DataFrame) -> DataFrame:
    """``u, v`` pairs with the least of u and all its v."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return pairs.join(least, "u")


def _are_stars(pairs: DataFrame) -> bool:
    """Whether no node has two links down, or one while others link down to it."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("down")).unionByName(
        pairs.select(F.col("v").alias("node"), F.lit(0).alias("down"))
    )
    nodes = ends.groupBy("node").agg(F.sum("down").alias("downs"), F.min("down").alias("least"))
    return nodes.where("downs > 1 or (downs = 1 and least = 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``a, b`` links; the component is its least node.

    Rounds of large and small stars: each node links its larger neighbours, then its smaller
    ones, to the least node it knows, until every node has one such link, to a node without.
    Every round is an aggregate and a join, whose hot nodes Spark splits; nothing is collected.
    """
    pairs = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = materialise(pairs.distinct(), "links")
    while not _are_stars(pairs):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _with_least(materialise(large.distinct(), "links"))
        small = small.select("u", F.col("m").alias("v")).unionByName(
            small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        pairs = materialise(small.distinct(), "links")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
