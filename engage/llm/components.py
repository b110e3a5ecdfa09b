"""Connected components of a link table by alternating stars.

Every round points each node's larger neighbours at its smallest one (large star), then each node and its smaller
neighbours at the smallest (small star).  Rounds are aggregations and joins on the node, so that a node with very
many links is combined before it is shuffled and its rows can be split; each round is written to the shared
folder, which cuts the lineage.  The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from engage.session import materialise


def large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("a").alias("v"), F.col("b").alias("u")).union(
        links.select(F.col("b").alias("v"), F.col("a").alias("u"))
    )
    least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
    return both.where("u > v").join(least, "v").select(F.col("u").alias("a"), F.col("m").alias("b")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Links run from the larger a to the smaller b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def unfinished(links: DataFrame) -> DataFrame:
    """Nodes that keep the links from being stars: they have two smaller neighbours, or one and larger ones too."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    found = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return found.where("up > 1 or (up = 1 and down = 1)")


def components(links: DataFrame) -> DataFrame:
    """(node, component_id) of every node in ``links`` (a, b); the smallest node names its component."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = materialise(links, "links")
    while not unfinished(links).isEmpty():
        links = materialise(small_star(large_star(links)), "stars")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component_id")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct()
    )
