"""Connected components of a table of links, by alternating large and small stars.

Each round joins links with the least neighbour of their ends; nothing but the number of changed links comes to the
driver. Rounds grow with the logarithm of the longest chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimwright.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b); root is the smallest node of the component."""
    now = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "links")
    while True:
        # Large star: larger neighbours of a node go to the least node around it.
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large.where("a <> b"), "large-star")
        # Small star: a node and its smaller neighbours go to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        small = stored(small, "small-star")
        if small.count() == now.count() and not small.join(now, ["a", "b"], "left_anti").limit(1).count():
            break
        now = small
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
