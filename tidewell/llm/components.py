"""Connected components of a graph held in a table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import settle


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) for each node of ``edges`` (``a``, ``b``).

    Large star: a node's greater neighbours go to the least of it and its neighbours. Small star:
    a node's lesser neighbours, and the node, go to their least. Both keep components whole; they
    are repeated until no edge moves. Least neighbours are aggregates and are joined back, so no
    task holds the neighbours of a node. Each round is settled, and the number of rounds grows
    with the logarithm of the longest chain.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    links = settle(ordered.distinct())
    before = None
    while True:
        both = links.unionByName(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = (
            links.select(F.col("u").alias("v"), F.col("v").alias("w"))
            .unionByName(links.select("v", F.col("u").alias("w")))
            .where("w > v")
            .join(least, "v")
            .select(F.col("w").alias("v"), F.col("m").alias("u"))
            .distinct()
        )
        floor = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(floor, "v")
        links = settle(
            small.where("u > m").select(F.col("u").alias("v"), F.col("m").alias("u"))
            .unionByName(floor.select("v", F.col("m").alias("u")))
            .where("v <> u")
            .distinct()
        )
        # Equal tables have equal sums; a table that is a set of stars no longer changes.
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
                links.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
            )
        before = now
