"""Connected components of a table of links, by alternating star contraction; every round is a few joins and a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b`` that is not the smallest of its component; ``component`` is that smallest node.

    Large star: each node ties its larger neighbours to its smallest neighbour. Small star: each node ties its smaller neighbours to the
    smallest. Rounds grow with the logarithm of the longest chain; it ends when a round changes nothing. Nodes of many links
    are reduced to their minimum by partial aggregates, and the join back can be split."""
    e = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct())
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = stored(both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = stored(large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = now
