"""Connected components of a table of links, by alternating large and small stars.

Each round points neighbours at the least neighbour, first the larger ones, then the smaller ones; a few rounds turn
any graph into stars around the least node. A node linked to a third of all others is a row per link, never a list,
and minima are taken in every task before the shuffle. Each round is written to the shared folder, which cuts the
lineage; nothing of the graph reaches the driver but a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.sources.scratch import cut


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node``, ``component``: the least node that links ``a`` - ``b`` lead to; nodes without a link are not listed."""
    links = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), name)
    before = None
    while (now := _state(links)) != before:
        before = now
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        links = cut(small.where("a > b").distinct(), name)
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(links.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("component")))
