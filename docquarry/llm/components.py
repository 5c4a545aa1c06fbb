"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Joins the larger neighbours of each node to its smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """Joins each node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return (links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of the links ``a``, ``b``
    that isn't the smallest itself.

    Each step writes its links to the shared folder; their number falls, and no step
    gathers the neighbours of a node.  Loops and repeated links do no harm.
    """
    links = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .where("a > b").distinct(), "links")
    before = None
    while True:
        links = stored(_small_star(_large_star(links)), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
