"""Connected components of a graph that lies in a table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a``, ``b``, long); ``root`` is the smallest node of its component.

    Each round replaces a node's links by links to its smallest neighbour: first those to larger neighbours, then those
    to smaller ones and itself. The graph stays connected where it was, and ends as stars around the smallest nodes after
    about log(n)^2 rounds. Rounds are written to the shared folder; nothing but two numbers per round reaches the driver.
    The neighbours of a node are only ever reduced to their smallest, which is done before the shuffle, and joined back.
    """
    links = stored(edges.where("a != b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "links")
    before = None
    while True:
        links = stored(_small_star(stored(_large_star(links), "links")), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    nodes = links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return nodes.unionByName(links.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours are linked to the smallest of itself and all its neighbours."""
    both = links.select("hi", "lo").unionByName(links.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
    least = both.groupBy("hi").agg(F.least("hi", F.min("lo")).alias("least")).withColumnRenamed("hi", "lo")
    least = stored(least, "links-least")
    return links.join(least, "lo").select("hi", F.col("least").alias("lo")).where("hi != lo").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of these neighbours."""
    least = stored(links.groupBy("hi").agg(F.min("lo").alias("least")), "links-least")
    moved = links.join(least, "hi").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("least").alias("lo"))).where("hi != lo").distinct()
