"""Connected components of a table of links, by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import settle

ROUNDS = 60


def _stars(links: DataFrame) -> bool:
    """Whether every node hangs once under a node that hangs nowhere."""
    ends = links.select(F.col("node").alias("id"), F.lit(1).alias("hangs")).unionByName(
        links.select(F.col("low").alias("id"), F.lit(0).alias("hangs"))
    )
    met = ends.groupBy("id").agg(F.sum("hangs").alias("hangs"), F.count(F.lit(1)).alias("n"))
    return met.filter("hangs > 1 or (hangs = 1 and n > 1)").isEmpty()


def _lowest(links: DataFrame) -> DataFrame:
    """Per node its smallest neighbour or itself, for ``links`` with node and other."""
    return links.groupBy("node").agg(F.min("other").alias("least")).withColumn("least", F.least("least", "node"))


def components(links: DataFrame) -> DataFrame:
    """Per node that has a link: node, low (the smallest node it can reach).

    ``links`` has two columns a and b of node numbers; direction does not matter.
    Each round hangs larger neighbours, then smaller ones, under a node's smallest
    neighbour, until every component is a star around its smallest node.  Rounds are
    joins and map-side combined minima, so a node with very many neighbours is only
    a skewed join key.
    """
    table = settle(links.filter("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low")), "links")
    for _ in range(ROUNDS):
        if _stars(table):
            break
        both = table.select("node", F.col("low").alias("other")).unionByName(
            table.select(F.col("low").alias("node"), F.col("node").alias("other"))
        )
        large = (
            both.join(_lowest(both), "node")
            .filter("other > node")
            .select(F.col("other").alias("node"), F.col("least").alias("low"))
            .filter("node <> low")
        )
        large = settle(large, "large-star")
        down = large.select("node", F.col("low").alias("other"))
        least = _lowest(down)
        small = (
            down.join(least, "node")
            .select(F.col("other").alias("node"), F.col("least").alias("low"))
            .unionByName(least.select("node", F.col("least").alias("low")))
            .filter("node <> low")
            .distinct()
        )
        table = settle(small, "small-star")
    else:
        raise RuntimeError(f"components are not done after {ROUNDS} rounds")
    return table
