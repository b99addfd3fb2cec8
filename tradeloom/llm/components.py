"""Connected components of links between nodes of any orderable type, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.sources.shared import discard, stored


def _summary(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of all nodes with a link to another, where the component is its smallest node.

    Each round points all larger neighbours of a node to the smallest one, then all smaller ones; the rounds end when the
    links, then one star per component, no longer change. Only a count and a sum reach the driver.
    """
    links = stored(links.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "links")
    last = _summary(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # What is joined is stored first: only plain shuffles are split where one node has very many links.
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least")), "least")
        # Large star: neighbours above the node go to the least of its neighbourhood.
        large = stored(links.join(least, "a").select(F.col("least").alias("a"), "b").where("a <> b").distinct(), "large-stars")
        # Small star: the node and its neighbours below go to the least of these.
        below = stored(large.groupBy("b").agg(F.min("a").alias("least")), "below")
        small = large.join(below, "b").select(F.col("least").alias("x"), F.explode(F.array("a", "b")).alias("y"))
        before, links = links, stored(small.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "links")
        discard(before, least, large, below)
        now = _summary(links)
        if now == last:
            roots = links.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("component"))
            return links.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)
        last = now
