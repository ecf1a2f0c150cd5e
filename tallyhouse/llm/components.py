"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import cut_lineage, drop_staged


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Every node's neighbours (the larger, or the smaller and itself) linked to its smallest neighbour instead."""
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        new = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("x"), "m")
    else:
        # b > a in every link: b's smaller neighbours
        least = links.groupBy("b").agg(F.min("a").alias("m"))
        new = links.join(least, "b").select(F.col("a").alias("x"), "m").unionByName(least.select(F.col("b").alias("x"), "m"))
    return new.filter(F.col("x") != F.col("m")).select(F.least("x", "m").alias("a"), F.greatest("x", "m").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of the links (a, b): root is the smallest node of its component.

    Both steps keep the components; they end when nothing changes, then each link goes from a root to a node. Sums are added up
    before they are exchanged; the join back to a hub's neighbours is one that adaptive execution splits. Each round is written,
    so a lost executor costs that round only. Links of a node with itself or null have no effect.
    """
    links = cut_lineage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    before = None
    while True:
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        done, links = links, cut_lineage(_stars(_stars(links, True), False), "links")
        drop_staged(done)
    return links.select(F.col("b").alias("node"), F.col("a").alias("root"))
