"""Connected components of an undirected graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailposture.llm.common import cut, hot_join


def components(links: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node that can be reached, for every node of ``links`` (a, b).

    Alternating large and small stars: every node hands its larger neighbours, then its smaller ones, over to the
    smallest neighbour, until each component is a star around its smallest node. Minima are pre-aggregated before
    the shuffle. The rows of a node with very many links stay where they are and get its minimum by broadcast; there
    can be few such nodes. Each round is cut off by a checkpoint in the shared folder.
    """
    stars = cut(_distinct(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))))
    before = _print(stars)
    while before[0]:
        both = stars.select("a", "b").union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"), F.count_if(F.col("b") > F.col("a")).alias("_n"))
        large = _distinct(hot_join(both.filter("b > a"), least, ["a"], before[0]).select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = cut(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("_n"))
        small = hot_join(large, least, ["a"], large.count()).select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        stars = cut(_distinct(small))
        after = _print(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(stars.select(F.col("b"), F.col("b")).distinct())


def _distinct(links: DataFrame) -> DataFrame:
    return links.filter("a <> b").distinct()


def _print(links: DataFrame) -> tuple[int, int | None]:
    """Count and an order-free fingerprint of the links."""
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]
