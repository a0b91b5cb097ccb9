"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def _both_ways(links: DataFrame) -> DataFrame:
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return links.select("a", "b").unionByName(turned)


def _large_star(links: DataFrame) -> DataFrame:
    """Neighbours above a node move to the smallest node of its neighbourhood.

    The smallest nodes are stored before the join, so that Spark sees their size and
    can split the rows of a node with very many neighbours.
    """
    near = _both_ways(links)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    least = materialize(least, "least")
    return (
        near.filter("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .filter("a <> b")
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its neighbours below it move to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).filter("a <> b")


def components(links: DataFrame) -> DataFrame:
    """Every linked node with the smallest node of its component: node, root.

    `links` has the node pairs (a, b). Each round is written to the shared
    folder, so that a lost executor costs no more than a round.
    """

    def mark(frame: DataFrame) -> tuple:
        own = F.xxhash64("a", "b")
        return tuple(frame.agg(F.count(F.lit(1)), F.bit_xor(own), F.sum(own % 1_000_003)).first())

    links = materialize(links.select("a", "b").filter("a <> b").distinct(), "links")
    before = mark(links)
    while True:
        links = materialize(_small_star(_large_star(links)).distinct(), "links")
        after = mark(links)
        if after == before:
            break
        before = after
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.unionByName(roots)
