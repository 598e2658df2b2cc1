"""Connected components by alternating large-star and small-star steps.

Every step is a minimum per node (combined before the shuffle) and an inner join on the
node, so a hub with millions of links is split by the join and never gathered in one
task. The links of every round are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierworks.llm.common import staged


def _ordered(links: DataFrame) -> DataFrame:
    return links.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).filter("a < b").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour."""
    both = links.select("a", "b").union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = both.filter("b > a").join(least, "a")
    return _ordered(larger.select(F.col("m").alias("a"), "b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    joined = links.join(least, "b")
    smaller = joined.select(F.col("m").alias("a"), F.col("a").alias("b"))
    return _ordered(smaller.union(least.select(F.col("m").alias("a"), "b")))


def _state(links: DataFrame) -> tuple:
    return tuple(
        links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    )


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) between integers to (node, root), root being the smallest reachable.

    Nodes without a link to another node are not listed; no link gives no row.
    """
    links = staged(_ordered(links), "links")
    before = None
    while (now := _state(links)) != before:
        before = now
        links = staged(_small_star(_large_star(links)), "links")
    members = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    return members.union(roots)
