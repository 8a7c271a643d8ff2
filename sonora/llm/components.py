"""Connected components of a table of links, by alternating large-star and small-star rounds."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonora.llm.shared import saved


def _least(links: DataFrame) -> DataFrame:
    """Each ``a`` with the least of itself and its neighbours."""
    return links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_least(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    near = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(near, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(near.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) of every node of the links (a, b) but the roots.

    Each round is written to the shared folder; rounds grow with the logarithm of the component size.
    """
    links = saved(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31)), F.count_distinct("a")).first()
        if not state[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        # Done when a round changes nothing; then each node has one link, to its root.
        if state == seen and state[0] == state[2]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        links = saved(_small_star(_large_star(links).distinct()).distinct(), "links")
