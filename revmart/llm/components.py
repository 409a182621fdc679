"""Connected components of a link table, by alternating large and small stars.

Every round points the neighbours of each node to the smallest node near it (Kiveris et al. 2014); the number of rounds
grows with the logarithm of the longest chain.  A node's neighbours are never gathered: only minima are grouped, and
Spark splits the joins of hubs.  Rounds are cut by checkpoints, so lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.operators.lineage import cut_lineage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` has a > b."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """Return ``node, root`` for every node of ``links`` (a, b) that is not the smallest of its component.

    ``root`` is the component's smallest node.  Self links, repeated links and links with a null are harmless; nodes
    without links are not returned.
    """
    now = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = cut_lineage(now), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        now = cut_lineage(_small_star(_large_star(now)))
