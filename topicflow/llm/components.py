"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import stage


def large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest around it."""
    both = links.union(links.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them; a > b in links."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    rest = links.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(least).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node reachable.

    Links may repeat, in both directions, and may link a node to itself.  Both
    stars pre-aggregate per node, so a node with very many links costs each task
    one row, and its links stay split over tasks.  Each round is written to the
    shared folder.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stage(links.where("a != b").distinct(), "links")
    before = None
    while True:
        total = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if total == before or not total[0]:
            break
        before = total
        links = stage(small_star(large_star(links)), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select("b", "b").distinct()
    )
