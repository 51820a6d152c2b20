"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statmart.session import materialized


def _large_star(links: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is linked to the least node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def _is_settled(links: DataFrame) -> bool:
    """Whether every node has one link, and none to a node that has one itself."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up + down > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``class_id`` (its component's least node) of every node in ``links`` (columns a, b).

    Each step writes its links to the shared folder, so the plan stays short
    and lost executors cost one step. Steps grow with the logarithm of the
    largest component. Links of a node to itself are left out.
    """
    current = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = materialized(current)
    while not _is_settled(current):
        current = materialized(_small_star(_large_star(current)))
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("class_id"))
    return leaves.unionByName(leaves.select(F.col("class_id").alias("node"), "class_id").distinct())
