"""Connected components of links, by alternating large-star and small-star steps on tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.rows import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of the node and its neighbours."""
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    tied = links.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.union(least).distinct()


def _torn(links: DataFrame) -> bool:
    """Whether some node is tied to two others."""
    return not links.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node`` and ``component``, its least node, for every node that has a link.

    ``links`` has whole numbers ``a`` and ``b`` in any order; loops, repeats and nulls are ignored.
    """
    links = written(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        label,
    )
    # Done when every node is tied to one that is tied to no other.
    while not links.select(F.col("b").alias("a")).join(links, "a", "left_semi").isEmpty() or _torn(links):
        links = written(_small_star(_large_star(links)), label)
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
