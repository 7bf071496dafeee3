"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import kept


def _least(links: DataFrame) -> DataFrame:
    """The least neighbour of each ``a``, itself included; combined before the shuffle."""
    return links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's least neighbour."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    moved = both.where("b > a").join(_least(both), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """Columns ``a, b``: each linked node but the least of its component, and that least node.

    ``links`` has the two ends of each link as ``a`` and ``b``; order and repeats don't matter, and
    links of a node to itself say nothing.  Every round is written out, and the rounds end when one
    changes no row: their number grows with the logarithm of the number of nodes.
    """
    links = kept(links.where("a <> b"))
    before = None
    while True:
        links = kept(_small_star(_large_star(links)))
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            return links
        before = state
