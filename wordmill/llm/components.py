"""Connected components by alternating large-star and small-star steps.

Every step is a partial minimum per node and a join with it, so no node's
neighbours meet in one task; links never reach the driver, only a row count
and a checksum of each round do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frozen


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on links ``u > v``: link neighbours to the least of them."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    pairs = both if large else edges
    # Written first: both sides of the join are then plain shuffles, and
    # adaptive execution can split the rows of a node with many links.
    least = frozen(pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")))
    joined = pairs.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
    return moved.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the undirected links ``a, b`` (longs):
    ``root`` is the least node that can be reached; roots have no row."""
    links = frozen(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .distinct())
    before = _state(links)
    while before[0]:
        links = frozen(_star(frozen(_star(links, True)), False))
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
