"""Connected components of a graph of links, as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableforge.llm.common import written


def _pointed_at_least(links: DataFrame) -> DataFrame:
    """Each neighbour above a node points at the least of the node and its neighbours."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("low"))
    least = least.select("u", F.least("u", "low").alias("low"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))


def _chained_to_least(links: DataFrame) -> DataFrame:
    """The neighbours below a node, and the node, point at the least of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("low"))
    others = down.join(least, "u").where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return others.union(least.select("u", F.col("low").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of ``links`` (two columns) that is not its own root.

    The two steps alternate until the links stay as they are; each round is written to
    the shared folder. The number of rounds grows with the logarithm of the nodes.
    """
    u, v = links.columns
    now = links.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v")
    now = written(now.distinct(), "links")
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = mark
        now = written(_chained_to_least(_pointed_at_least(now).distinct()).distinct(), "links")
