"""Connected components by alternating stars.

Each round joins every node to the smallest node known to be with it, first over its larger, then
over its smaller neighbours, until nothing changes. The number of links never grows, no group is
gathered in one task, and the number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _toward_least(links: DataFrame) -> DataFrame:
    """``node, other`` in both directions -> each node's links with the least of the node and its others."""
    least = links.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("least"))
    return links.join(least, "node")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``: the least node it is joined with.

    Links with a null end and loops join nothing. An empty table gives an empty table.
    """
    edges = stage(links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other"))
                  .where("node <> other").distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
        larger = (_toward_least(both).where("other > node")
                  .select(F.col("other").alias("node"), F.col("least").alias("other")).where("node <> other").distinct())
        marked = _toward_least(larger)
        smaller = (marked.select(F.col("other").alias("node"), F.col("least").alias("other"))
                   .union(marked.select("node", F.col("least").alias("other"))).where("node <> other").distinct())
        edges = stage(smaller, "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select("node", F.col("other").alias("component")).union(
        edges.select(F.col("other").alias("node"), F.col("other").alias("component")).distinct())
