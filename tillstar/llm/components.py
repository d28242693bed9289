"""Connected components of a graph given as links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.tables import written


def _with_least(links: DataFrame) -> DataFrame:
    """``u, v`` with the least neighbour of ``u`` (itself included) as ``least``."""
    least = links.groupBy("u").agg(F.min("v").alias("_v"))
    return links.join(
        least.select("u", F.least("u", "_v").alias("least")), "u"
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _with_least(both).filter("v > u")
        .select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _with_least(down)
    moved = starred.select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = starred.select("u", F.col("least").alias("v"))
    return moved.unionByName(own).filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node in a link ``u, v``; the component is its least node.

    Links are undirected; loops, repeats and links with a null end are ignored, so a node without
    a link to another one is not in the result. A least value comes from a pre-combined aggregate
    that is joined back, so a node with many links is never one group. Rounds grow with the
    logarithm of the longest chain. Each round is written, so a lost executor costs its tasks only.
    """
    now = written(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(), "links"
    )
    before = None
    while True:
        now = written(_small_star(_large_star(now)), "stars")
        seen = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen == before:
            break
        before = seen
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
