"""Connected components of a link table, by rounds of joins over staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from duolex.llm.common import small_or_shuffled
from duolex.session import stage


def _to_smallest(edges: DataFrame) -> DataFrame:
    """For each `u`, the least of its neighbours `v` and itself. Minima combine in each task."""
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    return small_or_shuffled(stage(least.select("w", F.least("w", "m").alias("m")), "least"))


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, root of every node that has a link to another one; the root is the least node reachable.

    Each round hooks all larger neighbours of a node to the least one around it, then all smaller ones.
    Links never become more, and paths at least halve in practice. A node may have any number of links:
    they are never gathered, only joined with one row per node. Null ends are left out.
    """
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = stage(ends.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(), "links")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stage(both.join(_to_smallest(both), F.col("u") == F.col("w")).filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        hooked = large.join(_to_smallest(large), F.col("u") == F.col("w"))
        small = hooked.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").unionByName(
            hooked.select("u", F.col("m").alias("v")))
        edges = stage(small.distinct(), "small-star")
