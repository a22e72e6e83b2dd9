"""Closure over links from chosen pages: everything that must come along."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root


def crawl(seeds: DataFrame, links: DataFrame, most_rounds: int = 1000) -> DataFrame:
    """(page, depth) of all pages reached from ``seeds`` (page) over ``links`` (page, target), nearest first.

    Each round joins the new pages only. Rounds are checkpointed: lineage does not grow with depth.
    """
    checkpoint_root(links.sparkSession)
    reached = seeds.select("page").distinct().withColumn("depth", F.lit(0)).checkpoint()
    front = reached
    for depth in range(1, most_rounds + 1):
        front = links.join(front.select("page"), "page").select(F.col("target").alias("page")).distinct().join(reached.select("page"), "page", "left_anti").withColumn("depth", F.lit(depth)).checkpoint()
        if front.isEmpty():
            return reached
        reached = reached.union(front).checkpoint()
    raise ValueError(f"pages are still being reached after {most_rounds} rounds")
