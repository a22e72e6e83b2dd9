"""Closure, levels and chains over edge tables.

DAGs under a hundred levels close in one recursive SQL query; ``closure`` here works at any depth and on cyclic
data too: each round doubles the path length, so it ends after log2(longest path) rounds. Between rounds the
pairs are checkpointed, so lineage stays short and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root, settled


def closure(edges: DataFrame) -> DataFrame:
    """All (src, dst) with a path of one edge or more."""
    checkpoint_root(edges.sparkSession)
    pairs = edges.select("src", "dst").distinct().checkpoint()
    n = pairs.count()
    while True:
        longer = pairs.join(pairs.select(F.col("src").alias("dst"), F.col("dst").alias("far")), "dst").select("src", F.col("far").alias("dst"))
        pairs = pairs.union(longer).distinct().checkpoint()
        more = pairs.count()
        if more == n:
            return pairs
        n = more


def on_cycles(edges: DataFrame) -> DataFrame:
    """Nodes that reach themselves: an acyclic graph has none."""
    return closure(edges).where("src = dst").select(F.col("src").alias("node"))


def unknown_parents(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    return edges.join(nodes.select(F.col("node").alias("dst")), "dst", "left_anti")


def prune(items: DataFrame, needs: DataFrame) -> DataFrame:
    """Items (id, available) that stay when those with an unavailable or dropped need, at any depth, go.

    ``needs`` has (id, need). Equal to dropping to a fix point, since dropping is monotone.
    """
    items, needs = settled(items.select("id", "available"), "items"), settled(needs.select("id", "need"), "needs")
    bad = items.where("NOT available").select("id")
    missing = needs.join(items.select(F.col("id").alias("need")), "need", "left_anti").select("id")
    fallen = front = settled(bad.union(missing).distinct(), "fallen")
    while not front.isEmpty():  # what needs what fell last; each round is written and cuts off the ones before
        front = settled(needs.join(front.select(F.col("id").alias("need")), "need").select("id").distinct().join(fallen, "id", "left_anti"), "fallen")
        fallen = fallen.union(front)
    return items.join(fallen, "id", "left_anti")


def tree_paths(nodes: DataFrame, sep: str = "/") -> DataFrame:
    """(id, depth, path) of every node (id, parent, title) below those without a parent, level by level; each level is
    cut off by a checkpoint, so neither depth nor width is limited."""
    checkpoint_root(nodes.sparkSession)
    front = nodes.where("parent IS NULL").select("id", F.lit(0).alias("depth"), F.col("title").alias("path")).checkpoint()
    found = front
    while not front.isEmpty():
        above = front.select(F.col("id").alias("parent"), "depth", F.col("path").alias("above"))
        front = nodes.join(above, "parent").select("id", (F.col("depth") + 1).alias("depth"), F.concat("above", F.lit(sep), "title").alias("path")).checkpoint()
        found = found.union(front)
    return found


def available(items: DataFrame, members: DataFrame) -> DataFrame:
    """(id, stays) of every item (id, present, whole) after losses spread both ways, at any depth.

    ``members`` has (id, package); a package may be a member itself. A member goes with its package, and a package that
    is only good ``whole`` goes with any of its members; a package that is not an item is a loss too.
    """
    down = members.select("id", F.col("package").alias("need"))
    up = members.join(items.where("whole").select(F.col("id").alias("package")), "package", "left_semi").select(F.col("package").alias("id"), F.col("id").alias("need"))
    kept = prune(items.select("id", F.col("present").alias("available")), down.union(up))
    return items.select("id").join(kept.select("id", F.lit(True).alias("stays")), "id", "left").fillna(False, ["stays"])


def downgraded(chosen: DataFrame, items: DataFrame, stays: DataFrame) -> DataFrame:
    """One row for each collection of ``chosen`` (collection, id, status): what is left of it.

    A ready collection that has lost members is partial, and unresolved if it has none left. items has (id, size_bytes).
    """
    own = chosen.join(items.select("id", "size_bytes"), "id", "left").join(stays, "id", "left").withColumn("stays", F.coalesce("stays", F.lit(False)))
    sums = own.groupBy("collection", "status").agg(F.count("*").alias("members"), F.count_if("stays").alias("left"), F.coalesce(F.sum(F.when(F.col("stays"), F.col("size_bytes"))), F.lit(0)).alias("known_bytes"))
    lost = F.col("left") < F.col("members")
    status = F.when(lost, F.when(F.col("left") > 0, "partial").otherwise("unresolved")).otherwise(F.col("status"))
    return sums.select("collection", "members", "left", "known_bytes", status.alias("status"))
