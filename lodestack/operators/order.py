"""Order and chains in graphs: levels with a report of cycles, and single links followed to their ends.

``levels`` peels a dependency graph: a round settles the nodes whose needs are all settled and drops the edges to them,
so the edges left shrink, and what never goes is on a cycle or needs one. ``follow`` takes graphs with one link a node
and doubles the way of each node in every round, so a chain of a million links takes twenty. Both cut lineage with a
checkpoint a round; neither collects anything, and neither has a bound on depth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: Parts of a result that are joined by a union before they are written as one.
_PARTS = 16


def levels(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, level) of all nodes that can be ordered, and the edges (src, dst) that are left over.

    ``src`` needs ``dst``. A node's level is the length of its longest way down, 0 for nodes that need nothing.
    Repeated edges count once; an edge to itself is a cycle.
    """
    checkpoint_root(edges.sparkSession)
    rest = edges.select("src", "dst").distinct().checkpoint()
    front = rest.select(F.col("dst").alias("node")).distinct().join(_dealt(rest.select(F.col("src").alias("node"))), "node", "left_anti").withColumn("level", F.lit(0)).checkpoint()
    found, level = [front], 0
    while not front.isEmpty():
        level += 1
        settled = _dealt(front.select(F.col("node").alias("dst")))
        touched = rest.join(settled, "dst", "left_semi").select(F.col("src").alias("node")).distinct()
        left = rest.join(settled, "dst", "left_anti").checkpoint()
        front = touched.join(_dealt(left.select(F.col("src").alias("node"))), "node", "left_anti").withColumn("level", F.lit(level)).checkpoint()
        rest = left
        found.append(front)
        if len(found) == _PARTS:
            found = [_union(found).checkpoint()]
    return _union(found), rest


def _dealt(side: DataFrame) -> DataFrame:
    """One side of a join that both sides are dealt for. A round's sides may be small enough for a broadcast, but all rounds
    together would send a copy of the whole graph and more through the driver."""
    return side.hint("merge")


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.union(p)
    return whole


def follow(links: DataFrame, carry: str | None = None, sep: str = " > ") -> DataFrame:
    """(node, end, steps, looped) of every node of ``links`` (node, next), which has at most one link a node.

    ``end`` is the last node of the way and ``steps`` its length; nodes that run into a loop have no end and are
    ``looped``. With ``carry``, a column of ``links`` that nodes without a link have too (next is null there), ``trail``
    holds its values from the end to the node.
    """
    checkpoint_root(links.sparkSession)
    trail = [F.col(carry).alias("trail")] if carry else []
    own = links.where("next IS NOT NULL").select("node", F.col("next").alias("at"), *trail)
    last = links.select(F.col("next").alias("node")).where("node IS NOT NULL").union(links.where("next IS NULL").select("node")).distinct().join(own, "node", "left_anti")
    if carry:
        last = last.join(links.where("next IS NULL").select("node", *trail), "node", "left")
    ways = own.withColumn("steps", F.lit(1).cast("long")).withColumn("open", F.lit(True)).unionByName(last.withColumn("at", F.col("node")).withColumn("steps", F.lit(0).cast("long")).withColumn("open", F.lit(False)))
    ways, before = ways.checkpoint(), -1
    while True:
        n = ways.where("open").count()
        # While there are longer ways, some are just longer than the last round's reach: else only loops are left.
        if n in (0, before):
            break
        before = n
        ahead = ways.select(F.col("node").alias("at"), F.col("at").alias("far"), F.col("steps").alias("more"), F.col("open").alias("still"), *([F.col("trail").alias("above")] if carry else []))
        both = ways.where("open").join(ahead, "at")
        longer = [F.concat("above", F.lit(sep), "trail").alias("trail")] if carry else []
        moved = both.select("node", F.col("far").alias("at"), (F.col("steps") + F.col("more")).alias("steps"), F.col("still").alias("open"), *longer)
        ways = ways.where("NOT open").unionByName(moved).checkpoint()
    blank = F.lit(None)
    return ways.select("node", F.when(~F.col("open"), F.col("at")).otherwise(blank).alias("end"), F.when(~F.col("open"), F.col("steps")).alias("steps"), F.col("open").alias("looped"), *([F.when(~F.col("open"), F.col("trail")).alias("trail")] if carry else []))


def cycles(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Witnesses (cycle, length, nodes) among edges that ``levels`` left over, and (node, cycle) of every node kept back.

    Each node goes on to its least need, so each gets into one cycle, named by its least node; ``nodes`` begins there.
    Every way round is followed by doubling, with the least node on the way; a node is on the cycle if some node is there
    after more steps than there are nodes.
    """
    checkpoint_root(edges.sparkSession)
    one = edges.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("at")).withColumn("least", F.least("node", "at")).checkpoint()
    n, reach, jump = one.count(), 1, one
    while reach < n:  # after each round ``least`` covers the way of 2 * reach steps
        ahead = jump.select(F.col("node").alias("at"), F.col("at").alias("far"), F.col("least").alias("other"))
        jump = jump.join(ahead, "at").select("node", F.col("far").alias("at"), F.least("least", "other").alias("least")).checkpoint()
        reach *= 2
    on = jump.select(F.col("at").alias("node")).distinct()
    ring = on.join(jump, "node").select("node", F.col("least").alias("cycle")).checkpoint()
    blocked = jump.select("node", "at").join(ring.select(F.col("node").alias("at"), "cycle"), "at").select("node", "cycle")
    # Opened before its least node, the ring is a chain; places count from there.
    chain = ring.join(one.select("node", F.col("at").alias("next")), "node").select("node", F.when(F.col("next") != F.col("cycle"), F.col("next")).alias("next"))
    steps = follow(chain).select("node", "steps")
    ring = ring.join(steps, "node")
    witness = ring.groupBy("cycle").agg(F.count("*").alias("length"), F.sort_array(F.collect_list(F.struct((-F.col("steps")).alias("place"), "node"))).alias("x"))
    return witness.select("cycle", "length", F.col("x.node").alias("nodes")), blocked


def breadcrumbs(nodes: DataFrame, parents: DataFrame, sep: str = " > ") -> DataFrame:
    """(id, root, depth, trail) of each visible node (id, title, visible): its first visible parent by position, that
    one's, and so on. ``parents`` has (id, parent, position); parents that are hidden or unknown are passed over."""
    seen = nodes.where("visible").select("id", "title")
    known = parents.join(seen.select("id"), "id", "left_semi").join(seen.select(F.col("id").alias("parent")), "parent", "left_semi")
    first = known.groupBy("id").agg(F.min(F.struct("position", "parent"))["parent"].alias("next"))
    way = follow(seen.join(first, "id", "left").select(F.col("id").alias("node"), "next", "title"), "title", sep)
    return way.select(F.col("node").alias("id"), F.col("end").alias("root"), F.col("steps").alias("depth"), "trail")


def canonical(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, canonical, steps, problem) of each of ``nodes`` (id): duplicate links (id, target) followed to the end.

    A post with several targets on the way has no canonical post but a problem, as has a cycle; what comes first on the
    way counts. Repeated links count once.
    """
    targets = links.groupBy(F.col("id").alias("node")).agg(F.min("target").alias("next"), F.count_distinct("target").alias("n"))
    several = targets.where("n > 1").select(F.col("node").alias("canonical"), F.lit("several targets").alias("problem"))
    way = follow(targets.where("n = 1").select("node", "next").unionByName(several.select(F.col("canonical").alias("node"), F.lit(None).cast(dict(links.dtypes)["target"]).alias("next"))))
    found = nodes.select("id").distinct().join(way.withColumnRenamed("node", "id"), "id", "left")
    found = found.select("id", F.when(F.col("looped"), F.lit(None)).otherwise(F.coalesce("end", "id")).alias("canonical"), F.coalesce("steps", F.lit(0)).alias("steps"), "looped")
    found = found.join(several, "canonical", "left").withColumn("problem", F.coalesce("problem", F.when(F.col("looped"), F.lit("cycle"))))
    clean = F.col("problem").isNull()
    return found.select("id", F.when(clean, F.col("canonical")).alias("canonical"), F.when(clean, F.col("steps")).alias("steps"), "problem")
