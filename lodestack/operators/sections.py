"""Sections of documents: import of a publisher's outline, and digests of trees that tell whether anything in them moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root


def _bits(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def tree_digests(nodes: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, id, height, size, digest) of each node (keys, id, parent, position, value) of a forest.

    A digest covers the node's value and its children's digests with their positions; equal trees have equal digests, and
    a leaf with another value or place changes those of all nodes above it. Nodes are settled from the leaves up: a round
    settles those whose children all are. Children add up by exclusive or of two hashes, so no list of them is made and a
    parent of very many is combined before it is shuffled. A node in a loop has no leaf below it and no row.
    """
    checkpoint_root(nodes.sparkSession)
    own = nodes.select(*keys, "id", "parent", "position", F.coalesce(F.col("value"), F.lit("")).alias("value")).checkpoint()
    parents = own.where("parent IS NOT NULL").groupBy(*keys, F.col("parent").alias("id")).agg(F.count("*").alias("children"))
    rest = own.join(parents, [*keys, "id"], "left").fillna(0, ["children"])
    none = F.lit(0).cast("long")
    front = rest.where("children = 0").select(*keys, "id", "parent", "position", F.lit(0).alias("height"), F.lit(1).cast("long").alias("size"), F.sha2(F.concat_ws("|", "value", F.lit("0"), F.lit("0"), F.lit("0")), 256).alias("digest")).checkpoint()
    waiting = rest.where("children > 0").select(*keys, "id", "parent", "position", "value", "children", none.alias("met"), none.alias("below"), none.alias("one"), none.alias("two"), F.lit(0).alias("top")).checkpoint()
    found = [front]
    while not front.isEmpty():
        label = F.concat_ws("|", F.col("position").cast("string"), "digest")
        sums = front.where("parent IS NOT NULL").groupBy(*keys, F.col("parent").alias("id")).agg(F.count("*").alias("n"), F.sum("size").alias("s"), F.bit_xor(_bits(label)).alias("x"), F.bit_xor(_bits(F.concat(F.lit("~"), label))).alias("y"), F.max("height").alias("h"))
        step = waiting.join(sums, [*keys, "id"], "left")
        add = lambda a, b: F.col(a) + F.coalesce(b, F.lit(0))
        mix = lambda a, b: F.col(a).bitwiseXOR(F.coalesce(b, none))
        step = step.select(*keys, "id", "parent", "position", "value", "children", add("met", "n").alias("met"), add("below", "s").alias("below"), mix("one", F.col("x")).alias("one"), mix("two", F.col("y")).alias("two"), F.greatest("top", F.coalesce("h", F.lit(0))).alias("top")).checkpoint()
        done = step.where("met = children")
        front = done.select(*keys, "id", "parent", "position", (F.col("top") + 1).alias("height"), (F.col("below") + 1).alias("size"), F.sha2(F.concat_ws("|", "value", *[F.col(c).cast("string") for c in ("children", "one", "two")]), 256).alias("digest")).checkpoint()
        waiting = step.where("met < children")
        found.append(front)
    whole = found[0]
    for f in found[1:]:
        whole = whole.union(f)
    return whole.select(*keys, "id", "height", "size", "digest")


def imported(outline: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sections and a report of each document from its outline (doc, position, level, title, reason).

    ``reason`` says why an entry has no usable place, null where it has one. An entry's parent is the last one before it
    with a lower level. Entries without a place are left out; their children are proposed at the top, with a warning.
    Report: doc, entries, sections, warnings, status (draft, partial-draft or whole-document).
    """
    before = Window.partitionBy("doc").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    levels = sorted(r[0] for r in outline.select("level").distinct().collect())  # six at most in HTML
    lower = F.greatest(*[F.when(F.col("level") > n, F.max(F.when(F.col("level") == n, F.col("position"))).over(before)) for n in levels], F.lit(None).cast("int"))
    rows = outline.withColumn("parent", lower.cast("long"))
    good = rows.where("reason IS NULL")
    held = good.select("doc", F.col("position").cast("long").alias("parent"), F.lit(True).alias("held"))
    placed = good.join(held, ["doc", "parent"], "left")
    sections = placed.select("doc", "position", "title", F.when(F.col("held"), F.col("parent")).alias("parent"), (F.col("parent").isNotNull() & F.col("held").isNull()).alias("orphan"))
    counts = rows.groupBy("doc").agg(F.count("*").alias("entries"), F.count_if(F.col("reason").isNotNull()).alias("refused"))
    orphans = sections.groupBy("doc").agg(F.count("*").alias("sections"), F.count_if("orphan").alias("orphans"))
    report = counts.join(orphans, "doc", "left").fillna(0, ["sections", "orphans"])
    warnings = F.col("refused") + F.col("orphans") + F.when(F.col("sections") == 0, 1).otherwise(0)
    status = F.when(F.col("sections") == 0, "whole-document").when(warnings > 0, "partial-draft").otherwise("draft")
    return sections, report.select("doc", "entries", "sections", warnings.alias("warnings"), status.alias("status"))
