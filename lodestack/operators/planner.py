"""Resolution of many customised selections at once: a state is a key of every row, so all states are one job.

A state customises a profile: it takes collections in or out and picks their editions. For each state the chosen editions'
members are listed, replaced files leave, generated files go with their sources to a fix point, readers are added where an
archive needs them, and what is left is counted once per file. Nothing is resolved state by state, and no state's list of
files is gathered in one place: its digest is a sum over rows that does not depend on their order.

Sets of states are words of 64 bits, so a member or file is one row for 64 states and not one for each state; only counts and
sums, and the files where a caller reads them, have a row a state.

Tables, as DataFrames of ``Catalog``:
resources (resource_id, edition, target_bytes, status), one row for each edition there is, ``published`` always;
members (resource_id, edition, asset_id); assets (asset_id, size_bytes, resolved, format, role, direct, critical, required,
source_id: the archive it is taken from, or null), role in document, supporting, software; needs (asset_id, need): sources
of generated files; replacements (resource_id, asset_id); credits (resource_id, credited_id, bytes);
profiles (profile_id, by_default: whether its collections are chosen by default or only their baseline files, capacity_bytes,
reserve_bytes, discovery_bytes, readers_bytes); defaults (profile_id, resource_id, edition); baseline (profile_id, asset_id).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root, settled
from . import ranking

PUBLISHED = "published"
#: Fixed value: bytes that every drive keeps for its own metadata.
OVERHEAD = 16 * 1024 * 1024


@dataclass(frozen=True)
class Catalog:
    resources: DataFrame
    members: DataFrame
    assets: DataFrame
    needs: DataFrame
    replacements: DataFrame
    credits: DataFrame
    profiles: DataFrame
    defaults: DataFrame
    baseline: DataFrame
    readers: int | str
    lists: DataFrame | None = None


def place(key: str) -> Column:
    """60 bits of a key's MD5."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 15), 16, 10).cast("long")


def digest(key: str) -> Column:
    """Order-free digest of a set of keys: the exclusive or of their bits."""
    return F.bit_xor(place(key))


def chosen(catalog: Catalog, states: DataFrame, items: DataFrame) -> DataFrame:
    """(state_id, resource_id, edition, selected, excluded, explicit) of every default or customised collection.

    states (state_id, profile_id), items (state_id, resource_id, included, edition). ``excluded`` marks defaults taken out,
    ``explicit`` editions other than the profile's.
    """
    kinds = states.join(catalog.profiles.select("profile_id", "by_default"), "profile_id").select("state_id", "profile_id", "by_default")
    own = kinds.join(catalog.defaults.withColumnRenamed("edition", "own_edition"), "profile_id").select("state_id", "resource_id", "own_edition")
    rows = own.join(items, ["state_id", "resource_id"], "full_outer").join(kinds.select("state_id", "by_default"), "state_id")
    preset, custom = F.col("own_edition").isNotNull(), F.col("included").isNotNull()
    selected = F.coalesce("included", F.col("by_default"))
    usual = F.coalesce("own_edition", F.lit(PUBLISHED))
    edition = F.coalesce("edition", usual)
    return rows.select("state_id", "resource_id", edition.alias("edition"), selected.alias("selected"), (preset & custom & ~selected).alias("excluded"), (selected & custom & (edition != usual)).alias("explicit"))


def _seats(states: DataFrame) -> DataFrame:
    """(state_id, word, seat, bit): each state's place in sets of states, which are words of 64 bits."""
    n = ranking.numbered(states.select("state_id").distinct(), [F.asc("state_id")], "n")
    return n.selectExpr("state_id", "(n - 1) DIV 64 AS word", "CAST((n - 1) % 64 AS INT) AS seat", "shiftleft(1L, CAST((n - 1) % 64 AS INT)) AS bit").checkpoint()


def _fallen(sets: DataFrame, needs: DataFrame) -> DataFrame:
    """(word, asset_id, fallen): states in which a kept asset goes with an asset that it needs, at any depth. sets (word,
    asset_id, kept, out); a need in ``out`` counts as lost."""
    at = ["word", "asset_id"]
    made = sets.where("kept <> 0").select(*at, "kept").join(needs, "asset_id").checkpoint()
    good = sets.select("word", F.col("asset_id").alias("need"), F.expr("kept & ~out").alias("good"))
    first = made.join(good, ["word", "need"], "left").groupBy(*at).agg(F.expr("max(kept) & ~bit_and(coalesce(good, 0L))").alias("fallen"))
    fallen = front = first.where("fallen <> 0").checkpoint()
    while not front.isEmpty():  # what needs what fell last, for all states at once
        lost = front.select("word", F.col("asset_id").alias("need"), F.col("fallen").alias("lost"))
        hit = made.join(lost, ["word", "need"]).groupBy(*at).agg(F.expr("max(kept) & bit_or(lost)").alias("hit"))
        front = hit.join(fallen, at, "left").select(*at, F.expr("hit & ~coalesce(fallen, 0L)").alias("fallen")).where("fallen <> 0").checkpoint()
        fallen = fallen.union(front).groupBy(*at).agg(F.bit_or("fallen").alias("fallen")).checkpoint()
    return fallen


def resolve(catalog: Catalog, states: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reports of all states, their collections and their files.

    Reports: state_id, files, knowledge_bytes, software_bytes, supporting_bytes, direct_files, critical_files, known_bytes,
    target_bytes, reader_bytes, final_bytes, incomplete, errors (array, sorted), can_build, digest. Collections: state_id,
    resource_id, edition, status, members, resolved, known_bytes, target_bytes, auto. Files: (state_id, asset_id).
    """
    spark = states.sparkSession
    checkpoint_root(spark)
    seats, at = _seats(states), ["word", "asset_id"]

    def packed(df: DataFrame, *keys: str, **sets: str) -> DataFrame:
        """(word, keys, sets): for each key the states of its rows for which each condition holds."""
        return df.join(seats, "state_id").groupBy("word", *keys).agg(*[F.expr(f"coalesce(bit_or(CASE WHEN {c} THEN bit END), 0L)").alias(name) for name, c in sets.items()])

    def unpacked(df: DataFrame, of: str) -> DataFrame:
        """A row for each state of the set ``of``."""
        each = df.where(F.col(of) != 0).withColumn("seat", F.explode(F.expr(f"filter(sequence(0, 63), i -> getbit({of}, i) = 1)")))
        return each.join(seats.select("word", "seat", "state_id"), ["word", "seat"]).drop("word", "seat", of)

    picks = chosen(catalog, states, items).checkpoint()
    there = catalog.resources.select("resource_id", "edition", F.lit(True).alias("has"))
    want = picks.where("selected").join(there, ["resource_id", "edition"], "left").withColumn("used", F.when(F.col("has"), F.col("edition")).otherwise(PUBLISHED)).checkpoint()
    # Editions of a collection are a handful; each state uses one of them.
    uses = packed(want, "resource_id", "used", states="true").groupBy("word", "resource_id").agg(F.map_from_entries(F.collect_list(F.struct("used", "states"))).alias("uses"), F.bit_or("states").alias("wanted"))
    ways = packed(picks, "resource_id", out="excluded", explicit="explicit").join(uses, ["word", "resource_id"], "left").checkpoint()
    # A row for each member: the states that hold it by this collection, and those that took the collection or its edition out.
    parts = catalog.members.join(ways, "resource_id").select("word", "resource_id", "asset_id", F.expr("coalesce(uses[edition], 0L)").alias("raw"), "out", "explicit")
    parts = settled(parts.where("raw <> 0 OR out <> 0 OR explicit <> 0"), "planner-members")
    held = parts.groupBy(*at).agg(F.bit_or("raw").alias("held"), F.bit_or("out").alias("out"), F.bit_or("explicit").alias("explicit"))
    # Replaced files leave all collections, the replacing one included.
    claims = want.select("state_id", "resource_id").join(catalog.replacements.withColumnRenamed("asset_id", "list_id"), "resource_id").groupBy("state_id", "list_id").agg(F.count("*").alias("n"))
    claims = packed(claims, "list_id", once="true", more="n > 1")
    lists = catalog.replacements.select(F.col("asset_id").alias("list_id"), "asset_id").distinct() if catalog.lists is None else catalog.lists
    before = F.bit_or("once").over(Window.partitionBy(*at).orderBy("list_id").rowsBetween(Window.unboundedPreceding, -1))
    taken = claims.join(lists, "list_id").withColumn("more", F.col("more").bitwiseOR(F.coalesce(before, F.lit(0)).bitwiseAND(F.col("once")))).groupBy(*at).agg(F.bit_or("once").alias("once"), F.bit_or("more").alias("more"))
    sets = held.join(taken, at, "full_outer").fillna(0, ["held", "out", "explicit", "once", "more"])
    sets = settled(sets.withColumn("kept", F.expr("held & ~once")).withColumn("several", F.expr("held & more")).drop("more"), "planner-assets")
    credits = catalog.credits.join(catalog.replacements.withColumnRenamed("asset_id", "list_id"), "resource_id").join(ways.where("wanted <> 0").select("word", "resource_id", "wanted"), "resource_id")
    shared = credits.join(parts.where("raw <> 0").select("word", F.col("resource_id").alias("credited_id"), "asset_id", "raw"), ["word", "credited_id"]).withColumn("by", F.expr("raw & wanted")).where("`by` <> 0")
    shared = shared.join(lists, ["list_id", "asset_id"], "left_semi").groupBy("word", "resource_id", "credited_id", "bytes").agg(F.bit_or("by").alias("by"))
    credit = unpacked(shared, "by").groupBy("state_id", F.col("credited_id").alias("resource_id")).agg(F.sum("bytes").alias("credit"))
    # A generated file goes where a source is not held, or belongs to a collection that was taken out.
    sets = sets.join(_fallen(sets, catalog.needs), at, "left").withColumn("left", F.expr("kept & ~coalesce(fallen, 0L)")).drop("fallen")
    assets = catalog.assets
    archives = unpacked(sets.join(assets.where("resolved AND format = 'zim'").select("asset_id"), "asset_id").groupBy("word").agg(F.bit_or("left").alias("left")), "left").checkpoint()
    reader = F.col("resource_id") == F.lit(catalog.readers)
    has_reader = want.where(reader).select("state_id")
    auto = archives.join(has_reader, "state_id", "left_anti").select("state_id", F.lit(catalog.readers).alias("resource_id"), F.lit(True).alias("auto"))
    added = packed(auto, "resource_id", added="true").join(catalog.members.where(F.col("edition") == PUBLISHED).where(reader), "resource_id").select("word", "resource_id", "asset_id", "added")
    # Files of a preset without default collections, beside what the collections hold.
    plain = packed(states.join(catalog.profiles.where("NOT by_default").select("profile_id"), "profile_id"), "profile_id", plain="true").join(catalog.baseline, "profile_id").groupBy(*at).agg(F.bit_or("plain").alias("plain"))
    sets = sets.join(added.groupBy(*at).agg(F.bit_or("added").alias("added")), at, "full_outer").join(plain, at, "full_outer")
    sets = sets.fillna(0, ["held", "out", "explicit", "once", "kept", "several", "left", "added", "plain"]).withColumn("own", F.expr("left | added"))
    sets = sets.withColumn("plain", F.expr("plain & ~(out | once | explicit | own)")).withColumn("files", F.expr("own | plain"))
    known = settled(sets.select(*at, "kept", "several", "left", "plain", "files").join(assets.withColumn("listed", F.lit(True)), "asset_id", "left"), "planner-files")
    pinned = known.where("resolved AND files <> 0")

    rows = want.select("state_id", "resource_id", "edition", "used", F.lit(False).alias("auto")).union(auto.select("state_id", "resource_id", F.lit(PUBLISHED), F.lit(PUBLISHED), "auto"))
    # Members of a collection are in few sets of states, so they are added up by set before the sets are unpacked.
    own = parts.where("raw <> 0").join(known.select(*at, "kept", "left", "listed", "resolved", "size_bytes"), at).select("word", "resource_id", F.expr("raw & left").alias("own"), F.expr("raw & kept & ~left").alias("lost"), "listed", "resolved", "size_bytes")
    own = own.unionByName(added.join(assets, "asset_id").select("word", "resource_id", F.col("added").alias("own"), F.lit(0).cast("long").alias("lost"), F.lit(True).alias("listed"), "resolved", "size_bytes"))
    own = own.groupBy("word", "resource_id", "own", "lost").agg(F.count("listed").alias("members"), F.count_if(F.col("listed") & F.col("resolved")).alias("resolved"), F.coalesce(F.sum(F.when(F.col("resolved"), F.col("size_bytes"))), F.lit(0)).alias("known_bytes")).checkpoint()
    sums = unpacked(own.drop("lost"), "own").groupBy("state_id", "resource_id").agg(*[F.sum(c).alias(c) for c in ("members", "resolved", "known_bytes")])
    lost = unpacked(own.groupBy("word", "resource_id").agg(F.bit_or("lost").alias("lost")), "lost").select("state_id", "resource_id", F.lit(True).alias("lost"))
    stated = catalog.resources.select("resource_id", F.col("edition").alias("used"), "target_bytes", F.col("status").alias("stated"))
    rows = rows.join(stated, ["resource_id", "used"]).join(sums, ["state_id", "resource_id"], "left").join(credit, ["state_id", "resource_id"], "left").join(lost, ["state_id", "resource_id"], "left")
    rows = rows.fillna(0, ["members", "resolved", "known_bytes", "credit"]).fillna(False, ["lost"])
    status = F.when(F.col("lost"), "partial").otherwise(F.col("stated"))
    status = F.when(F.col("members") == 0, "unresolved").when((F.col("resolved") < F.col("members")) & (status == "ready"), F.when(F.col("resolved") > 0, "partial").otherwise("unresolved")).otherwise(status)
    adjusted = F.col("target_bytes") - F.col("credit")
    rows = rows.select("state_id", "resource_id", "edition", status.alias("status"), "members", "resolved", "known_bytes", F.greatest(adjusted, "known_bytes").alias("target_bytes"), "auto", (adjusted < 0).alias("over")).checkpoint()

    size = lambda c: F.coalesce(F.sum(F.when(c, F.col("size_bytes"))), F.lit(0))
    document = F.col("role") == "document"
    totals = pinned.groupBy("word", F.col("files").alias("set")).agg(
        F.count("*").alias("files"), size(document).alias("knowledge_bytes"), size(F.col("role") == "software").alias("software_bytes"), size(F.col("role") == "supporting").alias("supporting_bytes"),
        F.count_if(document & F.col("direct")).alias("direct_files"), F.count_if("critical").alias("critical_files"), F.sum("size_bytes").alias("known_bytes"), digest("asset_id").alias("digest"),
        (F.count_if(F.col("format") == "zim") > 0).alias("archives"), (F.count_if(F.col("role") == "software") > 0).alias("programs"),
    )
    merged = {"digest": F.bit_xor, "archives": F.max, "programs": F.max}
    totals = unpacked(totals, "set").groupBy("state_id").agg(*[merged.get(c, F.sum)(c).alias(c) for c in totals.columns[2:]])
    base = unpacked(known.where("resolved").groupBy("word", "plain").agg(F.sum("size_bytes").alias("plain_bytes")), "plain").groupBy("state_id").agg(F.sum("plain_bytes").alias("plain_bytes"))
    targets = rows.groupBy("state_id").agg(F.coalesce(F.sum(F.when(~reader, F.col("target_bytes"))), F.lit(0)).alias("content"), F.max(F.when(reader, F.col("target_bytes"))).alias("reader"), F.count_if(F.col("status") != "ready").alias("incomplete"))

    def problem(df: DataFrame, text: str) -> DataFrame:
        return df.select("state_id", F.lit(text).alias("error"))

    def any_of(df: DataFrame, of: str) -> DataFrame:
        return unpacked(df.groupBy("word").agg(F.bit_or(of).alias("set")), "set")

    source = pinned.select("word", F.col("asset_id").alias("source_id"), F.col("files").alias("there"))
    absent = pinned.where("source_id IS NOT NULL").join(source, ["word", "source_id"], "left").select("word", F.expr("files & ~coalesce(there, 0L)").alias("absent"))
    problems = [
        problem(want.where(F.col("has").isNull()), "edition is not there"),
        problem(any_of(known, "several"), "several collections replace a file"),
        problem(rows.where("over"), "credit exceeds a target"),
        problem(archives.join(picks.where(reader & F.col("excluded") & ~F.col("selected")).select("state_id"), "state_id"), "archives need readers"),
        problem(any_of(absent, "absent"), "archive of a member is not selected"),
        problem(any_of(known.where("NOT resolved AND required"), "files"), "required file is unresolved"),
    ]
    errors = problems[0]
    for p in problems[1:]:
        errors = errors.union(p)
    errors = errors.groupBy("state_id").agg(F.collect_set("error").alias("errors"))  # a handful of texts
    report = states.join(catalog.profiles.drop("by_default"), "profile_id").join(totals, "state_id", "left").join(targets, "state_id", "left").join(base, "state_id", "left").join(errors, "state_id", "left")
    report = report.fillna(0, ["files", "knowledge_bytes", "software_bytes", "supporting_bytes", "direct_files", "critical_files", "known_bytes", "content", "incomplete", "plain_bytes", "digest"]).fillna(False, ["archives", "programs"])
    target = F.col("content") + F.col("plain_bytes")
    readers = F.when(F.col("reader").isNull(), 0).otherwise(F.greatest("readers_bytes", "reader"))
    final = F.greatest(F.col("known_bytes"), target + readers) + F.col("discovery_bytes") + OVERHEAD
    late = [
        F.when(final + F.col("reserve_bytes") > F.col("capacity_bytes"), "exceeds the drive"),
        F.when(F.col("files") == 0, "no files are selected"),
        F.when(F.col("archives") & ~F.col("programs"), "archives without a reader"),
    ]
    all_ = F.array_sort(F.array_union(F.coalesce("errors", F.array().cast("array<string>")), F.array_compact(F.array(*late))))
    report = report.withColumn("errors", all_).withColumn("can_build", (F.size("errors") == 0) & ((F.col("incomplete") == 0) | F.col("allow_incomplete")))
    names = ["files", "knowledge_bytes", "software_bytes", "supporting_bytes", "direct_files", "critical_files", "known_bytes"]
    report = report.select("state_id", "profile_id", *names, target.alias("target_bytes"), readers.alias("reader_bytes"), final.alias("final_bytes"), "incomplete", "errors", "can_build", "digest")
    return report, rows.drop("over"), unpacked(pinned.select(*at, "files"), "files")


def replay(locks: DataFrame, report: DataFrame) -> DataFrame:
    """(state_id, verdict) of locks (state_id, profile_id, files, known_bytes, target_bytes, reader_bytes, planned_bytes, digest)
    against states resolved anew: a lock is its exact files, whatever the defaults are now."""
    now = report.select("state_id", *[F.col(c).alias(f"now_{c}") for c in ("profile_id", "files", "known_bytes", "digest")])
    verdict = (
        F.when(F.col("now_digest").isNull(), "unknown state")
        .when(F.col("profile_id") != F.col("now_profile_id"), "other profile")
        .when(F.col("planned_bytes") != F.col("target_bytes") + F.col("reader_bytes"), "budget does not add up")
        .when((F.col("digest") != F.col("now_digest")) | (F.col("files") != F.col("now_files")), "other files")
        .when(F.col("known_bytes") != F.col("now_known_bytes"), "other sizes")
        .otherwise("same")
    )
    return locks.join(now, "state_id", "left").select("state_id", verdict.alias("verdict"))
