"""Rule sets over catalog records: each function gives named conditions under which a row breaks a rule.

They are tested by ``integrity.violations`` in one pass; a condition that is null counts as broken, so rows must
state what a rule asks for. Rules that need other rows or tables are functions that return violations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settled
from .integrity import path_conflicts, repeated, unknown, violations

#: First folders of destinations, formats read directly, formats of software, kinds of records.
ROOTS = ("BOOKS", "CRITICAL", "MAPS", "REFERENCE", "SOFTWARE", "ZIM")
DIRECT_FORMATS = ("epub", "html", "md", "pdf", "txt")
SOFTWARE_FORMATS = ("apk", "dmg", "exe")
RECORD_TYPES = ("archive", "guide", "reference", "software", "textbook")
LOCATOR_FORMATS = {"pdf-page": ("pdf",), "html-anchor": ("htm", "html"), "text-lines": ("markdown", "md", "text", "txt"), "archive-entry": ("epub", "zim")}
MOST_ORDER = 1_000_000_000

_ID = r"^[a-z0-9_-]+$"
_DIGEST = r"^[0-9a-f]{64}$"


def blank(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c)) == "")


def unsafe_path(path: Column) -> Column:
    """Absolute, empty or upward paths, and those with a backslash, a colon, a question mark or control characters."""
    parts = F.split(path, "/")
    return path.rlike(r"[\x00-\x1f\\:?]") | F.exists(parts, lambda p: p.isin("", ".", ".."))


def unsafe_source(url: Column) -> Column:
    """Addresses other than https with a host and without a user or fragment."""
    return ~url.rlike(r"^https://[^/@#?]+([/?][^#]*)?$")


def asset_rules() -> dict[str, Column]:
    fmt, dest, resolved = F.lower("format"), F.col("destination"), F.col("status") == "resolved"
    return {
        "id": ~F.col("id").rlike(_ID),
        "destination": unsafe_path(dest) | ~F.split(dest, "/")[0].isin(*ROOTS) | (F.size(F.split(dest, "/")) < 2),
        "title": blank("title"),
        "record type": ~F.col("record_type").isin(*RECORD_TYPES),
        "supporting file counted as a document": F.col("supporting") & (F.col("critical") | F.col("illustrated") | ~F.col("record_type").isin("reference", "archive")),
        "status": ~F.col("status").isin("resolved", "unresolved"),
        "unexplained": (F.col("status") == "unresolved") & blank("reason"),
        "size": ~F.coalesce(F.col("size_bytes") >= 1, F.col("status") == "unresolved"),
        "checksum": F.col("sha256").isNotNull() & ~F.coalesce(F.col("sha256").rlike(_DIGEST), F.lit(True)),
        "software without checksum": (fmt.isin(*SOFTWARE_FORMATS) | dest.startswith("SOFTWARE/")) & resolved & F.col("sha256").isNull(),
        "critical but not readable": F.col("critical") & (~fmt.isin(*DIRECT_FORMATS) | F.col("reader_required")),
        "archive without reader": (fmt == "zim") & ~F.col("reader_required"),
        "source": resolved & F.coalesce(unsafe_source(F.col("source_url")), F.lit(True)),
    }


def profile_rules() -> dict[str, Column]:
    low, high = F.col("target_min_bytes"), F.col("target_max_bytes")
    return {
        "id": ~F.col("id").rlike("^[a-z0-9-]+$"),
        "negative budget": F.least("capacity_bytes", "reserve_bytes", "discovery_bytes") < 0,
        "no usable capacity": F.col("capacity_bytes") <= F.col("reserve_bytes"),
        "unpaired target": low.isNull() != high.isNull(),
        "target minimum over maximum": F.coalesce(low > high, F.lit(False)),
    }


def topic_rules(allowed: tuple[str, ...]) -> dict[str, Column]:
    """For (id, title, parents, position, fields): ``fields`` are the names of all fields that the topic states."""
    text = F.col("title")
    return {
        "id": ~F.col("id").rlike("^[a-z0-9][a-z0-9-]{0,79}$"),
        "text": blank("title") | (F.length(text) > 500) | text.rlike(r"[\x00-\x08\x0b-\x1f]"),
        "order": F.coalesce(F.abs(F.col("position")) > MOST_ORDER, F.lit(False)),
        "own parent": F.array_contains("parents", F.col("id")),
        "repeated parent": F.size(F.array_distinct("parents")) < F.size("parents"),
        "unknown field": F.size(F.array_except("fields", F.lit(list(allowed)))) > 0,
    }


def locator_rules() -> dict[str, Column]:
    """For (kind, format, page, end_page, anchor, path, seconds, end_seconds)."""
    fits = F.lit(False)
    for kind, formats in LOCATOR_FORMATS.items():
        fits = fits | ((F.col("kind") == kind) & F.lower("format").isin(*formats))
    ranged = F.col("kind").isin("pdf-page", "text-lines")
    bad = lambda c: F.isnan(c) | (F.abs(F.col(c)) == float("inf")) | (F.col(c) < 0)
    return {
        "kind does not fit the format": ~fits,
        "page": ranged & F.coalesce(F.col("page") < 1, F.lit(True)),
        "range": ranged & F.coalesce(F.col("end_page") < F.col("page"), F.lit(False)),
        "anchor": (F.col("kind") == "html-anchor") & (blank("anchor") | F.coalesce(F.col("anchor").rlike(r"\s"), F.lit(True))),
        "path": (F.col("kind") == "archive-entry") & F.coalesce(unsafe_path(F.col("path")), F.lit(True)),
        "time": F.coalesce(bad("seconds"), F.lit(False)) | F.coalesce(bad("end_seconds"), F.lit(False)) | F.coalesce(F.col("end_seconds") < F.col("seconds"), F.lit(False)),
    }


def recipe_rules() -> dict[str, Column]:
    """For (id, version, inputs, outputs, review, evidence, blockers): lists of ids, evidence and blockers."""
    approved = F.col("review") == "approved"
    return {
        "id": ~F.col("id").rlike("^[a-z0-9][a-z0-9_-]*$"),
        "version": blank("version"),
        "inputs and outputs overlap": F.arrays_overlap("inputs", "outputs"),
        "repeated input": F.size(F.array_distinct("inputs")) < F.size("inputs"),
        "review": ~F.col("review").isin("pending", "approved"),
        "approved without evidence": approved & (F.size("evidence") == 0),
        "approved with blockers": approved & (F.size("blockers") > 0),
    }


def unpinned_inputs(recipes: DataFrame, assets: DataFrame) -> DataFrame:
    """Approved recipes of which an input is unknown or has no checksum; assets have (id, sha256)."""
    need = recipes.where("review = 'approved'").select("id", F.explode("inputs").alias("input"))
    pinned = assets.where("sha256 IS NOT NULL").select(F.col("id").alias("input"))
    return need.join(pinned, "input", "left_anti").select(F.lit("recipe").alias("entity"), "id", F.lit("input without pin").alias("rule")).distinct()


def capture_violations(sources: DataFrame, manifests: DataFrame) -> DataFrame:
    """Of sources (manifest_id, id, url, version, size_bytes, sha256, evidence) and manifests (id, download_bytes, other_bytes,
    metadata_bytes, peak_bytes)."""
    own = {
        "version": blank("version"),
        "size": F.coalesce(F.col("size_bytes") <= 0, F.lit(True)),
        "checksum": F.col("sha256").isNotNull() & ~F.coalesce(F.col("sha256").rlike(_DIGEST), F.lit(True)),
        "evidence": (F.size("evidence") == 0) | (F.size("evidence") > 100),
        "source": unsafe_source(F.col("url")),
    }
    sums = sources.groupBy(F.col("manifest_id").alias("id")).agg(F.sum("size_bytes").alias("sum_bytes"))
    whole = manifests.join(sums, "id", "left").withColumn("sum_bytes", F.coalesce("sum_bytes", F.lit(0)))
    rules = {
        "download budget is not the sum of its sources": F.col("download_bytes") != F.col("sum_bytes"),
        "peak leaves out components": F.col("peak_bytes") < F.col("download_bytes") + F.col("other_bytes") + F.col("metadata_bytes"),
    }
    found = violations(sources, "source", "id", own).union(violations(whole, "manifest", "id", rules))
    return found.union(repeated(sources, "source", "id")).union(repeated(sources, "source", "url", "repeated address"))


def unequal(documents: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """(key, document, value, expected): where a document states another value for a key than the first one, or none."""
    names = list(documents)
    first = documents[names[0]].select(key, F.col(value).alias("expected"))
    rest = None
    for name in names[1:]:
        both = first.withColumn("__a", F.lit(True)).join(documents[name].select(key, F.col(value).alias("value")).withColumn("__b", F.lit(True)), key, "full_outer")
        wrong = both.where(F.col("__a").isNull() | F.col("__b").isNull() | ~F.col("value").eqNullSafe(F.col("expected")))
        wrong = wrong.select(key, F.lit(name).alias("document"), "value", "expected")
        rest = wrong if rest is None else rest.union(wrong)
    return rest


def capacity_violations(totals: DataFrame, items: DataFrame, assignments: DataFrame) -> DataFrame:
    """Of declared totals (id, n, bytes), inventory items (group_id, item_id, bytes) and assignments (item_id)."""
    sums = items.groupBy(F.col("group_id").alias("id")).agg(F.count("*").alias("sum_n"), F.sum("bytes").alias("sum_bytes"))
    both = totals.join(sums, "id", "full_outer")
    rules = {"count differs": F.col("n") != F.col("sum_n"), "bytes differ": F.col("bytes") != F.col("sum_bytes")}
    found = violations(both, "group", "id", rules).union(repeated(items, "item", "item_id"))
    return found.union(unknown(assignments.distinct(), "assignment", "item_id", "item_id", items, "item_id"))


def receipt_violations(receipts: DataFrame, manifests: DataFrame) -> DataFrame:
    """Receipts (id, manifest_id, manifest_sha256, size_bytes, sha256) bound to manifests (manifest_id, digest, size_bytes,
    sha256): the receipt names the manifest by its digest, and has its size and, where it is pinned, its checksum."""
    m = manifests.select("manifest_id", F.col("digest"), F.col("size_bytes").alias("m_size"), F.col("sha256").alias("m_sha"), F.lit(True).alias("known"))
    both = receipts.join(m, "manifest_id", "left")
    known = F.coalesce("known", F.lit(False))
    rules = {
        "unknown manifest": ~known,
        "other manifest": known & F.coalesce(F.col("manifest_sha256") != F.col("digest"), F.lit(True)),
        "size": known & F.coalesce(F.col("size_bytes") != F.col("m_size"), F.lit(True)),
        "checksum": known & F.coalesce(F.col("sha256") != F.col("m_sha"), F.lit(False)),
    }
    return violations(both, "receipt", "id", rules)


def phase_rules() -> dict[str, Column]:
    """For (download, expanded, preview, scratch, cache, metadata, budget, measured) bytes of a phase."""
    parts = [F.col(c) for c in ("download", "expanded", "preview", "scratch", "cache")]
    total = sum(parts[1:], parts[0]) + F.col("metadata")
    return {
        "negative": F.least(*parts, "budget") < 0,
        "expansion over its allowance": F.col("expanded") < F.col("measured"),
        "budget leaves out components": F.col("budget") < total,
    }


def _rows(df: DataFrame, entity: str, rule: str, key: str = "id") -> DataFrame:
    return df.select(F.lit(entity).alias("entity"), F.col(key).cast("string").alias("id"), F.lit(rule).alias("rule")).distinct()


def _all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.union(p)
    return whole


def asset_list_rules() -> dict[str, Column]:
    """For (category, version, license, mirrors, profiles, member_path, size_bytes, status, generated, supporting, member of an
    archive or not)."""
    least = F.when(F.col("source_id").isNotNull() | (F.col("generated") & F.col("supporting")), 0).otherwise(1)
    return {
        "category": blank("category"),
        "version": blank("version"),
        "license": blank("license"),
        "mirrors": F.coalesce(F.exists("mirrors", lambda u: F.coalesce(unsafe_source(u), F.lit(True))), F.lit(False)),
        "profiles": F.col("profiles").isNull() | F.coalesce(F.exists("profiles", lambda p: p.isNull()), F.lit(False)),
        "size": ~F.coalesce(F.col("size_bytes") >= least, F.col("status") == "unresolved"),
        "member path": F.col("source_id").isNotNull() & F.coalesce(unsafe_path(F.col("member_path")), F.lit(True)),
    }


def archive_members(assets: DataFrame) -> DataFrame:
    """Violations of files taken from an archive (source_id, document) against the archive's own record.

    assets (id, source_id, document, status, sha256, format, supporting, source_url, mirrors, critical, illustrated,
    record_type). An archive is a pinned, supporting ZIP that is no member itself, and its members have its addresses.
    """
    own = ("id", "source_id", "status", "sha256", "format", "supporting", "source_url", "mirrors")
    source = assets.select(*[F.col(c).alias(f"of_{c}") for c in own]).dropDuplicates(["of_id"])
    rows = assets.where("source_id IS NOT NULL").join(source, F.col("source_id") == F.col("of_id"), "left")
    known = F.col("of_id").isNotNull()
    rules = {
        "archive is unknown": ~known,
        "archive is the file itself": F.col("source_id") == F.col("id"),
        "archive is a member": F.col("of_source_id").isNotNull(),
        "archive is no ZIP": known & (F.lower("of_format") != "zip"),
        "archive is not pinned": known & ((F.col("of_status") != "resolved") | F.col("of_sha256").isNull()),
        "archive is no supporting file": known & ~F.col("of_supporting"),
        "member is not pinned": (F.col("status") != "resolved") | F.col("sha256").isNull(),
        "member has another address": known & ((F.col("source_url") != F.col("of_source_url")) | ~F.col("mirrors").eqNullSafe(F.col("of_mirrors"))),
        "member that is no document counted as one": ~F.col("document") & (F.col("critical") | F.col("illustrated") | (F.col("record_type") != "reference")),
    }
    return violations(rows, "asset", "id", {k: F.coalesce(c, F.lit(False)) for k, c in rules.items()})


def path_violations(assets: DataFrame) -> DataFrame:
    """Destinations that are equal but for case, or at once a file and another's folder: one row for each such file."""
    conflicts = path_conflicts(assets.select(F.col("destination").alias("path")))
    rows = assets.select("id", F.lower("destination").alias("key")).join(conflicts, "key")
    return rows.select(F.lit("asset").alias("entity"), "id", F.concat(F.lit("path: "), "conflict").alias("rule")).distinct()


EDITIONS = ("direct", "compact")
STATUSES = ("ready", "partial", "unresolved")
DEVICE = ("pending", "passed", "not_applicable")


def resource_rules() -> dict[str, Column]:
    """For (id, title, number, target_bytes, status, reason, device, source_pages, credit_id, credit_bytes), device a
    struct of status, reason and evidence or null."""
    device, evidence = F.col("device").isNotNull(), F.col("device.evidence")
    return {
        "id": ~F.col("id").rlike("^[a-z0-9][a-z0-9-]*$"),
        "title": blank("title"),
        "number": F.coalesce(F.col("number") < 1, F.lit(False)),
        "target": F.col("target_bytes") < 0,
        "status": ~F.col("status").isin(*STATUSES),
        "unexplained": (F.col("status") != "ready") & blank("reason"),
        "device status": device & ~F.coalesce(F.col("device.status").isin(*DEVICE), F.lit(False)),
        "device reason": device & blank("device.reason"),
        "device evidence repeated": device & F.coalesce(F.size(evidence) != F.size(F.array_distinct(evidence)), F.lit(True)),
        "device passed without evidence": device & F.coalesce((F.col("device.status") == "passed") & (F.size(evidence) <= 0), F.lit(False)),
        "source page": F.coalesce(F.exists("source_pages", lambda u: F.coalesce(unsafe_source(u), F.lit(True))), F.lit(False)),
        "credit id": F.coalesce(~F.col("credit_id").rlike("^[a-z0-9][a-z0-9-]*$"), F.lit(False)),
        "credit amount": F.col("credit_id").isNotNull() & ~F.coalesce(F.col("credit_bytes") >= 0, F.lit(False)),
        "credit to itself": F.coalesce(F.col("credit_id") == F.col("id"), F.lit(False)),
    }


def resource_violations(resources: DataFrame, editions: DataFrame, members: DataFrame, replacements: DataFrame, assets: DataFrame, lists: DataFrame | None = None) -> DataFrame:
    """(entity, id, rule) for every rule that a collection breaks, by itself or against the files it names.

    editions (id, edition, target_bytes, status, reason) beside the published one, members (id, edition, asset_id),
    replacements (id, asset_id), assets (asset_id, status, sha256, format, reader_required, destination, critical). With
    ``lists`` (list_id, asset_id) replacements are (id, list_id), one list a collection: collections that replace the same
    files share it, and no row is made for each pair of both.
    """
    members = settled(members, "resource-members")
    if lists is None:
        lists, replacements = replacements.select(F.col("id").alias("list_id"), "asset_id"), replacements.select("id", F.col("id").alias("list_id")).distinct()
    r = "resource"
    own = violations(resources, r, "id", resource_rules())
    numbers = resources.where("number IS NOT NULL").groupBy("number").agg(F.count("*").alias("n")).where("n > 1").select("number")
    published = members.where("edition = 'published'").select("id", "asset_id")
    held = published.join(assets, "asset_id")
    ready = resources.where("status = 'ready'").select("id")
    stated = editions.select("id", "edition").distinct()
    listed = members.where("edition <> 'published'").join(stated, ["id", "edition"], "left_semi")
    in_edition = listed.join(assets, "asset_id")
    readable = F.lower("format").isin(*DIRECT_FORMATS) & ~F.col("reader_required") & ~F.split("destination", "/")[0].isin("ZIM", "SOFTWARE")
    pinned = (F.col("status") == "resolved") & F.coalesce(F.col("sha256").rlike(_DIGEST), F.lit(False))
    critical = held.where("critical").select("id", "asset_id").distinct()
    needed = critical.join(stated, "id").join(listed.select("id", "edition", "asset_id").distinct(), ["id", "edition", "asset_id"], "left_anti")
    zim = in_edition.where("edition = 'compact' AND lower(format) = 'zim'").select("id")
    credit = resources.where("credit_id IS NOT NULL").select("id", "credit_id")
    names = resources.select(F.col("id").alias("credit_id"))
    by_list = lambda found: replacements.join(found.select("list_id").distinct(), "list_id", "left_semi")
    once = lists.select("list_id", "asset_id").distinct()
    claims = credit.join(replacements, "id")
    met = claims.select("list_id", "credit_id").distinct().join(published.select(F.col("id").alias("credit_id"), "asset_id"), "credit_id").join(once, ["list_id", "asset_id"], "left_semi")
    met = claims.join(met.select("list_id", "credit_id").distinct(), ["list_id", "credit_id"], "left_semi")
    twice = lambda df, *keys: df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    absent = lambda df: df.join(assets.select("asset_id"), "asset_id", "left_anti")
    without = lambda df, other: df.join(other.select("id"), "id", "left_anti")
    found = [
        own,
        repeated(resources, r, "id"),
        _rows(resources.join(numbers, "number"), r, "number repeated"),
        _rows(twice(published, "id", "asset_id"), r, "member repeated"),
        _rows(by_list(twice(lists, "list_id", "asset_id")), r, "replacement repeated"),
        _rows(absent(published), r, "member unknown"),
        _rows(by_list(absent(lists)), r, "replacement unknown"),
        _rows(published.join(replacements, "id").join(once, ["list_id", "asset_id"], "left_semi"), r, "replaces its own member"),
        _rows(without(ready, published), r, "ready without members"),
        _rows(held.where("status <> 'resolved'").join(ready, "id", "left_semi"), r, "ready with unresolved members"),
        _rows(editions.where(~F.col("edition").isin(*EDITIONS)), r, "edition unknown"),
        _rows(twice(editions, "id", "edition"), r, "edition repeated"),
        _rows(editions.where("target_bytes < 0"), r, "edition target"),
        _rows(editions.where(~F.col("status").isin(*STATUSES)), r, "edition status"),
        _rows(editions.where((F.col("status") != "ready") & blank("reason")), r, "edition unexplained"),
        _rows(stated.join(listed.select("id", "edition"), ["id", "edition"], "left_anti"), r, "edition without members"),
        _rows(twice(listed, "id", "edition", "asset_id"), r, "edition member repeated"),
        _rows(absent(listed), r, "edition member unknown"),
        _rows(in_edition.where(~pinned), r, "edition member not pinned"),
        _rows(in_edition.where((F.col("edition") == "direct") & ~readable), r, "direct edition not readable"),
        _rows(without(stated.where("edition = 'compact'").select("id"), zim), r, "compact edition without archive"),
        _rows(needed, r, "edition lacks critical members"),
        _rows(without(credit, by_list(lists)), r, "credit without replacement"),
        _rows(credit.join(names, "credit_id", "left_anti"), r, "credit to an unknown collection"),
        _rows(without(credit, met), r, "credit for nothing replaced"),
    ]
    return _all(found)
