"""Constraint sets over records made of the tables: documents are assets and sources, suppliers manifests, customers profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import constraints as op
from ..operators.integrity import repeated, violations
from .registry import query, table


def _union(entity: str, rows: str, rules: dict[str, str], key: str = "id") -> str:
    """SQL of the rows that break a rule, one branch a rule."""
    return " UNION ALL ".join(f"SELECT '{entity}' AS entity, CAST({key} AS VARCHAR) AS id, '{name}' AS rule FROM {rows} WHERE {bad}" for name, bad in rules.items())


_ASSETS = """a AS (SELECT CASE WHEN doc_id % 11 = 0 THEN concat('Doc ', doc_id) ELSE concat('doc-', doc_id) END AS id,
concat(list_extract(['BOOKS', 'ZIM', 'SOFTWARE', 'MAPS', 'other'], CAST(doc_id % 5 + 1 AS INT)), CASE WHEN doc_id % 21 = 0 THEN '/..' ELSE '' END, '/', doc_id, '.x') AS destination,
CASE WHEN doc_id % 13 = 0 THEN ' ' ELSE source END AS title, list_extract(['pdf', 'txt', 'ZIM', 'exe', 'epub', 'html'], CAST(doc_id % 6 + 1 AS INT)) AS format,
CASE WHEN doc_id % 8 = 7 THEN 'strange' WHEN doc_id % 8 < 3 THEN 'guide' ELSE 'reference' END AS record_type, CASE WHEN doc_id % 23 = 0 THEN 'odd' WHEN doc_id % 17 = 0 THEN 'unresolved' ELSE 'resolved' END AS status,
CASE WHEN doc_id % 34 <> 0 THEN 'why' END AS reason, CASE WHEN doc_id % 17 <> 0 THEN n_chars END AS size_bytes,
CASE WHEN doc_id % 19 = 0 THEN 'XYZ' WHEN doc_id % 7 <> 0 THEN sha256(text) END AS sha256, doc_id % 4 = 0 AS critical, doc_id % 10 < 5 AS reader_required, doc_id % 9 = 0 AS illustrated, doc_id % 12 = 0 AS supporting,
concat(list_extract(['http://h/', 'https://u:p@h/', 'https://h/x#f', 'https:///', 'https://h', 'https://h/', 'https://h?'], CAST(least(doc_id % 14, 6) + 1 AS INT)), doc_id) AS source_url FROM documents)"""


def _assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    one = lambda names, i: F.get(F.lit(list(names)), i.cast("int"))
    text = d.cast("string")
    return table(spark, sf_dir, "documents").select(
        F.when(d % 11 == 0, F.concat(F.lit("Doc "), text)).otherwise(F.concat(F.lit("doc-"), text)).alias("id"),
        F.concat(one(("BOOKS", "ZIM", "SOFTWARE", "MAPS", "other"), d % 5), F.when(d % 21 == 0, "/..").otherwise(""), F.lit("/"), text, F.lit(".x")).alias("destination"),
        F.when(d % 13 == 0, " ").otherwise(F.col("source")).alias("title"),
        one(("pdf", "txt", "ZIM", "exe", "epub", "html"), d % 6).alias("format"),
        F.when(d % 8 == 7, "strange").when(d % 8 < 3, "guide").otherwise("reference").alias("record_type"),
        F.when(d % 23 == 0, "odd").when(d % 17 == 0, "unresolved").otherwise("resolved").alias("status"),
        F.when(d % 34 != 0, "why").alias("reason"),
        F.when(d % 17 != 0, F.col("n_chars")).alias("size_bytes"),
        F.when(d % 19 == 0, "XYZ").when(d % 7 != 0, F.sha2("text", 256)).alias("sha256"),
        (d % 4 == 0).alias("critical"),
        (d % 10 < 5).alias("reader_required"),
        (d % 9 == 0).alias("illustrated"),
        (d % 12 == 0).alias("supporting"),
        F.concat(one(("http://h/", "https://u:p@h/", "https://h/x#f", "https:///", "https://h", "https://h/", "https://h?"), F.least(d % 14, F.lit(6))), text).alias("source_url"),
    )


_ASSET_SQL = {
    "id": "NOT regexp_full_match(id, '[a-z0-9_-]+')",
    "destination": "contains(destination, '/../') OR string_split(destination, '/')[1] = 'other'",
    "title": "length(trim(title)) = 0 OR title IS NULL",
    "record type": "record_type = 'strange'",
    "supporting file counted as a document": "supporting AND (critical OR illustrated OR record_type IN ('guide', 'strange'))",
    "status": "status = 'odd'",
    "unexplained": "status = 'unresolved' AND reason IS NULL",
    "size": "CASE WHEN size_bytes IS NULL THEN status <> 'unresolved' ELSE size_bytes < 1 END",
    "checksum": "sha256 = 'XYZ'",
    "software without checksum": "sha256 IS NULL AND status = 'resolved' AND (format = 'exe' OR left(destination, 9) = 'SOFTWARE/')",
    "critical but not readable": "critical AND (reader_required OR format IN ('exe', 'ZIM'))",
    "archive without reader": "format = 'ZIM' AND NOT reader_required",
    "source": "status = 'resolved' AND (left(source_url, 8) <> 'https://' OR contains(source_url, '@') OR contains(source_url, '#') OR left(source_url, 9) = 'https:///')",
}


@query(f"WITH {_ASSETS} {_union('asset', 'a', _ASSET_SQL)}")
def asset_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _assets(spark, sf_dir)
    return violations(own, "asset", "id", op.asset_rules()).union(repeated(own, "asset", "id"))


_PROFILES = """p AS (SELECT CASE WHEN c_custkey % 9 = 0 THEN 'Bad Id' || c_custkey ELSE 'p-' || c_custkey END AS id, CAST(floor(c_acctbal * 100) AS BIGINT) AS capacity_bytes, CAST(c_nationkey * 10000 AS BIGINT) AS reserve_bytes,
CAST(c_custkey % 5 - 1 AS BIGINT) AS discovery_bytes, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey END AS target_min_bytes, CASE WHEN c_custkey % 6 <> 0 THEN 100 END AS target_max_bytes FROM customer)"""
_PROFILE_SQL = {
    "id": "NOT regexp_full_match(id, '[a-z0-9-]+')",
    "negative budget": "capacity_bytes < 0 OR reserve_bytes < 0 OR discovery_bytes < 0",
    "no usable capacity": "NOT capacity_bytes > reserve_bytes",
    "unpaired target": "(target_min_bytes IS NULL AND target_max_bytes IS NOT NULL) OR (target_min_bytes IS NOT NULL AND target_max_bytes IS NULL)",
    "target minimum over maximum": "target_min_bytes > target_max_bytes",
}


@query(f"WITH {_PROFILES} {_union('profile', 'p', _PROFILE_SQL)}")
def profile_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    own = table(spark, sf_dir, "customer").select(
        F.concat(F.when(k % 9 == 0, "Bad Id").otherwise("p-"), k.cast("string")).alias("id"),
        F.floor(F.col("c_acctbal") * 100).cast("long").alias("capacity_bytes"),
        (F.col("c_nationkey") * 10000).cast("long").alias("reserve_bytes"),
        (k % 5 - 1).cast("long").alias("discovery_bytes"),
        F.when(k % 4 != 0, k.cast("long")).alias("target_min_bytes"),
        F.when(k % 6 != 0, F.lit(100)).cast("long").alias("target_max_bytes"),
    )
    return violations(own, "profile", "id", op.profile_rules())


_TOPICS = """t AS (SELECT CASE WHEN p_partkey % 10 = 0 THEN 'T' || p_partkey ELSE 't' || p_partkey END AS id, CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 8 = 0 THEN p_name || chr(7) WHEN p_partkey % 9 = 0 THEN repeat(p_name, 100) ELSE p_name END AS title,
p_size * 40000000 AS position, p_partkey % 5 AS k, p_partkey % 3 AS j, p_partkey % 6 AS extra FROM part)"""
_TOPIC_SQL = {
    "id": "NOT regexp_full_match(id, '[a-z0-9][a-z0-9-]{0,79}')",
    "text": "title = '' OR length(title) > 500 OR contains(title, chr(7))",
    "order": "position > 1000000000",
    "own parent": "k = 0",
    "repeated parent": "j = 0",
    "unknown field": "extra = 0",
}


@query(f"WITH {_TOPICS} {_union('topic', 't', _TOPIC_SQL)}")
def navigation_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, name = F.col("p_partkey"), F.col("p_name")
    ident = F.concat(F.when(k % 10 == 0, "T").otherwise("t"), k.cast("string"))
    title = F.when(k % 7 == 0, "").when(k % 8 == 0, F.concat(name, F.lit("\x07"))).when(k % 9 == 0, F.repeat(name, 100)).otherwise(name)
    parents = F.concat(F.when(k % 5 == 0, F.array(ident)).otherwise(F.array()), F.when(k % 3 == 0, F.array(F.lit("a"), F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b"))))
    fields = F.concat(F.array(F.lit("id"), F.lit("title")), F.when(k % 6 == 0, F.array(F.lit("colour"))).otherwise(F.array(F.lit("parents"))))
    own = table(spark, sf_dir, "part").select(ident.alias("id"), title.alias("title"), parents.alias("parents"), (F.col("p_size") * 40000000).cast("long").alias("position"), fields.alias("fields"))
    return violations(own, "topic", "id", op.topic_rules(("aliases", "description", "id", "order", "parents", "related", "title")))


_LOCATORS = """l AS (SELECT event_id AS id, list_extract(['pdf-page', 'html-anchor', 'text-lines', 'archive-entry', 'other'], CAST(event_id % 5 + 1 AS INT)) AS kind, list_extract(['pdf', 'HTML', 'txt', 'zim', 'pdf', 'html', 'pdf'], CAST(event_id % 7 + 1 AS INT)) AS format,
user_id % 6 AS page, user_id % 9 AS end_page, CASE WHEN event_id % 4 = 0 THEN event_type || ' x' WHEN event_id % 9 <> 0 THEN event_type END AS anchor, CASE WHEN event_id % 4 = 1 THEN 'a/../b' WHEN event_id % 4 = 2 THEN '/a' ELSE 'a/b' END AS path, value AS seconds FROM events)"""
_LOCATOR_SQL = {
    "kind does not fit the format": "NOT ((kind = 'pdf-page' AND format = 'pdf') OR (kind = 'html-anchor' AND lower(format) = 'html') OR (kind = 'text-lines' AND format = 'txt') OR (kind = 'archive-entry' AND format = 'zim'))",
    "page": "id % 5 IN (0, 2) AND page = 0",
    "range": "id % 5 IN (0, 2) AND page > end_page",
    "anchor": "id % 5 = 1 AND (anchor IS NULL OR contains(anchor, ' '))",
    "path": "id % 5 = 3 AND path <> 'a/b'",
    "time": "NOT (seconds >= 0) OR seconds + 1 < seconds",
}


@query(f"WITH {_LOCATORS} {_union('locator', 'l', _LOCATOR_SQL)}")
def locator_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, one = F.col("event_id"), lambda names, i: F.get(F.lit(list(names)), i.cast("int"))
    own = table(spark, sf_dir, "events").select(
        e.alias("id"),
        one(("pdf-page", "html-anchor", "text-lines", "archive-entry", "other"), e % 5).alias("kind"),
        one(("pdf", "HTML", "txt", "zim", "pdf", "html", "pdf"), e % 7).alias("format"),
        (F.col("user_id") % 6).alias("page"),
        (F.col("user_id") % 9).alias("end_page"),
        F.when(e % 4 == 0, F.concat("event_type", F.lit(" x"))).when(e % 9 != 0, F.col("event_type")).alias("anchor"),
        F.when(e % 4 == 1, "a/../b").when(e % 4 == 2, "/a").otherwise("a/b").alias("path"),
        F.col("value").cast("double").alias("seconds"),
        (F.col("value") + 1).cast("double").alias("end_seconds"),
    )
    return violations(own, "locator", "id", op.locator_rules())


_RECIPES = """r AS (SELECT CASE WHEN o_orderkey % 8 = 0 THEN '-' ELSE 'r' END || o_orderkey AS id, CASE WHEN o_orderkey % 9 = 0 THEN '  ' ELSE '1' END AS version, list_extract(['approved', 'pending', 'lost'], CAST(o_custkey % 3 + 1 AS INT)) AS review,
o_orderkey AS k, o_custkey % 4 AS evidence, o_orderkey % 5 AS blockers, o_orderkey % 6 = 0 AS overlap FROM orders),
i AS (SELECT DISTINCT r.id, l_partkey, p_size > 25 AS pinned, review FROM r JOIN lineitem ON l_orderkey = k LEFT JOIN part ON p_partkey = l_partkey)"""
_RECIPE_SQL = {
    "id": "left(id, 1) = '-'",
    "version": "trim(version) = ''",
    "inputs and outputs overlap": "overlap AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = k)",
    "repeated input": "EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = k GROUP BY l_partkey HAVING count(*) > 1)",
    "review": "review = 'lost'",
    "approved without evidence": "review = 'approved' AND evidence = 0",
    "approved with blockers": "review = 'approved' AND blockers = 0",
}


@query(f"WITH {_RECIPES} {_union('recipe', 'r', _RECIPE_SQL)} UNION ALL SELECT DISTINCT 'recipe', id, 'input without pin' FROM i WHERE review = 'approved' AND pinned IS NOT TRUE")
def recipe_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_partkey").cast("string")).alias("inputs"))
    k, none = F.col("o_orderkey"), F.array().cast("array<string>")
    own = table(spark, sf_dir, "orders").join(inputs, k == F.col("l_orderkey"), "left").withColumn("inputs", F.coalesce("inputs", none))
    own = own.select(
        F.concat(F.when(k % 8 == 0, "-").otherwise("r"), k.cast("string")).alias("id"),
        F.when(k % 9 == 0, "  ").otherwise("1").alias("version"),
        "inputs",
        F.when(k % 6 == 0, F.slice("inputs", 1, 1)).otherwise(F.array(F.lit("out"))).alias("outputs"),
        F.get(F.array(F.lit("approved"), F.lit("pending"), F.lit("lost")), (F.col("o_custkey") % 3).cast("int")).alias("review"),
        F.when(F.col("o_custkey") % 4 == 0, none).otherwise(F.array(F.lit("seen"))).alias("evidence"),
        F.when(k % 5 == 0, F.array(F.lit("open"))).otherwise(none).alias("blockers"),
    )
    assets = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), F.when(F.col("p_size") > 25, "pin").alias("sha256"))
    return violations(own, "recipe", "id", op.recipe_rules()).union(op.unpinned_inputs(own, assets))


_SOURCES = """s AS (SELECT page_id AS id, page_id % 50 AS manifest_id, 'https://' || (page_id % 300) || CASE WHEN page_id % 13 = 0 THEN '/#x' ELSE '/' END AS url, CASE WHEN page_id % 7 = 0 THEN '' ELSE 'v' END AS version,
length(html) - CASE WHEN page_id % 31 = 0 THEN length(html) ELSE 0 END AS size_bytes, CASE WHEN page_id % 17 = 0 THEN upper(sha256(html)) WHEN page_id % 5 > 0 THEN sha256(html) END AS sha256, page_id % 29 * 4 AS evidence FROM pages),
t AS (SELECT manifest_id, sum(size_bytes) AS own FROM s GROUP BY 1),
m AS (SELECT s_suppkey AS id, coalesce(own, 0) AS own, coalesce(own, 0) + CASE WHEN s_suppkey % 4 = 0 THEN 1 ELSE 0 END AS download_bytes, s_nationkey * 100 AS other_bytes, s_suppkey % 3 * 10 AS slack FROM supplier LEFT JOIN t ON manifest_id = s_suppkey)"""
_SOURCE_SQL = {"version": "version = ''", "size": "size_bytes = 0 OR size_bytes IS NULL", "checksum": "id % 17 = 0 AND sha256 IS NOT NULL AND sha256 <> lower(sha256)", "evidence": "evidence NOT BETWEEN 1 AND 100", "source": "contains(url, '#')"}
_MANIFEST_SQL = {"download budget is not the sum of its sources": "download_bytes <> own", "peak leaves out components": "slack < 10"}


@query(f"""WITH {_SOURCES} {_union('source', 's', _SOURCE_SQL)} UNION ALL {_union('manifest', 'm', _MANIFEST_SQL)}
UNION ALL SELECT 'source', CAST(id AS VARCHAR), 'repeated id' FROM s GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'source', url, 'repeated address' FROM s GROUP BY url HAVING count(*) > 1""")
def capture_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, none = F.col("page_id"), F.array().cast("array<string>")
    sources = table(spark, sf_dir, "pages").select(
        p.alias("id"),
        (p % 50).alias("manifest_id"),
        F.concat(F.lit("https://"), (p % 300).cast("string"), F.when(p % 13 == 0, "/#x").otherwise("/")).alias("url"),
        F.when(p % 7 == 0, "").otherwise("v").alias("version"),
        F.when(p % 31 == 0, F.when(F.col("html").isNotNull(), 0)).otherwise(F.length("html")).cast("long").alias("size_bytes"),
        F.when(p % 17 == 0, F.upper(F.sha2("html", 256))).when(p % 5 > 0, F.sha2("html", 256)).alias("sha256"),
        F.when(p % 29 == 0, none).otherwise(F.array_repeat(F.lit("seen"), (p % 29 * 4).cast("int"))).alias("evidence"),
    )
    sums = sources.groupBy(F.col("manifest_id").alias("s_suppkey")).agg(F.sum("size_bytes").alias("own"))
    m, k = table(spark, sf_dir, "supplier").join(sums, "s_suppkey", "left"), F.col("s_suppkey")
    m = m.select(k.alias("id"), (F.coalesce("own", F.lit(0)) + F.when(k % 4 == 0, 1).otherwise(0)).alias("download_bytes"), (F.col("s_nationkey") * 100).cast("long").alias("other_bytes"), F.lit(10).cast("long").alias("metadata_bytes"), (k % 3 * 10).cast("long").alias("slack"))
    return op.capture_violations(sources, m.withColumn("peak_bytes", F.col("download_bytes") + F.col("other_bytes") + F.col("slack")))


@query("""WITH a AS (SELECT CAST(o_custkey AS BIGINT) AS id, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT CAST(o_custkey AS BIGINT) AS id, count(DISTINCT l_orderkey) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1),
c AS (SELECT CAST(c_custkey AS BIGINT) AS id, CAST(c_custkey % 30 AS BIGINT) AS n FROM customer)
SELECT coalesce(a.id, b.id) AS id, 'lines' AS document, b.n AS value, a.n AS expected FROM a FULL JOIN b ON a.id = b.id WHERE a.n IS DISTINCT FROM b.n
UNION ALL SELECT coalesce(a.id, c.id), 'customers', c.n, a.n FROM a FULL JOIN c ON a.id = c.id WHERE a.n IS DISTINCT FROM c.n""")
def postflight_equalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of each customer's orders as three documents state them."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    counted = orders.groupBy(F.col("o_custkey").cast("long").alias("id")).agg(F.count("*").alias("n"))
    by_line = orders.join(lines, "o_orderkey", "left_semi").groupBy(F.col("o_custkey").cast("long").alias("id")).agg(F.count_distinct("o_orderkey").alias("n"))
    stated = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("id"), (F.col("c_custkey") % 30).cast("long").alias("n"))
    return op.unequal({"orders": counted, "lines": by_line, "customers": stated}, "id", "n")


@query("""WITH item AS (SELECT p_brand, p_partkey, p_size FROM part), s AS (SELECT p_brand, count(*) AS n, sum(p_size) AS bytes FROM item GROUP BY 1),
t AS (SELECT p_brand, n + CASE WHEN length(p_brand) % 2 = 0 THEN 1 ELSE 0 END AS n, bytes + CASE WHEN right(p_brand, 1) IN ('1', '2') THEN 5 ELSE 0 END AS bytes FROM s)
SELECT 'group' AS entity, t.p_brand AS id, 'count differs' AS rule FROM t JOIN s ON s.p_brand = t.p_brand WHERE t.n <> s.n UNION ALL SELECT 'group', t.p_brand, 'bytes differ' FROM t JOIN s ON s.p_brand = t.p_brand WHERE t.bytes <> s.bytes
UNION ALL SELECT DISTINCT 'assignment', CAST(l_partkey + l_linenumber % 2 * 100000000 AS VARCHAR), 'unknown item_id' FROM lineitem WHERE l_linenumber % 2 = 1 OR l_partkey NOT IN (SELECT p_partkey FROM part)""")
def capacity_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "part").select(F.col("p_brand").alias("group_id"), F.col("p_partkey").cast("long").alias("item_id"), F.col("p_size").cast("long").alias("bytes"))
    totals = items.groupBy(F.col("group_id").alias("id")).agg((F.count("*") + F.when(F.length("group_id") % 2 == 0, 1).otherwise(0)).alias("n"), (F.sum("bytes") + F.when(F.right("group_id", F.lit(1)).isin("1", "2"), 5).otherwise(0)).alias("bytes"))
    assigned = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") + F.col("l_linenumber") % 2 * 100000000).cast("long").alias("item_id"))
    return op.capacity_violations(totals, items, assigned)


@query("""WITH m AS (SELECT doc_id AS manifest_id, sha256(concat('m', doc_id)) AS digest, n_chars AS size_bytes, CASE WHEN doc_id % 3 > 0 THEN sha256(text) END AS sha FROM documents),
r AS (SELECT l.doc_id AS id, l.doc_id + CASE WHEN l.doc_id % 11 = 0 THEN 100000000 ELSE 0 END AS manifest_id, l.doc_id % 5 = 0 AS other, d.n_chars, d.text FROM labels l LEFT JOIN documents d ON d.doc_id = l.doc_id)
SELECT 'receipt' AS entity, CAST(id AS VARCHAR) AS id, 'unknown manifest' AS rule FROM r WHERE manifest_id NOT IN (SELECT manifest_id FROM m)
UNION ALL SELECT 'receipt', CAST(id AS VARCHAR), 'other manifest' FROM r JOIN m USING (manifest_id) WHERE other
UNION ALL SELECT 'receipt', CAST(id AS VARCHAR), 'size' FROM r JOIN m USING (manifest_id) WHERE id % 7 = 0 OR m.size_bytes IS NULL
UNION ALL SELECT 'receipt', CAST(id AS VARCHAR), 'checksum' FROM r JOIN m USING (manifest_id) WHERE id % 4 = 0 AND sha IS NOT NULL""")
def receipt_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, d = table(spark, sf_dir, "documents"), F.col("doc_id")
    digest = lambda c: F.sha2(F.concat(F.lit("m"), c.cast("string")), 256)
    manifests = docs.select(d.alias("manifest_id"), digest(d).alias("digest"), F.col("n_chars").alias("size_bytes"), F.when(d % 3 > 0, F.sha2("text", 256)).alias("sha256"))
    receipts = table(spark, sf_dir, "labels").select("doc_id").join(docs.select("doc_id", "text", "n_chars"), "doc_id", "left").select(
        d.alias("id"),
        (d + F.when(d % 11 == 0, 100000000).otherwise(0)).alias("manifest_id"),
        F.when(d % 5 == 0, digest(-d)).otherwise(digest(d)).alias("manifest_sha256"),
        (F.col("n_chars") + F.when(d % 7 == 0, 1).otherwise(0)).alias("size_bytes"),
        F.when(d % 4 == 0, F.lit("other")).otherwise(F.sha2("text", 256)).alias("sha256"),
    )
    return op.receipt_violations(receipts, manifests)


_PHASES = """p AS (SELECT o_orderkey AS id, o_custkey AS download, o_orderkey % 50 AS expanded, o_custkey % 7 - 1 AS preview, 5 AS scratch, o_orderkey % 3 AS cache, 100 AS metadata, CAST(floor(o_totalprice / 100) AS BIGINT) AS budget, o_custkey % 40 AS measured FROM orders)"""
_PHASE_SQL = {"negative": "preview = -1 OR budget < 0", "expansion over its allowance": "measured > expanded", "budget leaves out components": "download + expanded + preview + scratch + cache + metadata - budget > 0"}


@query(f"WITH {_PHASES} {_union('phase', 'p', _PHASE_SQL)}")
def phase_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    values = {"download": c, "expanded": k % 50, "preview": c % 7 - 1, "scratch": F.lit(5), "cache": k % 3, "metadata": F.lit(100), "budget": F.floor(F.col("o_totalprice") / 100), "measured": c % 40}
    own = table(spark, sf_dir, "orders").select(k.alias("id"), *[v.cast("long").alias(name) for name, v in values.items()])
    return violations(own, "phase", "id", op.phase_rules())


_FILES = """f AS (SELECT concat('p', p_partkey) AS id, p_partkey AS k, p_size AS z, CASE WHEN p_partkey % 12 = 5 THEN concat('p', p_partkey - CASE WHEN p_partkey % 60 = 5 THEN 0 WHEN p_partkey % 36 = 5 THEN 5000000 ELSE 1 END) END AS source_id, p_partkey % 24 <> 5 AS document,
CASE WHEN p_size = 9 THEN 'unresolved' ELSE 'resolved' END AS status, CASE WHEN p_size % 8 <> 5 THEN repeat('a', 64) END AS sha256, CASE WHEN p_partkey % 12 IN (4, 5) AND p_size <> 7 THEN 'zip' ELSE 'pdf' END AS format, p_partkey % 12 = 4 AND p_size % 5 > 0 AS supporting, p_size % 6 = 0 AS critical, false AS illustrated, 'reference' AS record_type,
concat('https://h/', CASE WHEN p_partkey % 12 = 5 AND p_size % 4 > 0 THEN p_partkey - 1 ELSE p_partkey END) AS source_url, CASE WHEN p_size = 13 THEN ['http://m/'] ELSE ['https://m/'] END AS mirrors, CASE WHEN p_size = 14 THEN ' ' ELSE 'c' END AS category, CASE WHEN p_size <> 15 THEN 'v' END AS version, CASE WHEN p_size = 16 THEN '' ELSE 'l' END AS license,
CASE WHEN p_size = 17 THEN NULL ELSE ['a'] END AS profiles, CASE WHEN p_size % 11 = 0 THEN '../x' ELSE 'x/y' END AS member_path, CAST(CASE WHEN p_size = 9 THEN NULL ELSE p_size - 2 END AS BIGINT) AS size_bytes, p_partkey % 3 = 0 AS generated,
CASE WHEN p_partkey % 10 = 0 THEN concat('BOOKS/', p_partkey + 1, '.x/', p_partkey) WHEN p_partkey % 10 = 3 THEN concat('books/', p_partkey + 1, '.X') ELSE concat('BOOKS/', p_partkey, '.x') END AS destination FROM part)"""
_LIST_SQL = {
    "category": "category = ' '", "version": "version IS NULL", "license": "license = ''", "mirrors": "z = 13", "profiles": "profiles IS NULL",
    "size": "status <> 'unresolved' AND size_bytes < CASE WHEN source_id IS NOT NULL OR generated AND supporting THEN 0 ELSE 1 END", "member path": "source_id IS NOT NULL AND member_path = '../x'",
}
_MEMBER_SQL = {
    "archive is unknown": "o.id IS NULL", "archive is the file itself": "f.source_id = f.id", "archive is a member": "o.source_id IS NOT NULL", "archive is no ZIP": "o.format <> 'zip'", "archive is not pinned": "o.status = 'unresolved' OR (o.id IS NOT NULL AND o.sha256 IS NULL)",
    "archive is no supporting file": "NOT o.supporting", "member is not pinned": "f.status = 'unresolved' OR f.sha256 IS NULL", "member has another address": "f.source_url <> o.source_url OR f.mirrors <> o.mirrors", "member that is no document counted as one": "NOT f.document AND f.critical",
}
_PATHS = """w AS (SELECT id, lower(destination) AS key, string_split(lower(destination), '/') AS parts FROM f), dir AS (SELECT DISTINCT array_to_string(parts[1:n], '/') AS key FROM w, range(1, 4) r(n) WHERE n < len(parts))
SELECT 'asset' AS entity, id, 'path: same but for case' AS rule FROM w WHERE key IN (SELECT key FROM w GROUP BY key HAVING count(*) > 1) UNION ALL SELECT 'asset', id, 'path: file and folder' FROM w WHERE key IN (SELECT key FROM dir)"""


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, z, none = F.col("p_partkey"), F.col("p_size"), F.lit(None)
    name = lambda c: F.concat(F.lit("p"), c.cast("string"))
    back = F.when(k % 60 == 5, 0).when(k % 36 == 5, 5000000).otherwise(1)
    return table(spark, sf_dir, "part").select(
        name(k).alias("id"), F.when(k % 12 == 5, name(k - back)).alias("source_id"), (k % 24 != 5).alias("document"),
        F.when(z == 9, "unresolved").otherwise("resolved").alias("status"), F.when(z % 8 != 5, F.repeat(F.lit("a"), 64)).alias("sha256"),
        F.when((k % 12).isin(4, 5) & (z != 7), "zip").otherwise("pdf").alias("format"), ((k % 12 == 4) & (z % 5 > 0)).alias("supporting"), (z % 6 == 0).alias("critical"),
        F.lit(False).alias("illustrated"), F.lit("reference").alias("record_type"), F.concat(F.lit("https://h/"), F.when((k % 12 == 5) & (z % 4 > 0), k - 1).otherwise(k).cast("string")).alias("source_url"),
        F.array(F.when(z == 13, "http://m/").otherwise("https://m/")).alias("mirrors"), F.when(z == 14, " ").otherwise("c").alias("category"), F.when(z != 15, "v").alias("version"), F.when(z == 16, "").otherwise("l").alias("license"),
        F.when(z != 17, F.array(F.lit("a"))).alias("profiles"), F.when(z % 11 == 0, "../x").otherwise("x/y").alias("member_path"), F.when(z == 9, none).otherwise(z - 2).cast("long").alias("size_bytes"), (k % 3 == 0).alias("generated"),
        F.when(k % 10 == 0, F.concat(F.lit("BOOKS/"), (k + 1).cast("string"), F.lit(".x/"), k.cast("string"))).when(k % 10 == 3, F.concat(F.lit("books/"), (k + 1).cast("string"), F.lit(".X"))).otherwise(F.concat(F.lit("BOOKS/"), k.cast("string"), F.lit(".x"))).alias("destination"),
    )


@query(f"WITH {_FILES} {_union('asset', 'f', _LIST_SQL)} UNION ALL {_union('asset', 'f LEFT JOIN f o ON o.id = f.source_id', {k: f'f.source_id IS NOT NULL AND ({v})' for k, v in _MEMBER_SQL.items()}, 'f.id')}")
def archive_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists, texts and archive members of assets."""
    own = _files(spark, sf_dir)
    return violations(own, "asset", "id", op.asset_list_rules()).union(op.archive_members(own))


@query(f"WITH {_FILES}, {_PATHS}")
def destination_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.path_violations(_files(spark, sf_dir))


_COLLECTIONS = """r AS (SELECT s_suppkey AS s, CASE WHEN s_suppkey % 31 = 7 THEN concat('Bad ', s_suppkey) ELSE concat('s', s_suppkey) END AS id, CASE WHEN s_suppkey % 29 = 3 THEN ' ' ELSE s_name END AS title, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey // 4 END AS number, CAST(s_suppkey - 2 AS BIGINT) AS target_bytes,
CASE WHEN s_suppkey % 23 = 4 THEN 'odd' WHEN s_suppkey % 3 = 0 THEN 'partial' ELSE 'ready' END AS status, CASE WHEN s_suppkey % 6 <> 0 THEN 'why' END AS reason, CASE WHEN s_suppkey % 7 = 1 THEN concat('s', CASE WHEN s_suppkey % 14 = 1 THEN s_suppkey WHEN s_suppkey % 21 = 1 THEN 9999999 ELSE s_suppkey + 1 END) END AS credit_id, CAST(s_suppkey % 5 - 1 AS BIGINT) AS credit_bytes FROM supplier, range(2) t(twice) WHERE twice = 0 OR s_suppkey % 43 = 11), rd AS (SELECT DISTINCT s, id FROM r),
base AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS a FROM lineitem WHERE l_suppkey % 37 <> 1), m AS (SELECT s, 'published' AS edition, a + CASE WHEN s % 13 = 2 AND a % 50 = 0 THEN 7000000 ELSE 0 END AS a FROM base UNION ALL SELECT s, 'published', a FROM base WHERE s % 11 = 5 AND a % 40 = 1),
a AS (SELECT p_partkey AS a, CASE WHEN p_size = 9 AND p_partkey % 7 = 0 THEN 'unresolved' ELSE 'resolved' END AS status, p_size % 40 <> 5 AS pinned, CASE WHEN p_partkey % 25 = 0 THEN 'zim' ELSE 'pdf' END AS format, p_partkey % 97 = 0 AS critical FROM part),
e AS (SELECT s, 'direct' AS edition, CAST(s - 20 AS BIGINT) AS target, CASE WHEN s % 5 = 0 THEN 'odd' ELSE 'ready' END AS status FROM rd WHERE s % 3 = 0 UNION ALL SELECT s, 'compact', 5, 'partial' FROM rd WHERE s % 4 = 1 UNION ALL SELECT s, 'other', 5, 'ready' FROM rd WHERE s % 17 = 0 UNION ALL SELECT s, 'direct', 5, 'ready' FROM rd WHERE s % 33 = 0),
em AS (SELECT e.s, e.edition, b.a FROM (SELECT DISTINCT s, edition FROM e) e JOIN base b ON b.s = e.s WHERE e.edition = 'direct' AND b.a % 3 = 0 OR e.edition = 'compact' AND b.a % 5 = e.s % 5 UNION ALL SELECT s, 'direct', a + 8000000 FROM base WHERE s % 12 = 0 AND a % 30 = 0),
rp AS (SELECT s_suppkey AS s, p_partkey AS a FROM supplier JOIN part ON p_partkey % 100 = s_suppkey % 100 WHERE s_suppkey % 5 = 1)"""
_COLLECTION_SQL = """SELECT id, 'id' AS rule FROM r WHERE left(id, 3) = 'Bad' UNION ALL SELECT id, 'title' FROM r WHERE title = ' ' UNION ALL SELECT id, 'number' FROM r WHERE number < 1 UNION ALL SELECT id, 'target' FROM r WHERE target_bytes < 0 UNION ALL SELECT id, 'status' FROM r WHERE status = 'odd'
UNION ALL SELECT id, 'unexplained' FROM r WHERE status <> 'ready' AND reason IS NULL UNION ALL SELECT id, 'device status' FROM r WHERE s % 8 = 0 AND s % 16 = 0 UNION ALL SELECT id, 'device reason' FROM r WHERE s % 8 = 0 AND s % 24 = 0 UNION ALL SELECT id, 'device evidence repeated' FROM r WHERE s % 8 = 0 AND s % 5 = 0
UNION ALL SELECT id, 'device passed without evidence' FROM r WHERE s % 8 = 0 AND s % 16 <> 0 AND s % 5 = 1 UNION ALL SELECT id, 'source page' FROM r WHERE s % 19 = 0 UNION ALL SELECT id, 'credit amount' FROM r WHERE credit_id IS NOT NULL AND credit_bytes < 0 UNION ALL SELECT id, 'credit to itself' FROM r WHERE credit_id = id
UNION ALL SELECT id, 'repeated id' FROM r GROUP BY id HAVING count(*) > 1
UNION ALL SELECT DISTINCT id, rule FROM (SELECT id, 'number repeated' AS rule FROM r WHERE number IN (SELECT number FROM r GROUP BY number HAVING count(*) > 1) UNION ALL SELECT id, 'member repeated' FROM rd JOIN m ON m.s = rd.s GROUP BY id, a HAVING count(*) > 1 UNION ALL SELECT id, 'member unknown' FROM r JOIN m ON m.s = r.s WHERE a NOT IN (SELECT a FROM a)
UNION ALL SELECT id, 'replaces its own member' FROM r JOIN rp ON rp.s = r.s JOIN m ON m.s = rp.s AND m.a = rp.a UNION ALL SELECT id, 'ready without members' FROM r WHERE status = 'ready' AND s NOT IN (SELECT s FROM m)
UNION ALL SELECT id, 'ready with unresolved members' FROM r JOIN m ON m.s = r.s JOIN a ON a.a = m.a WHERE r.status = 'ready' AND a.status <> 'resolved' UNION ALL SELECT id, 'edition unknown' FROM r JOIN e ON e.s = r.s WHERE edition = 'other' UNION ALL SELECT id, 'edition repeated' FROM rd JOIN e ON e.s = rd.s GROUP BY id, edition HAVING count(*) > 1
UNION ALL SELECT id, 'edition target' FROM r JOIN e ON e.s = r.s WHERE target < 0 UNION ALL SELECT id, 'edition status' FROM r JOIN e ON e.s = r.s WHERE e.status = 'odd' UNION ALL SELECT id, 'edition unexplained' FROM r JOIN e ON e.s = r.s WHERE e.status <> 'ready' AND e.s % 8 <> 5
UNION ALL SELECT id, 'edition without members' FROM r JOIN e ON e.s = r.s WHERE NOT EXISTS (SELECT 1 FROM em WHERE em.s = e.s AND em.edition = e.edition) UNION ALL SELECT id, 'edition member unknown' FROM r JOIN em ON em.s = r.s WHERE a NOT IN (SELECT a FROM a)
UNION ALL SELECT id, 'edition member not pinned' FROM r JOIN em ON em.s = r.s JOIN a ON a.a = em.a WHERE a.status <> 'resolved' OR NOT pinned UNION ALL SELECT id, 'direct edition not readable' FROM r JOIN em ON em.s = r.s JOIN a ON a.a = em.a WHERE edition = 'direct' AND format = 'zim'
UNION ALL SELECT id, 'compact edition without archive' FROM r JOIN e ON e.s = r.s WHERE edition = 'compact' AND NOT EXISTS (SELECT 1 FROM em JOIN a ON a.a = em.a WHERE em.s = r.s AND em.edition = 'compact' AND format = 'zim')
UNION ALL SELECT id, 'edition lacks critical members' FROM r JOIN e ON e.s = r.s JOIN m ON m.s = r.s JOIN a ON a.a = m.a WHERE critical AND NOT EXISTS (SELECT 1 FROM em WHERE em.s = e.s AND em.edition = e.edition AND em.a = m.a)
UNION ALL SELECT id, 'credit without replacement' FROM r WHERE credit_id IS NOT NULL AND s NOT IN (SELECT s FROM rp) UNION ALL SELECT id, 'credit to an unknown collection' FROM r WHERE credit_id NOT IN (SELECT id FROM r)
UNION ALL SELECT id, 'credit for nothing replaced' FROM r WHERE credit_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM r o JOIN m ON m.s = o.s JOIN rp ON rp.s = r.s AND rp.a = m.a WHERE o.id = r.credit_id))"""


@query(f"WITH {_COLLECTIONS} SELECT 'resource' AS entity, id, rule FROM ({_COLLECTION_SQL})")
def resource_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers are collections of the parts they deliver, with editions, replacements and credits that break each rule."""
    s, supplier, part = F.col("s"), table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "s"), table(spark, sf_dir, "part")
    ident = F.concat(F.when(s % 31 == 7, "Bad ").otherwise("s"), s.cast("string"))
    names = supplier.select("s", ident.alias("id"))
    evidence = F.when(s % 5 == 0, F.array(F.lit("x"), F.lit("x"))).when(s % 5 == 1, F.array().cast("array<string>")).otherwise(F.array(F.lit("x")))
    device = F.when(s % 8 == 0, F.struct(F.when(s % 16 == 0, "odd").otherwise("passed").alias("status"), F.when(s % 24 == 0, " ").otherwise("why").alias("reason"), evidence.alias("evidence")))
    credit = F.when(s % 14 == 1, s).when(s % 21 == 1, 9999999).otherwise(s + 1)
    resources = supplier.union(supplier.where("s % 43 = 11")).select(
        ident.alias("id"), F.when(s % 29 == 3, " ").otherwise(F.col("s_name")).alias("title"), F.when(s % 2 == 0, F.expr("s DIV 4")).alias("number"), (s - 2).cast("long").alias("target_bytes"),
        F.when(s % 23 == 4, "odd").when(s % 3 == 0, "partial").otherwise("ready").alias("status"), F.when(s % 6 != 0, "why").alias("reason"), device.alias("device"),
        F.array(F.when(s % 19 == 0, "http://h/").otherwise("https://h/")).alias("source_pages"), F.when(s % 7 == 1, F.concat(F.lit("s"), credit.cast("string"))).alias("credit_id"), (s % 5 - 1).cast("long").alias("credit_bytes"),
    )
    base = table(spark, sf_dir, "lineitem").where("l_suppkey % 37 <> 1").select(F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("a")).distinct()
    a = F.col("a")
    shown = base.select("s", F.lit("published").alias("edition"), (a + F.when((s % 13 == 2) & (a % 50 == 0), 7000000).otherwise(0)).alias("asset_id")).union(base.where("s % 11 = 5 AND a % 40 = 1").select("s", F.lit("published"), "a"))
    row = lambda edition, target, status: F.struct(F.lit(edition).alias("edition"), target.cast("long").alias("target_bytes"), status.alias("status"))
    kinds = F.array(F.when(s % 3 == 0, row("direct", s - 20, F.when(s % 5 == 0, "odd").otherwise("ready"))), F.when(s % 4 == 1, row("compact", F.lit(5), F.lit("partial"))), F.when(s % 17 == 0, row("other", F.lit(5), F.lit("ready"))), F.when(s % 33 == 0, row("direct", F.lit(5), F.lit("ready"))))
    editions = supplier.select("s", F.explode(F.array_compact(kinds)).alias("x")).select("s", "x.*")
    editions = editions.withColumn("reason", F.when(s % 8 == 5, "why"))
    own = editions.select("s", "edition").distinct().join(base, "s")
    listed = own.where("edition = 'direct' AND a % 3 = 0 OR edition = 'compact' AND a % 5 = s % 5").select("s", "edition", F.col("a").alias("asset_id")).union(base.where("s % 12 = 0 AND a % 30 = 0").select("s", F.lit("direct"), a + 8000000))
    k, z = F.col("p_partkey"), F.col("p_size")
    assets = part.select(k.alias("asset_id"), F.when((z == 9) & (k % 7 == 0), "unresolved").otherwise("resolved").alias("status"), F.when(z % 40 != 5, F.repeat(F.lit("a"), 64)).alias("sha256"), F.when(k % 25 == 0, "zim").otherwise("pdf").alias("format"), F.lit(False).alias("reader_required"), F.lit("BOOKS/x").alias("destination"), (k % 97 == 0).alias("critical"))
    lists = part.select((k % 100).alias("list_id"), k.alias("asset_id"))
    with_id = lambda df, *columns: df.join(names, "s").select("id", *columns)
    return op.resource_violations(resources, with_id(editions, "edition", "target_bytes", "status", "reason"), with_id(shown.union(listed), "edition", "asset_id"), names.where("s % 5 = 1").select("id", (s % 100).alias("list_id")), assets, lists)
