"""Web pages: links, structure, paths and URL rules, in patterns that both engines read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import markup
from ..operators import links, sections
from .registry import query, statement, table

_S = "[[STRING||VARCHAR]]"
_ALL = lambda col, pattern, group: f"[[regexp_extract_all({col}, '{pattern}', {group})||regexp_extract_all({col}, '{pattern}', {group})]]"
_EACH = lambda col, pattern, group: f"[[explode(regexp_extract_all({col}, '{pattern}', {group}))||unnest(regexp_extract_all({col}, '{pattern}', {group}))]]"
_LEN = lambda x: f"CAST([[size({x})||len({x})]] AS BIGINT)"
_COUNT = lambda tag: f"CAST([[size(split(lower(html), '<{tag}[ >]')) - 1||len(regexp_split_to_array(lower(html), '<{tag}[ >]')) - 1]] AS BIGINT) AS n_{tag}"
_HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"
_PATH = "regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
_HREF = "<a href=\"([^\"]*)\""

statement("page_link_inventory", f"SELECT page_id, href, count(*) AS n FROM (SELECT page_id, {_EACH('html', _HREF, 1)} AS href FROM {{pages}}) GROUP BY page_id, href")
statement("page_structure", f"SELECT page_id, {', '.join(_COUNT(t) for t in ('img', 'table', 'p', 'h1', 'h2', 'li', 'a'))}, CAST(length(html) AS BIGINT) AS n_chars, CAST(length(html) - length(replace(html, '&', '')) AS BIGINT) AS entities FROM {{pages}}")
statement("link_integrity", f"""WITH link AS (SELECT page_id, {_EACH('html', _HREF, 1)} AS href FROM {{pages}}), known AS (SELECT DISTINCT {_PATH} AS path FROM {{pages}})
SELECT href, count(*) AS uses, count(DISTINCT page_id) AS on_pages, max(CASE WHEN k.path IS NULL THEN 1 ELSE 0 END) = 1 AS dangling FROM link LEFT JOIN known k ON k.path = href GROUP BY href""")
statement("url_policy", f"""SELECT page_id, {_HOST} AS host, url LIKE 'https://%' AS secure, NOT contains({_HOST}, '@') AND length({_HOST}) > 0 AND NOT contains(url, '..') AS safe, contains(url, '#') AS has_fragment FROM {{pages}}""")
statement("path_conflicts", f"""WITH p AS (SELECT page_id, lower({_PATH}) AS path FROM {{pages}}), parent AS (SELECT DISTINCT [[regexp_replace(path, '/[^/]*$', '')||regexp_replace(path, '/[^/]*$', '')]] AS prefix FROM p)
SELECT path, count(*) AS n, max(CASE WHEN prefix IS NULL THEN 0 ELSE 1 END) = 1 AS is_directory_too FROM p LEFT JOIN parent ON prefix = path GROUP BY path HAVING count(*) > 1 OR max(CASE WHEN prefix IS NULL THEN 0 ELSE 1 END) = 1""")
statement("relative_links", f"""WITH link AS (SELECT page_id, {_EACH('html', _HREF, 1)} AS href FROM {{pages}})
SELECT page_id, href, CASE WHEN href LIKE 'http%' THEN 'external' WHEN href LIKE '/%' THEN 'absolute' WHEN href = '' THEN 'empty' ELSE 'relative' END AS kind, count(*) AS n FROM link GROUP BY 1, 2, 3""")
statement("href_builder", f"SELECT page_id, concat('files', replace(replace({_PATH}, '%', '%25'), ' ', '%20'), '#page=', CAST(page_id AS {_S})) AS href FROM {{pages}}")
@query(f"""WITH p AS (SELECT page_id, concat('static/', list_extract(string_split({_PATH}, '/'), -1)) AS path FROM pages)
SELECT a.page_id, min(b.page_id) AS partner FROM p a JOIN p b ON a.path = b.path AND b.page_id > a.page_id GROUP BY a.page_id""")
def derived_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's next one with the same derived path: the one after it by number, so no pairs are made."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("static/"), F.element_at(F.split(F.expr(_PATH), "/"), -1)).alias("path")).distinct()
    after = F.lead("page_id").over(Window.partitionBy("path").orderBy("page_id"))
    return pages.withColumn("partner", after).where("partner IS NOT NULL").groupBy("page_id").agg(F.min("partner").alias("partner"))


statement("span_replace", "SELECT page_id, [[sha2(replace(html, '<h1>', '<h2>'), 256)||sha256(replace(html, '<h1>', '<h2>'))]] AS repaired FROM {pages} WHERE (length(html) - length(replace(html, '<h1>', ''))) = 4")
statement("resolve_cascade", f"""WITH link AS (SELECT page_id, {_EACH('html', _HREF, 1)} AS href FROM {{pages}}), known AS (SELECT DISTINCT {_PATH} AS path FROM {{pages}}),
r AS (SELECT page_id, href, coalesce(k1.path, k2.path) AS target, k1.path IS NOT NULL AS direct FROM link LEFT JOIN known k1 ON k1.path = href LEFT JOIN known k2 ON k2.path = concat(href, '/index.html'))
SELECT CASE WHEN direct THEN 'member' WHEN target IS NOT NULL THEN 'index' WHEN href LIKE 'http%' THEN 'remote' ELSE 'issue' END AS status, count(*) AS n, count(DISTINCT href) AS targets FROM r GROUP BY 1""")
statement("page_stats", """SELECT source, count(*) AS pages, CAST(sum(CASE WHEN n_chars >= 80 THEN 1 ELSE 0 END) AS BIGINT) AS text_pages, CAST(sum(CASE WHEN n_chars >= 80 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) < 0.8 AS flagged, max(CASE WHEN trim(text) = '' THEN 1 ELSE 0 END) = 1 AS any_blank FROM {documents} GROUP BY source""")
statement("heading_outline_twin", f"""WITH h AS (SELECT page_id, [[posexplode(regexp_extract_all(html, '<(h[1-6])>', 1)) AS (pos, tag)||unnest(range(len(regexp_extract_all(html, '<(h[1-6])>', 1)))) AS pos, unnest(regexp_extract_all(html, '<(h[1-6])>', 1)) AS tag]] FROM {{pages}}),
l AS (SELECT page_id, CAST(pos AS BIGINT) AS pos, CAST(substring(tag, 2, 1) AS INT) AS level FROM h)
SELECT a.page_id, a.pos, a.level, max(b.pos) AS parent FROM l a LEFT JOIN l b ON b.page_id = a.page_id AND b.pos < a.pos AND b.level < a.level GROUP BY a.page_id, a.pos, a.level""")


@query()
def heading_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.outline(table(spark, sf_dir, "pages"), "page_id", "html")


_WRITTEN = """raw AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages), h AS (SELECT DISTINCT page_id, href FROM raw WHERE starts_with(href, '/') AND NOT contains(href, '?') AND NOT contains(href, '#')),
m AS (SELECT DISTINCT concat('docs', href) AS path FROM h WHERE page_id % 2 = 0), k AS (SELECT DISTINCT concat('http://kept', href) AS url FROM h WHERE page_id % 3 = 0),
d AS (SELECT page_id, href, (page_id + length(href)) % 9 AS v FROM h),
t AS (SELECT page_id, href, v, CASE v WHEN 0 THEN href WHEN 1 THEN concat('docs', href) WHEN 2 THEN substr(href, 2) WHEN 3 THEN concat('docs', href) WHEN 4 THEN concat('http://kept', href) WHEN 5 THEN concat('..', href) WHEN 8 THEN concat('docs/x/z', href) END AS resolved FROM d)"""


def _written_links(pages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links of the pages as a package's documents might write them, and the package's files and captured addresses."""
    h = pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("href")).distinct()
    h = h.where(F.col("href").startswith("/") & ~F.contains("href", F.lit("?")) & ~F.contains("href", F.lit("#")))
    members = h.where("page_id % 2 = 0").select(F.concat(F.lit("docs"), "href").alias("path")).distinct()
    known = h.where("page_id % 3 = 0").select(F.concat(F.lit("http://kept"), "href").alias("url")).distinct()
    v, href = (F.col("page_id") + F.length("href")) % 9, F.col("href")
    forms = ("{0}", "..{0}", "./../y/../..{0}", "..%2F{1}#top", "http://kept{0}#end", "../../..{0}", "mailto:a@b.c", "#here", "./z/.{0}?q=1")
    url = F.lit(None).cast("string")
    for n, form in enumerate(forms):
        before, mark, after = form.partition("{0}") if "{0}" in form else form.partition("{1}")
        middle = href if mark == "{0}" else F.substring(href, 2, F.length(href)) if mark else F.lit("")
        url = F.when(v == n, F.concat(F.lit(before), middle, F.lit(after))).otherwise(url)
    written = h.select("page_id", "href", F.concat(F.lit("docs/x/"), F.col("page_id").cast("string"), F.lit(".html")).alias("location"), url.alias("url"))
    return written, members, known


@query(f"""WITH {_WRITTEN} SELECT page_id, href, t.resolved, CASE WHEN v IN (6, 7) THEN 'nowhere' WHEN v = 4 THEN CASE WHEN k.url IS NULL THEN 'external' ELSE 'captured' END WHEN m.path IS NOT NULL THEN 'member' ELSE 'missing member' END AS status
FROM t LEFT JOIN m ON m.path = t.resolved AND v <> 4 LEFT JOIN k ON k.url = t.resolved AND v = 4""")
def package_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.dependencies(*_written_links(table(spark, sf_dir, "pages"))).select("page_id", "href", "resolved", "status")


_REVIEW = f"""{_WRITTEN}, miss AS (SELECT page_id AS document, 'a' AS tag, 'href' AS attribute, t.resolved AS url, CASE WHEN length(href) % 5 = 0 THEN 'script' ELSE 'cross-reference' END AS kind FROM t LEFT JOIN m ON m.path = t.resolved WHERE v IN (0, 1, 2, 3, 5, 8) AND m.path IS NULL),
rule AS (SELECT document * 10 + n AS rule_id, document, url, CASE WHEN document % 4 = 0 THEN 2 ELSE 1 END AS expected, concat('feedback ', CAST(n AS VARCHAR)) AS reason FROM (SELECT document, min(url) AS url FROM miss GROUP BY document), range(2) r(n) WHERE n = 0 OR document % 5 = 0),
named AS (SELECT miss.*, rule_id, n, reason FROM miss LEFT JOIN (SELECT document, url, min(rule_id) AS rule_id, count(*) AS n, min(reason) AS reason FROM rule GROUP BY 1, 2) x ON x.document = miss.document AND x.url = miss.url)"""


def _reviewed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The first missing link of each page is optional by one rule or, on some pages, named by two."""
    found = links.dependencies(*_written_links(table(spark, sf_dir, "pages"))).where("status = 'missing member'")
    kind = F.when(F.length("href") % 5 == 0, "script").otherwise("cross-reference")
    missing = found.select(F.col("page_id").alias("document"), F.lit("a").alias("tag"), F.lit("href").alias("attribute"), F.col("resolved").alias("url"), kind.alias("kind"))
    first = missing.groupBy("document").agg(F.min("url").alias("url")).withColumn("n", F.explode(F.array(F.lit(0), F.lit(1)))).where("n = 0 OR document % 5 = 0")
    rules = first.select((F.col("document") * 10 + F.col("n")).alias("rule_id"), "document", F.lit("a").alias("tag"), F.lit("href").alias("attribute"), "url", F.lit("optional").alias("classification"), F.concat(F.lit("feedback "), F.col("n").cast("string")).alias("reason"), F.when(F.col("document") % 4 == 0, 2).otherwise(1).alias("expected"))
    return links.reviewed(missing, rules)


@query(f"WITH {_REVIEW} SELECT document, tag, attribute, url, kind, CASE WHEN n IS NULL THEN 'required' ELSE 'optional' END AS classification, reason FROM named")
def reviewed_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviewed(spark, sf_dir)[0]


@query(f"""WITH {_REVIEW} SELECT DISTINCT rule_id, 'two rules name a link' AS problem FROM named WHERE n > 1 UNION SELECT rule_id, 'not a cross-reference' FROM named WHERE n = 1 AND kind <> 'cross-reference'
UNION SELECT rule_id, 'other number of links' FROM rule WHERE expected <> (SELECT count(*) FROM named WHERE named.rule_id = rule.rule_id AND named.n = 1)""")
def review_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviewed(spark, sf_dir)[1]


_OUTLINE = """o AS (SELECT doc_id AS doc, CAST(i AS INT) AS position, CAST(1 + (length(s) + i) % 3 AS INT) AS level, s AS title, CASE WHEN length(s) % 7 = 0 THEN 'no locator' END AS reason FROM (SELECT doc_id, unnest(string_split(text, '. ')) AS s, generate_subscripts(string_split(text, '. '), 1) - 1 AS i FROM documents))"""


def _outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences as headings of three levels, some of them without a usable place."""
    o = table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.col("doc_id").alias("doc"), F.posexplode(F.split("text", r"\. ")).alias("position", "title"))
    return o.select("doc", "position", (1 + (F.length("title") + F.col("position")) % 3).alias("level"), "title", F.when(F.length("title") % 7 == 0, "no locator").alias("reason"))


@query(f"""WITH {_OUTLINE}, p AS (SELECT *, CASE WHEN level = 3 THEN max(CASE WHEN level < 3 THEN position END) OVER w WHEN level = 2 THEN max(CASE WHEN level < 2 THEN position END) OVER w END AS parent FROM o WINDOW w AS (PARTITION BY doc ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s AS (SELECT p.*, q.position IS NOT NULL AS held FROM p LEFT JOIN o q ON q.doc = p.doc AND q.position = p.parent AND q.reason IS NULL),
c AS (SELECT doc, count(*) AS entries, count(CASE WHEN reason IS NULL THEN 1 END) AS sections, count(CASE WHEN reason IS NOT NULL THEN 1 END) + count(CASE WHEN reason IS NULL AND parent IS NOT NULL AND NOT held THEN 1 END) AS w FROM s GROUP BY doc)
SELECT doc, entries, sections, w + CASE WHEN sections = 0 THEN 1 ELSE 0 END AS warnings, CASE WHEN sections = 0 THEN 'whole-document' WHEN w > 0 THEN 'partial-draft' ELSE 'draft' END AS status FROM c""")
def section_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.imported(_outline(spark, sf_dir))[1]


_D = "CAST(concat('0x', substr(md5({0}), 1, 15)) AS BIGINT)"
_UP = "sha256(concat_ws('|', {0}, CAST(count(*) AS VARCHAR), CAST(bit_xor(" + _D.format("concat_ws('|', CAST(pos AS VARCHAR), digest)") + ") AS VARCHAR), CAST(bit_xor(" + _D.format("concat('~', concat_ws('|', CAST(pos AS VARCHAR), digest))") + ") AS VARCHAR)))"


@query(f"""WITH leaf AS (SELECT c_nationkey AS up, c_custkey AS pos, concat('c', CAST(c_custkey AS VARCHAR)) AS id, sha256(concat(c_name, '|0|0|0')) AS digest FROM customer),
n AS (SELECT n_nationkey, n_regionkey, sha256(concat(n_name, '|0|0|0')) AS bare, n_name FROM nation),
mid AS (SELECT n_regionkey AS up, n_nationkey AS pos, concat('n', CAST(n_nationkey AS VARCHAR)) AS id, count(leaf.id) AS below, CASE WHEN count(leaf.id) = 0 THEN any_value(bare) ELSE {_UP.format('any_value(n_name)')} END AS digest FROM n LEFT JOIN leaf ON leaf.up = n_nationkey GROUP BY 1, 2),
top AS (SELECT concat('r', CAST(r_regionkey AS VARCHAR)) AS id, count(*) + sum(below) AS below, max(CASE WHEN below > 0 THEN 2 ELSE 1 END) AS height, {_UP.format('any_value(r_name)')} AS digest FROM region JOIN mid ON mid.up = r_regionkey GROUP BY r_regionkey)
SELECT id, 0 AS height, CAST(1 AS BIGINT) AS size, digest FROM leaf UNION ALL SELECT id, CASE WHEN below > 0 THEN 1 ELSE 0 END, CAST(below + 1 AS BIGINT), digest FROM mid UNION ALL SELECT id, height, CAST(below + 1 AS BIGINT), digest FROM top""")
def section_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the trees of regions, nations and customers."""
    region, nation, customer = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    node = lambda letter, own, above, title: (F.concat(F.lit(letter), F.col(own).cast("string")).alias("id"), above.cast("string").alias("parent"), F.col(own).cast("long").alias("position"), F.col(title).alias("value"))
    nodes = region.select(*node("r", "r_regionkey", F.lit(None), "r_name")).union(nation.select(*node("n", "n_nationkey", F.concat(F.lit("r"), F.col("n_regionkey").cast("string")), "n_name")))
    return sections.tree_digests(nodes.union(customer.select(*node("c", "c_custkey", F.concat(F.lit("n"), F.col("c_nationkey").cast("string")), "c_name"))))
