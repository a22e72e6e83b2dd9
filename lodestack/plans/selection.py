"""Selection, capacity and coverage: documents are assets, sources collections, labels reviews; parts and line items are assets and memberships."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import ranking
from ..operators import selection as op
from .registry import parts, query, statement, table

_ASSET = """asset AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic,
         CASE WHEN l.doc_id IS NULL THEN 'unresolved' WHEN l.toxic = 1 THEN 'blocked' WHEN l.quality = 1 THEN 'critical' ELSE 'ready' END AS status
  FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id)"""
_SHELF = """shelf AS (
  SELECT doc_id, 'textbooks' AS shelf, n_chars, status FROM asset WHERE status <> 'blocked' AND n_chars >= 4000
  UNION ALL SELECT doc_id, 'illustrated-guides', n_chars, status FROM asset WHERE status <> 'blocked' AND n_chars >= 1000 AND lang <> 'en')"""

statement("classify_documents", f"WITH {_ASSET} SELECT doc_id, status, CASE WHEN status = 'blocked' THEN 'excluded' WHEN n_chars >= 4000 THEN 'document' WHEN n_chars >= 200 THEN 'companion' ELSE 'supporting' END AS role, status IN ('ready', 'critical') AS resolved FROM asset")

statement("shelf_coverage", f"""WITH {_ASSET}, {_SHELF}, dim(shelf, floor_n) AS (VALUES ('textbooks', 10), ('illustrated-guides', 5), ('maps', 1))
SELECT dim.shelf, count(doc_id) AS n, CAST(coalesce(sum(CASE WHEN status = 'critical' THEN 1 ELSE 0 END), 0) AS BIGINT) AS critical, CAST(coalesce(sum(n_chars), 0) AS BIGINT) AS size_bytes, count(doc_id) >= max(floor_n) AS met
FROM dim LEFT JOIN shelf ON dim.shelf = shelf.shelf GROUP BY dim.shelf""")

statement("capacity_plan", f"""WITH {_ASSET}, once AS (SELECT max(n_chars) AS n FROM asset d JOIN (SELECT doc_id, [[sha2(text, 256)||sha256(text)]] AS h FROM {{documents}}) x ON x.doc_id = d.doc_id GROUP BY h),
sums AS (SELECT CAST(sum(n_chars) AS BIGINT) AS content, CAST(sum(CASE WHEN status = 'critical' THEN n_chars ELSE 0 END) AS BIGINT) AS critical, CAST(sum(CASE WHEN status = 'unresolved' THEN n_chars ELSE 0 END) AS BIGINT) AS unresolved, CAST(sum(CASE WHEN n_chars < 200 THEN n_chars ELSE 0 END) AS BIGINT) AS supporting FROM asset),
uniq AS (SELECT CAST(sum(n) AS BIGINT) AS distinct_bytes FROM once), profile(capacity, reserve, floor_bytes, ceiling) AS (VALUES (3000000000, 100000, 2000000, 2500000))
SELECT content, critical, unresolved, supporting, distinct_bytes, content - supporting AS knowledge, CAST([[(content - supporting) * 1000000 div capacity||(content - supporting) * 1000000 // capacity]] AS BIGINT) AS utilization_ppm,
  CAST(greatest(0, floor_bytes - (content - supporting)) AS BIGINT) AS shortfall, CAST(greatest(0, content - supporting - ceiling) AS BIGINT) AS overflow,
  CASE WHEN content - supporting < floor_bytes THEN 'below-target' WHEN content - supporting > ceiling THEN 'above-target' ELSE 'in-range' END AS target_window, content + reserve <= capacity AS fits
FROM sums CROSS JOIN uniq CROSS JOIN profile""")

def _plain(text: str) -> str:
    """SQL with bare table names."""
    return text.replace("{documents}", "documents").replace("{labels}", "labels").replace("{part}", "part").replace("{lineitem}", "lineitem")


@query(_plain(f"""WITH {_ASSET}, tiered AS (SELECT doc_id, n_chars, source, CASE WHEN status = 'critical' AND n_chars >= 4000 THEN 0 WHEN status = 'critical' THEN 1 WHEN n_chars >= 4000 THEN 2 WHEN status = 'ready' THEN 3 WHEN status = 'blocked' THEN 5 ELSE 4 END AS tier FROM asset)
SELECT doc_id, CAST(tier AS INT) AS tier, CAST(row_number() OVER (PARTITION BY tier ORDER BY n_chars, lower(source), doc_id) AS BIGINT) AS rank_in_tier FROM tiered"""))
def priority_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places within tiers, which are few and of any size: numbered by ranges."""
    assets = spark.sql(f"WITH {_ASSET} SELECT doc_id, n_chars, source, status FROM asset", documents=table(spark, sf_dir, "documents"), labels=table(spark, sf_dir, "labels"))
    critical, long = F.col("status") == "critical", F.col("n_chars") >= 4000
    tier = F.when(critical & long, 0).when(critical, 1).when(long, 2).when(F.col("status") == "ready", 3).when(F.col("status") == "blocked", 5).otherwise(4)
    rows = assets.select("doc_id", "n_chars", F.lower("source").alias("low"), tier.alias("tier"))
    return ranking.placed(rows, "tier", [F.asc_nulls_last("n_chars"), F.asc_nulls_last("low"), F.asc("doc_id")], "rank_in_tier").select("doc_id", "tier", "rank_in_tier")


_CHOICE = """defaults AS (SELECT p_partkey FROM {part} WHERE p_size <= 20), include AS (SELECT p_partkey FROM {part} WHERE p_size BETWEEN 40 AND 42), exclude AS (SELECT p_partkey FROM {part} WHERE p_size IN (3, 5)),
chosen AS (SELECT p_partkey FROM defaults UNION SELECT p_partkey FROM include EXCEPT SELECT p_partkey FROM exclude),
member AS (SELECT DISTINCT l_suppkey, l_partkey FROM {lineitem})"""

statement("selection_resolve", f"""WITH {_CHOICE},
own AS (SELECT *, lead(l_partkey) OVER (PARTITION BY l_suppkey ORDER BY l_partkey) AS after FROM member),
kept AS (SELECT m.l_suppkey, p.p_size, c.p_partkey IS NOT NULL AND coalesce(after <> m.l_partkey + 1, TRUE) AS kept FROM own m JOIN {{part}} p ON p.p_partkey = m.l_partkey LEFT JOIN chosen c ON c.p_partkey = m.l_partkey)
SELECT l_suppkey AS resource_id, count(*) AS members, count(CASE WHEN kept THEN 1 END) AS selected, CAST(coalesce(sum(CASE WHEN kept THEN p_size END), 0) AS BIGINT) AS known_bytes,
  CASE WHEN count(CASE WHEN kept THEN 1 END) = 0 THEN 'unresolved' WHEN count(CASE WHEN kept THEN 1 END) < count(*) THEN 'partial' ELSE 'ready' END AS status
FROM kept GROUP BY l_suppkey""")

@query(_plain(f"""WITH {_CHOICE}, target AS (SELECT l_suppkey, CAST(sum(p_size) AS BIGINT) + 10 AS planned FROM member JOIN part ON p_partkey = l_partkey GROUP BY 1),
credit AS (SELECT b.l_suppkey, CAST(sum(p_size) AS BIGINT) AS credit FROM member a JOIN member b ON b.l_partkey = a.l_partkey AND b.l_suppkey = a.l_suppkey + 1 JOIN part ON p_partkey = a.l_partkey GROUP BY 1)
SELECT t.l_suppkey AS resource_id, planned, coalesce(credit, 0) AS credit, greatest(planned - coalesce(credit, 0), 0) AS adjusted, coalesce(credit, 0) > planned AS violation FROM target t LEFT JOIN credit c ON c.l_suppkey = t.l_suppkey"""))
def replacement_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts are dealt once: in the order of a part's suppliers the one before is looked at, and sizes are joined in place."""
    member = table(spark, sf_dir, "lineitem").where("l_partkey IS NOT NULL").select("l_suppkey", "l_partkey")
    n = parts(member)
    size = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size").repartition(n, "l_partkey")
    before = F.lag("l_suppkey").over(Window.partitionBy("l_partkey").orderBy("l_suppkey"))
    own = member.repartition(n, "l_partkey").distinct().withColumn("shared", before == F.col("l_suppkey") - 1)
    sums = own.join(size.hint("merge"), "l_partkey").groupBy("l_suppkey").agg((F.sum("p_size") + 10).alias("planned"), F.sum(F.when(F.col("shared"), F.col("p_size"))).alias("credit"))
    credit = F.coalesce("credit", F.lit(0).cast("long"))
    return sums.select(F.col("l_suppkey").alias("resource_id"), "planned", credit.alias("credit"), F.greatest(F.col("planned") - credit, F.lit(0).cast("long")).alias("adjusted"), (credit > F.col("planned")).alias("violation"))


statement("unknown_members", "SELECT l_partkey + 1000000 * (l_linenumber % 2) AS member, count(*) AS uses FROM {lineitem} WHERE NOT EXISTS (SELECT 1 FROM {part} WHERE p_partkey = l_partkey + 1000000 * (l_linenumber % 2)) GROUP BY 1")

statement("overlay_merge", "SELECT d.doc_id, coalesce(l.doc_id * 10, d.n_chars) AS size_bytes, coalesce(CASE WHEN l.toxic = 1 THEN 'blocked' WHEN l.quality = 1 THEN 'reviewed' END, 'not reported') AS status FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id")

statement("readd_unrediscovered", """WITH found AS (SELECT doc_id AS id, [[sha2(text, 256)||sha256(text)]] AS h FROM {documents}), approved AS (SELECT item_id AS id, [[sha2(text, 256)||sha256(text)]] AS h FROM {benchmark})
SELECT id, h, 'found' AS origin FROM found UNION ALL SELECT id, h, 'approved' FROM approved a WHERE NOT EXISTS (SELECT 1 FROM found f WHERE f.h = a.h)""")

statement("exclusion_semi_anti", """SELECT c_custkey FROM {customer} WHERE EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey) AND NOT EXISTS (SELECT 1 FROM {orders} WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
AND NOT EXISTS (SELECT 1 FROM {nation} WHERE n_nationkey = c_nationkey AND n_regionkey = 0) AND c_mktsegment NOT IN (SELECT c_mktsegment FROM {customer} WHERE c_custkey = 1)""")

statement("editorial_coverage", """SELECT r_name, count(DISTINCT n_nationkey) AS nations, count(DISTINCT s_suppkey) AS suppliers, count(DISTINCT CASE WHEN s_suppkey IS NULL THEN n_nationkey END) AS uncovered,
count(s_suppkey) >= 20 AS complete FROM {region} JOIN {nation} ON n_regionkey = r_regionkey LEFT JOIN {supplier} ON s_nationkey = n_nationkey GROUP BY r_name""")

statement("coverage_report", f"WITH {_ASSET} SELECT lang, status, count(*) AS n, count(DISTINCT source) AS sources, CAST(sum(CASE WHEN n_chars >= 4000 THEN 1 ELSE 0 END) AS BIGINT) AS textbooks FROM asset GROUP BY lang, status")

statement("domain_coverage", """WITH have AS (SELECT DISTINCT l_suppkey, p_brand FROM {lineitem} JOIN {part} ON p_partkey = l_partkey), need AS (SELECT DISTINCT p_brand FROM {part} WHERE p_size = 1)
SELECT s_suppkey, count(need.p_brand) - count(have.p_brand) AS missing, count(have.p_brand) = count(need.p_brand) AS complete FROM {supplier} CROSS JOIN need LEFT JOIN have ON l_suppkey = s_suppkey AND have.p_brand = need.p_brand GROUP BY s_suppkey""")

statement("visibility_filters", f"WITH {_ASSET} SELECT doc_id, source FROM asset WHERE status <> 'blocked' AND lower(trim(lang)) = 'en' AND source IS NOT NULL AND n_chars IS NOT NULL AND n_chars > 0")

statement("label_badges", f"""WITH {_ASSET} SELECT doc_id, concat_ws(' · ', upper(lang), CASE WHEN status = 'critical' THEN 'Reviewed' END, CASE WHEN n_chars >= 4000 THEN 'Long' END, CASE WHEN status = 'blocked' THEN 'Blocked' END) AS badges,
CASE WHEN n_chars < 1024 THEN concat(CAST(n_chars AS [[STRING||VARCHAR]]), ' B') ELSE concat(CAST(CAST(floor(n_chars / 1024) AS BIGINT) AS [[STRING||VARCHAR]]), ' KB') END AS size_label, lower(concat_ws(' ', source, lang)) AS haystack FROM asset""")

statement("content_size_estimate", f"""WITH {_ASSET} SELECT lang, count(*) AS n, CAST(sum(CASE WHEN status = 'unresolved' THEN 0 WHEN lang = 'en' THEN n_chars * 2 ELSE n_chars * 3 END) AS BIGINT) AS estimated_bytes, CAST(sum(CASE WHEN status = 'unresolved' THEN 1 ELSE 0 END) AS BIGINT) AS unknown FROM asset GROUP BY lang""")

statement("primary_vertical", """WITH dom(word, pos, vertical) AS (VALUES ('STANDARD', 1, 'basics'), ('SMALL', 2, 'basics'), ('PROMO', 3, 'offers'), ('ECONOMY', 4, 'offers'), ('MEDIUM', 5, 'basics')),
hit AS (SELECT p_partkey, vertical, pos, row_number() OVER (PARTITION BY p_partkey ORDER BY pos) AS k FROM {part} JOIN dom ON contains(upper(p_type), word))
SELECT p.p_partkey, coalesce(vertical, 'other') AS vertical FROM {part} p LEFT JOIN hit ON hit.p_partkey = p.p_partkey AND k = 1""")

statement("scope_sets", """SELECT p_partkey, 'requested' AS scope FROM (SELECT p_partkey FROM {part} WHERE p_size < 10 INTERSECT SELECT l_partkey FROM {lineitem} WHERE l_quantity > 45)
UNION ALL SELECT p_partkey, 'unused' FROM (SELECT p_partkey FROM {part} EXCEPT SELECT l_partkey FROM {lineitem} WHERE l_quantity > 20)""")

@query(_plain("SELECT d.doc_id, CAST(row_number() OVER (PARTITION BY d.source ORDER BY CASE WHEN l.quality IS NULL THEN 1 ELSE 0 END, l.quality, CASE d.lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 ELSE 2 END, d.doc_id) AS BIGINT) AS pos FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id"))
def nulls_last_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    tongue = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "de", 1).otherwise(2)
    rows = docs.join(labels, "doc_id", "left").select("doc_id", "source", "quality", tongue.alias("tongue"))
    return ranking.placed(rows, "source", [F.asc_nulls_last("quality"), F.asc("tongue"), F.asc("doc_id")], "pos").select("doc_id", "pos")


statement("policy_violations", f"""WITH {_ASSET}, rule(role, field, least) AS (VALUES ('critical', 'size', 300), ('ready', 'size', 100), ('unresolved', 'size', 20)),
bad AS (SELECT doc_id, status AS role, 'too short' AS rule FROM asset JOIN rule ON role = status WHERE n_chars < least UNION ALL SELECT doc_id, status, 'blocked but reviewed' FROM asset WHERE status = 'blocked' AND quality = 1)
SELECT role, rule, count(*) AS n, count(DISTINCT doc_id) AS failing, min(doc_id) AS sample FROM bad GROUP BY role, rule""")


@query("""WITH picked AS (SELECT s_suppkey AS id FROM supplier WHERE (s_suppkey % 2 = 0 OR s_suppkey % 5 = 1) AND NOT (s_suppkey % 7 = 3 AND s_suppkey % 5 <> 1)),
member AS (SELECT DISTINCT l_suppkey AS id, l_partkey AS asset FROM lineitem), taken AS (SELECT min(id) AS owner, asset FROM member WHERE asset % 9 = 0 GROUP BY asset),
row_ AS (SELECT m.id, m.asset, p.p_size, p.p_size > 3 AS known, t.owner IS NOT NULL AND t.owner <> m.id AS gone FROM member m JOIN picked USING (id) LEFT JOIN part p ON p.p_partkey = m.asset LEFT JOIN (SELECT * FROM taken WHERE owner IN (SELECT id FROM picked)) t ON t.asset = m.asset),
s AS (SELECT id, count(*) FILTER (WHERE NOT gone) AS members, count(*) FILTER (WHERE NOT gone AND known) AS resolved, coalesce(sum(p_size) FILTER (WHERE NOT gone AND known), 0) AS known_bytes, coalesce(sum(p_size) FILTER (WHERE gone), 0) AS credit_bytes FROM row_ GROUP BY id),
w AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN 'partial' ELSE 'ready' END AS stated, CASE WHEN s_suppkey % 6 = 0 THEN 90000 ELSE 40000 + s_suppkey END AS target, coalesce(members, 0) AS members, coalesce(resolved, 0) AS resolved, CAST(coalesce(known_bytes, 0) AS BIGINT) AS known_bytes, CAST(coalesce(credit_bytes, 0) AS BIGINT) AS credit_bytes FROM supplier JOIN picked ON id = s_suppkey LEFT JOIN s USING (id))
SELECT id AS resource_id, CASE WHEN members = 0 OR (resolved = 0 AND stated = 'ready') THEN 'unresolved' WHEN resolved < members AND stated = 'ready' THEN 'partial' ELSE stated END AS status, members, resolved, known_bytes, credit_bytes,
CAST(target - credit_bytes AS BIGINT) AS adjusted_bytes, CAST(greatest(target - credit_bytes, known_bytes) AS BIGINT) AS effective_bytes FROM w""")
def resource_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers are collections of the parts they deliver; some parts are replaced by the first supplier that has them."""
    k = F.col("s_suppkey")
    supplier, size = table(spark, sf_dir, "supplier").select(k), F.col("p_size").cast("long")
    ids = lambda test: supplier.where(test).select(k.alias("resource_id"))
    picked = op.chosen(ids(k % 2 == 0), ids(k % 5 == 1), ids((k % 7 == 3) & (k % 5 != 1)))
    resources = supplier.select(k.alias("resource_id"), (k + 40000).cast("long").alias("target_bytes"), F.when(k % 3 == 0, "partial").otherwise("ready").alias("status"))
    members = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("resource_id"), F.col("l_partkey").alias("asset_id")).distinct()
    assets = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("asset_id"), size.alias("size_bytes"), (size > 3).alias("resolved"))
    replacements = members.where("asset_id % 9 = 0").groupBy("asset_id").agg(F.min("resource_id").alias("resource_id"))
    overrides = supplier.where(k % 6 == 0).select(k.alias("resource_id"), F.lit(90000).cast("long").alias("target_bytes"))
    return op.resolve(resources, members, assets, picked, replacements, overrides)


@query("""WITH a AS (SELECT n_chars AS size_bytes, CASE doc_id % 10 WHEN 0 THEN 'software' WHEN 1 THEN 'supporting' ELSE 'document' END AS role, doc_id % 4 > 0 AS direct FROM documents),
s AS (SELECT CAST(sum(size_bytes) AS BIGINT) AS content_bytes, CAST(sum(size_bytes) FILTER (WHERE role = 'software') AS BIGINT) AS reader_bytes, CAST(sum(size_bytes) FILTER (WHERE role = 'supporting') AS BIGINT) AS supporting_bytes, CAST(sum(size_bytes) FILTER (WHERE role = 'document' AND direct) AS BIGINT) AS direct_bytes FROM a),
p AS (SELECT n_name AS profile, CAST((n_nationkey + 1) * 200000 AS BIGINT) AS cap, 50000 AS reserve, 1000 AS disc, CASE WHEN n_nationkey % 3 > 0 THEN 1000000 END AS low, CASE WHEN n_nationkey % 3 > 0 THEN 1000000 * n_nationkey END AS high FROM nation)
SELECT profile, content_bytes, reader_bytes, supporting_bytes, direct_bytes, content_bytes - reader_bytes - supporting_bytes AS knowledge_bytes, content_bytes + disc AS final_bytes, (content_bytes - reader_bytes - supporting_bytes) * 100 // cap AS utilization_percent,
greatest(0, coalesce(low, 0) - (content_bytes - reader_bytes - supporting_bytes)) AS shortfall_bytes, CASE WHEN low IS NULL THEN 'not-specified' WHEN content_bytes - reader_bytes - supporting_bytes < low THEN 'below-target' WHEN content_bytes - reader_bytes - supporting_bytes > high THEN 'above-target' ELSE 'in-range' END AS target_window, content_bytes + disc + reserve <= cap AS fits FROM s, p""")
def capacity_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, n = F.col("doc_id"), F.col("n_nationkey")
    assets = table(spark, sf_dir, "documents").select(F.col("n_chars").alias("size_bytes"), F.when(d % 10 == 0, "software").when(d % 10 == 1, "supporting").otherwise("document").alias("role"), (d % 4 > 0).alias("direct"))
    bytes_ = lambda c: c.cast("long")
    profile = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("profile"), bytes_((n + 1) * 200000).alias("capacity_bytes"), bytes_(F.lit(50000)).alias("reserve_bytes"), bytes_(F.lit(1000)).alias("discovery_bytes"),
        F.when(n % 3 > 0, bytes_(F.lit(1000000))).alias("floor_bytes"), F.when(n % 3 > 0, bytes_(n * 1000000)).alias("ceiling_bytes"),
    )
    return op.capacity(assets, profile)
