"""Planner: regions are profiles with ten states each, suppliers collections in up to three editions, parts files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import planner
from .registry import query, table

_STATES = """st AS (SELECT r_regionkey * 10 + k AS id, r_regionkey AS p, k, r_regionkey < 4 AS by_default FROM region, range(10) t(k)),
c AS (SELECT id, p, by_default, s_suppkey AS s, (s_suppkey + p) % 3 = 0 AS preset, md5(concat(CAST(id AS VARCHAR), '-', CAST(s_suppkey AS VARCHAR))) AS h, k FROM st, supplier),
pick AS (SELECT id, p, s, CASE WHEN k > 0 AND substr(h, 2, 1) < '4' THEN substr(h, 1, 1) < '8' ELSE by_default END AS selected, preset AND k > 0 AND substr(h, 2, 1) < '4' AND substr(h, 1, 1) >= '8' AS excluded, k > 0 AND substr(h, 2, 1) < '4' AS custom,
  CASE WHEN k > 0 AND substr(h, 2, 1) < '4' AND substr(h, 3, 1) < '4' THEN 'direct' WHEN k > 0 AND substr(h, 2, 1) < '4' AND substr(h, 3, 1) < '6' THEN 'compact' ELSE 'published' END AS edition FROM c WHERE preset OR (k > 0 AND substr(h, 2, 1) < '4')),
want AS (SELECT *, CASE WHEN edition = 'direct' AND s % 3 = 0 OR edition = 'compact' AND s % 4 = 1 THEN edition ELSE 'published' END AS used FROM pick WHERE selected),
member AS (SELECT DISTINCT l_suppkey AS s, p_partkey AS a, p_size FROM lineitem JOIN part ON p_partkey = l_partkey),
asset AS (SELECT p_partkey AS a, p_size * 100 + p_partkey % 7 AS size, p_size > 3 AS resolved, p_partkey % 25 = 0 AS zim, CASE WHEN p_size = 50 THEN 'software' WHEN p_size >= 48 THEN 'supporting' ELSE 'document' END AS role FROM part),
raw AS (SELECT id, w.s, a FROM want w JOIN member m ON m.s = w.s WHERE used = 'published' OR used = 'direct' AND p_size % 2 = 0 OR used = 'compact' AND a % 3 = 0),
held AS (SELECT DISTINCT id, a FROM raw),
repl AS (SELECT s_suppkey AS s, p_partkey AS a FROM supplier JOIN part ON p_partkey % 100 = s_suppkey % 100 WHERE s_suppkey % 10 = 3),
replaced AS (SELECT w.id, w.s, repl.a FROM want w JOIN repl ON repl.s = w.s JOIN held ON held.id = w.id AND held.a = repl.a),
credit AS (SELECT DISTINCT r.id, r.s + 1 AS s FROM replaced r JOIN raw ON raw.id = r.id AND raw.s = r.s + 1 AND raw.a = r.a),
kept AS (SELECT * FROM held ANTI JOIN replaced ON held.id = replaced.id AND held.a = replaced.a),
taken AS (SELECT DISTINCT id, a FROM pick JOIN member ON member.s = pick.s WHERE excluded),
one AS (SELECT k.id, k.a, k.a % 20 IN (7, 8) AND (n.a IS NULL OR o.a IS NOT NULL) AS falls FROM kept k LEFT JOIN kept n ON n.id = k.id AND n.a = k.a - 1 LEFT JOIN taken o ON o.id = k.id AND o.a = k.a - 1),
lft AS (SELECT x.id, x.a FROM one x LEFT JOIN one y ON y.id = x.id AND y.a = x.a - 1 AND y.falls AND x.a % 20 = 8 WHERE NOT x.falls AND y.a IS NULL),
arch AS (SELECT DISTINCT id FROM lft JOIN asset ON asset.a = lft.a WHERE zim AND resolved),
aut AS (SELECT id FROM arch WHERE id NOT IN (SELECT id FROM want WHERE s = 0)),
own AS (SELECT raw.id, raw.s, raw.a FROM raw JOIN lft ON lft.id = raw.id AND lft.a = raw.a UNION ALL SELECT id, 0, a FROM aut, member WHERE member.s = 0),
gone AS (SELECT id, a FROM taken UNION SELECT w.id, repl.a FROM want w JOIN repl ON repl.s = w.s UNION SELECT w.id, a FROM want w JOIN member m ON m.s = w.s WHERE custom AND edition <> 'published' UNION SELECT id, a FROM own),
plain AS (SELECT b.id, b.a FROM (SELECT id, p_partkey AS a FROM st, part WHERE NOT by_default AND p_partkey % 7 = 0 AND p_size <= 10) b ANTI JOIN gone ON gone.id = b.id AND gone.a = b.a),
files AS (SELECT id, a FROM own UNION SELECT id, a FROM plain),
pin AS (SELECT f.id, asset.* FROM files f JOIN asset ON asset.a = f.a WHERE resolved),
rws AS (SELECT id, s, edition, used, false AS auto FROM want UNION ALL SELECT id, 0, 'published', 'published', true FROM aut),
sums AS (SELECT id, s, count(*) AS members, count(CASE WHEN resolved THEN 1 END) AS resolved, sum(CASE WHEN resolved THEN size ELSE 0 END) AS known FROM own JOIN asset ON asset.a = own.a GROUP BY id, s),
lost AS (SELECT DISTINCT raw.id, raw.s FROM raw JOIN kept ON kept.id = raw.id AND kept.a = raw.a ANTI JOIN lft ON lft.id = raw.id AND lft.a = raw.a),
coll AS (SELECT r.id, r.s, r.edition, r.auto, coalesce(members, 0) AS members, coalesce(sums.resolved, 0) AS resolved, CAST(coalesce(known, 0) AS BIGINT) AS known, CASE used WHEN 'published' THEN 1200000 + r.s * 10 WHEN 'direct' THEN 700000 ELSE 400000 END - CASE WHEN credit.id IS NULL THEN 0 ELSE 5000 END AS adjusted,
  CASE WHEN coalesce(members, 0) = 0 THEN 'unresolved' WHEN lost.id IS NOT NULL THEN 'partial' WHEN r.s % 8 = 5 THEN 'partial' WHEN coalesce(sums.resolved, 0) = members THEN 'ready' WHEN sums.resolved > 0 THEN 'partial' ELSE 'unresolved' END AS status
  FROM rws r LEFT JOIN sums ON sums.id = r.id AND sums.s = r.s LEFT JOIN credit ON credit.id = r.id AND credit.s = r.s LEFT JOIN lost ON lost.id = r.id AND lost.s = r.s)"""

_REPORT = """tot AS (SELECT id, count(*) AS files, sum(CASE WHEN role = 'document' THEN size ELSE 0 END) AS kb, sum(CASE WHEN role = 'software' THEN size ELSE 0 END) AS sb, sum(CASE WHEN role = 'supporting' THEN size ELSE 0 END) AS ub,
  count(CASE WHEN role = 'document' AND a % 4 > 0 THEN 1 END) AS df, count(CASE WHEN size // 100 % 11 = 0 THEN 1 END) AS cf, sum(size) AS known, bit_xor(CAST(concat('0x', substr(md5(CAST(a AS VARCHAR)), 1, 15)) AS BIGINT)) AS digest, bool_or(zim) AND NOT bool_or(role = 'software') AS unread FROM pin GROUP BY id),
tgt AS (SELECT id, sum(CASE WHEN s <> 0 THEN greatest(adjusted, known) ELSE 0 END) AS content, max(CASE WHEN s = 0 THEN greatest(adjusted, known) END) AS reader, count(CASE WHEN status <> 'ready' THEN 1 END) AS incomplete FROM coll GROUP BY id),
bas AS (SELECT id, sum(size) AS b FROM plain JOIN asset ON asset.a = plain.a WHERE resolved GROUP BY id),
err AS (SELECT id, 'edition is not there' AS e FROM want WHERE used <> edition UNION SELECT id, 'several collections replace a file' FROM replaced GROUP BY id, a HAVING count(*) > 1 UNION SELECT id, 'credit exceeds a target' FROM coll WHERE adjusted < 0
  UNION SELECT arch.id, 'archives need readers' FROM arch JOIN pick ON pick.id = arch.id WHERE s = 0 AND excluded UNION SELECT x.id, 'archive of a member is not selected' FROM pin x ANTI JOIN pin y ON y.id = x.id AND y.a = x.a - 1 WHERE x.a % 30 = 11
  UNION SELECT id, 'required file is unresolved' FROM files JOIN asset ON asset.a = files.a WHERE NOT resolved AND size // 100 = 2 AND files.a % 13 = 0),
rep AS (SELECT st.id, st.p, coalesce(files, 0) AS files, coalesce(kb, 0) AS kb, coalesce(sb, 0) AS sb, coalesce(ub, 0) AS ub, coalesce(df, 0) AS df, coalesce(cf, 0) AS cf, coalesce(known, 0) AS known, coalesce(content, 0) + coalesce(b, 0) AS target, CASE WHEN reader IS NULL THEN 0 ELSE greatest(1300000, reader) END AS readers, coalesce(incomplete, 0) AS incomplete, coalesce(digest, 0) AS digest, coalesce(unread, false) AS unread
  FROM st LEFT JOIN tot ON tot.id = st.id LEFT JOIN tgt ON tgt.id = st.id LEFT JOIN bas ON bas.id = st.id),
fin AS (SELECT *, greatest(known, target + readers) + 1000 + 16777216 AS final FROM rep),
bad AS (SELECT id, e FROM err UNION SELECT id, 'exceeds the drive' FROM fin WHERE final + 50000 > 60000000 + p * 5000000 UNION SELECT id, 'no files are selected' FROM fin WHERE files = 0 UNION SELECT id, 'archives without a reader' FROM fin WHERE unread),
er AS (SELECT id, string_agg(e, '; ' ORDER BY e) AS errors FROM bad GROUP BY id)"""


def _keys(n: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n - 1))


def _catalog(spark: SparkSession, sf_dir: str) -> planner.Catalog:
    supplier, part, region = (table(spark, sf_dir, t) for t in ("supplier", "part", "region"))
    s = F.col("s_suppkey")
    editions = F.array(F.struct(F.lit("published").alias("edition"), (s * 10 + 1200000).alias("target_bytes")), F.when(s % 3 == 0, F.struct(F.lit("direct").alias("edition"), F.lit(700000).cast("long").alias("target_bytes"))), F.when(s % 4 == 1, F.struct(F.lit("compact").alias("edition"), F.lit(400000).cast("long").alias("target_bytes"))))
    resources = supplier.select(s.alias("resource_id"), F.explode(F.array_compact(editions)).alias("x"), F.when(s % 8 == 5, "partial").otherwise("ready").alias("status")).select("resource_id", "x.edition", "x.target_bytes", "status")
    listed = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("resource_id"), F.col("l_partkey").alias("p_partkey")).distinct().join(part.select("p_partkey", "p_size"), "p_partkey")
    held = F.array_compact(F.array(F.lit("published"), F.when((F.col("resource_id") % 3 == 0) & (F.col("p_size") % 2 == 0), "direct"), F.when((F.col("resource_id") % 4 == 1) & (F.col("p_partkey") % 3 == 0), "compact")))
    members = listed.select("resource_id", F.explode(held).alias("edition"), F.col("p_partkey").alias("asset_id"))
    a, size = F.col("p_partkey"), F.col("p_size")
    role = F.when(size == 50, "software").when(size >= 48, "supporting").otherwise("document")
    assets = part.select(a.alias("asset_id"), (size * 100 + a % 7).alias("size_bytes"), (size > 3).alias("resolved"), F.when(a % 25 == 0, "zim").otherwise("pdf").alias("format"), role.alias("role"), (a % 4 > 0).alias("direct"), (size % 11 == 0).alias("critical"), ((size == 2) & (a % 13 == 0)).alias("required"), F.when(a % 30 == 11, a - 1).alias("source_id"))
    keys = supplier.select(s.alias("resource_id"))
    replacing = keys.where("resource_id % 10 = 3")
    profiles = region.select(F.col("r_regionkey").alias("profile_id"), (F.col("r_regionkey") < 4).alias("by_default"), (F.col("r_regionkey") * 5000000 + 60000000).cast("long").alias("capacity_bytes"), *[F.lit(v).cast("long").alias(n) for n, v in (("reserve_bytes", 50000), ("discovery_bytes", 1000), ("readers_bytes", 1300000))])
    return planner.Catalog(
        resources, members, assets,
        needs=part.where("p_partkey % 20 IN (7, 8)").select(a.alias("asset_id"), (a - 1).alias("need")),
        replacements=replacing.select("resource_id", (F.col("resource_id") % 100).alias("asset_id")),
        credits=replacing.select("resource_id", (F.col("resource_id") + 1).alias("credited_id"), F.lit(5000).cast("long").alias("bytes")),
        profiles=profiles,
        defaults=keys.withColumn("profile_id", F.explode(_keys(5))).where("(resource_id + profile_id) % 3 = 0").join(profiles.select("profile_id"), "profile_id").withColumn("edition", F.lit("published")),
        baseline=part.where("p_partkey % 7 = 0 AND p_size <= 10").select(F.lit(4).alias("profile_id"), a.alias("asset_id")).join(profiles.select("profile_id"), "profile_id"),
        readers=0,
        lists=part.select((a % 100).alias("list_id"), a.alias("asset_id")),
    )


def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The first state of a profile is its preset; the others customise a quarter of the collections."""
    states = table(spark, sf_dir, "region").select(F.explode(_keys(10)).alias("k"), F.col("r_regionkey").alias("profile_id")).select((F.col("profile_id") * 10 + F.col("k")).alias("state_id"), "profile_id", (F.col("k") % 2 == 0).alias("allow_incomplete"))
    every = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("resource_id"), F.explode(_keys(50)).alias("state_id")).where("state_id % 10 > 0").join(states.select("state_id"), "state_id")
    h = F.md5(F.concat_ws("-", F.col("state_id").cast("string"), F.col("resource_id").cast("string")))
    digit = lambda n: F.substring("h", n, 1)
    items = every.withColumn("h", h).where(digit(2) < "4")
    edition = F.when(digit(3) < "4", "direct").when(digit(3) < "6", "compact").otherwise("published")
    return states, items.select("state_id", "resource_id", (digit(1) < "8").alias("included"), edition.alias("edition"))


@query(f"""WITH {_STATES}, {_REPORT} SELECT fin.id AS state_id, p AS profile_id, CAST(files AS BIGINT) AS files, CAST(kb AS BIGINT) AS knowledge_bytes, CAST(sb AS BIGINT) AS software_bytes, CAST(ub AS BIGINT) AS supporting_bytes, df AS direct_files, cf AS critical_files, CAST(known AS BIGINT) AS known_bytes,
CAST(target AS BIGINT) AS target_bytes, CAST(readers AS BIGINT) AS reader_bytes, CAST(final AS BIGINT) AS final_bytes, incomplete, coalesce(errors, '') AS errors, errors IS NULL AND (incomplete = 0 OR fin.id % 2 = 0) AS can_build, digest FROM fin LEFT JOIN er ON er.id = fin.id""")
def planner_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, _, _ = planner.resolve(_catalog(spark, sf_dir), *_states(spark, sf_dir))
    return report.withColumn("errors", F.array_join("errors", "; "))


@query(f"""WITH {_STATES} SELECT id AS state_id, s AS resource_id, edition, status, members, resolved, known AS known_bytes, CAST(greatest(adjusted, known) AS BIGINT) AS target_bytes, auto FROM coll""")
def planner_collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planner.resolve(_catalog(spark, sf_dir), *_states(spark, sf_dir))[1]


@query(f"""WITH {_STATES}, {_REPORT} SELECT id AS state_id, CASE WHEN id % 7 = 3 THEN 'other profile' WHEN id % 7 = 4 THEN 'budget does not add up' WHEN id % 7 = 5 AND files > 0 THEN 'other files' WHEN id % 7 = 6 THEN 'other sizes' ELSE 'same' END AS verdict FROM fin""")
def lock_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locks of all states, some of them damaged in one way each."""
    report, _, files = planner.resolve(_catalog(spark, sf_dir), *_states(spark, sf_dir))
    k = F.col("state_id") % 7
    locked = files.groupBy("state_id").agg(F.count("*").alias("files"), planner.digest("asset_id").alias("digest"), F.min("asset_id").alias("asset_id"))
    lacks = lambda c, without: F.when(k == 5, without).otherwise(F.col(c)).alias(c)  # noqa: E731  some locks lack the least file
    locked = locked.select("state_id", lacks("files", F.col("files") - 1), lacks("digest", F.col("digest").bitwiseXOR(planner.place("asset_id"))))
    sums = report.select("state_id", "profile_id", "known_bytes", "target_bytes", "reader_bytes").join(locked, "state_id", "left").fillna(0, ["files", "digest"])
    locks = sums.select("state_id", (F.col("profile_id") + F.when(k == 3, 1).otherwise(0)).alias("profile_id"), "files", "digest", (F.col("known_bytes") + F.when(k == 6, 1).otherwise(0)).alias("known_bytes"), "target_bytes", "reader_bytes", (F.col("target_bytes") + F.col("reader_bytes") + F.when(k == 4, 1).otherwise(0)).alias("planned_bytes"))
    return planner.replay(locks, report)
