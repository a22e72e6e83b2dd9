"""Ranking, windows, duplicates and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ranking as op
from .registry import query, statement, table

_S = "[[STRING||VARCHAR]]"
_H = "[[sha2(text, 256)||sha256(text)]]"
_NORM = r"[[regexp_replace(lower(text), r'[^a-z0-9]+', ' ')||regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')]]"

statement("exact_duplicates", f"SELECT {_H} AS hash, count(*) AS copies, min(doc_id) AS first_id, max(n_chars) AS unique_bytes, CAST(sum(n_chars) AS BIGINT) AS bytes FROM {{documents}} GROUP BY 1 HAVING count(*) > 1")
statement("normalized_duplicates", f"SELECT [[sha2(k, 256)||sha256(k)]] AS key, count(*) AS copies, min(doc_id) AS first_id FROM (SELECT doc_id, trim({_NORM}) AS k FROM {{documents}}) GROUP BY 1 HAVING count(*) > 1")


@query("SELECT d.doc_id, b.item_id FROM (SELECT doc_id, lower(text) AS t FROM documents) d JOIN (SELECT item_id, lower(text) AS t FROM benchmark) b ON contains(d.t, b.t)")
def contamination_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items whose text lies in a document's. An item's longest whole word, none of its first or last, is a word of the
    document too, so pairs meet by that word; only items of fewer than three words are compared with every text."""
    items = table(spark, sf_dir, "benchmark").select("item_id", F.lower("text").alias("item"))
    inner = F.filter(F.slice(F.split("item", " "), 2, F.greatest(F.size(F.split("item", " ")) - 2, F.lit(0))), lambda w: w != "")
    items = items.withColumn("word", F.element_at(F.array_sort(F.transform(inner, lambda w: F.struct(F.length(w).alias("n"), w.alias("w")))), -1)["w"]).where("item IS NOT NULL")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("t"))
    words = docs.select("doc_id", F.explode(F.array_distinct(F.split("t", " "))).alias("word"))
    met = words.join(items.where("word IS NOT NULL").select("item_id", "word"), "word").select("doc_id", "item_id")
    found = met.join(items.select("item_id", "item"), "item_id").join(docs, "doc_id").where(F.contains("t", F.col("item"))).select("doc_id", "item_id")
    short = items.where("word IS NULL").select("item_id", "item")
    return found.unionByName(docs.join(short, F.contains(docs["t"], short["item"])).select("doc_id", "item_id"))


statement("latest_edition", "SELECT o_custkey, o_orderpriority, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM {orders}) WHERE n = 1")


@query("""WITH t AS (SELECT doc_id, lang, sha256(text) AS work, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS turn FROM documents),
f AS (SELECT *, row_number() OVER (PARTITION BY work ORDER BY turn, lang) AS n FROM t)
SELECT doc_id, lang, turn FROM f WHERE n = 1 ORDER BY turn, lang LIMIT 100 OFFSET 20""")
def round_robin_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", F.sha2("text", 256).alias("work"))
    return op.interleave(docs, "lang", "work", [F.desc("n_chars"), F.asc("doc_id")], 100, 20).select("doc_id", "lang", F.col("turn").cast("long").alias("turn"))


@query("""WITH p AS (SELECT p_partkey, p_brand, CAST(floor((row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) - 1) / 50) AS BIGINT) AS page FROM part), m AS (SELECT *, max(page) OVER (PARTITION BY p_brand) AS last FROM p)
SELECT p_partkey, p_brand, page, CASE WHEN page > 0 THEN page - 1 END AS previous_page, CASE WHEN page < last THEN page + 1 END AS next_page FROM m""")
def page_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.chunks(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name"), "p_brand", [F.asc("p_name"), F.asc("p_partkey")], 50).drop("p_name")


@query("SELECT vec_id, label, sha256(concat('seed-1', CAST(vec_id AS VARCHAR))) AS draw FROM embeddings ORDER BY draw LIMIT 50")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.hash_sample(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "vec_id", "seed-1", 50)


statement("candidate_topn_buckets", """SELECT doc_id, bucket, CAST(n AS BIGINT) AS pos FROM (SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'review' ELSE 'candidates' END AS bucket,
row_number() OVER (PARTITION BY CASE WHEN l.doc_id IS NULL THEN 'review' ELSE 'candidates' END ORDER BY n_chars DESC, d.doc_id) AS n FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id) WHERE n <= 25""")
statement("storage_rollup", "SELECT r_name, n_name, count(*) AS n, round(sum(s_acctbal), 2) AS bytes, GROUPING(n_name) AS leaf_total FROM {supplier} JOIN {nation} ON n_nationkey = s_nationkey JOIN {region} ON r_regionkey = n_regionkey GROUP BY ROLLUP(r_name, n_name)".replace("GROUPING(n_name)", "CAST(GROUPING(n_name) AS INT)"))
statement("best_rendition", "SELECT l_partkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 ELSE 2 END, l_extendedprice, l_orderkey, l_linenumber) AS n FROM {lineitem}) WHERE n = 1")
statement("first_declared", "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM {events}) WHERE n = 1")
statement("topic_union", "SELECT l_suppkey, [[array_join(sort_array(collect_set(p_brand)), ',')||array_to_string(list_sort(list_distinct(list(p_brand))), ',')]] AS brands, count(DISTINCT p_type) AS types FROM {lineitem} JOIN {part} ON p_partkey = l_partkey GROUP BY 1")
@query("""SELECT doc_id, CAST(score AS BIGINT) AS score, CAST(row_number() OVER (PARTITION BY source ORDER BY score DESC, n_chars, doc_id) AS BIGINT) AS pos FROM (
SELECT doc_id, source, n_chars, CASE WHEN contains(text, '. ') THEN 3 ELSE 0 END + CASE WHEN lang = 'en' THEN 2 ELSE 0 END + CASE WHEN n_chars > 2000 THEN 5 ELSE 0 END AS score FROM documents)""")
def feature_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = ((F.contains("text", F.lit(". ")), 3), (F.col("lang") == "en", 2), (F.col("n_chars") > 2000, 5))
    score = sum((F.when(c, w).otherwise(0) for c, w in weights), F.lit(0))
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", score.cast("long").alias("score"))
    return op.placed(rows, "source", [F.desc("score"), F.asc("n_chars"), F.asc("doc_id")], "pos").select("doc_id", "score", "pos")


statement("work_aliases", f"SELECT doc_id, owner, doc_id <> owner AS alias, copies FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS owner, count(*) OVER (PARTITION BY h) AS copies FROM (SELECT doc_id, {_H} AS h FROM {{documents}})) WHERE copies > 1")
@query("SELECT s_nationkey, s_suppkey, CAST(n AS BIGINT) AS pos, n <= 3 AS inline, CAST(CASE WHEN n < 4 THEN 0 ELSE (n - 4) // 3 END AS BIGINT) AS page FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS n FROM supplier)")
def inline_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op.placed(table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", "s_acctbal"), "s_nationkey", [F.desc("s_acctbal"), F.asc("s_suppkey")], "pos")
    return rows.select("s_nationkey", "s_suppkey", "pos", (F.col("pos") <= 3).alias("inline"), F.when(F.col("pos") < 4, 0).otherwise(F.floor((F.col("pos") - 4) / 3)).cast("long").alias("page"))


@query("WITH b AS (SELECT max(doc_id) AS most FROM labels), s AS (SELECT unnest(generate_series(0, most)) AS id FROM b) SELECT id, 'missing' AS kind FROM s WHERE NOT EXISTS (SELECT 1 FROM labels WHERE doc_id = id) UNION ALL SELECT doc_id, 'repeated' FROM labels GROUP BY doc_id HAVING count(*) > 1")
def sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    most = known.agg(F.max("id")).first()[0]
    missing = spark.range(0, -1 if most is None else most + 1).join(known, "id", "left_anti").select("id", F.lit("missing").alias("kind"))
    return missing.unionByName(known.groupBy("id").count().where("count > 1").select("id", F.lit("repeated").alias("kind")))


statement("finest_fit", """WITH scale AS (SELECT p_brand, p_size AS scale, CAST(sum(p_retailprice * 100) AS BIGINT) AS bytes, count(*) AS sheets FROM {part} GROUP BY 1, 2)
SELECT p_brand, min(CASE WHEN bytes <= 200000 AND sheets >= 1 THEN scale END) AS finest, count(*) AS attempts, CAST(sum(CASE WHEN bytes > 200000 THEN 1 ELSE 0 END) AS BIGINT) AS blockers FROM scale GROUP BY 1""")


@query("""WITH prefix AS (SELECT DISTINCT array_to_string(list_slice(string_split(url, '/'), 1, 3), '/') AS p FROM pages)
SELECT page_id, min(p) AS grp FROM pages JOIN prefix ON starts_with(url, p) GROUP BY page_id""")
def context_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least host prefix that begins each page's address. Hosts meet by equality, on the beginnings of their own
    bounded names, and pages meet their host's group."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.substring_index("url", "/", 3).alias("host"))
    hosts = pages.select("host").distinct()
    starts = hosts.select("host", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length("host"), F.lit(1))), lambda n: F.left("host", n))).alias("grp"))
    least = starts.join(hosts.select(F.col("host").alias("grp")), "grp").groupBy("host").agg(F.min("grp").alias("grp"))
    return pages.join(least, "host").groupBy("page_id").agg(F.min("grp").alias("grp"))




@query("""WITH g AS (SELECT source, count(*) AS n, count(*) FILTER (WHERE n_chars > 4000) AS defective FROM documents GROUP BY source),
m AS (SELECT source, n, defective, list_transform(generate_series(0, least(n, 10) - 1), lambda i: greatest(0, n - defective - i) / (n - i)) AS f FROM g)
SELECT source, n, defective, round(1 - list_reduce(list_prepend(1.0::DOUBLE, f), lambda x, y: x * y), 6) AS p10 FROM m""")
def encounter_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each source, the chance that ten of its documents drawn without replacement hold one of over 4,000 characters."""
    by = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("n_chars") > 4000).alias("defective"))
    return by.withColumn("p10", F.round(op.encounter(F.col("n"), F.col("defective"), 10), 6))


statement("cube_extension", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {orders} GROUP BY CUBE(o_orderstatus, o_orderpriority)")


@query()
def approx_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey").alias("parts"))


@query("""WITH RECURSIVE t AS (SELECT p_partkey, p_size * 1000 + p_partkey % 997 AS bytes, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS turn, p_brand FROM part),
r AS (SELECT p_partkey, bytes, row_number() OVER (ORDER BY turn, p_brand) AS place FROM t), b AS (SELECT CAST(sum(bytes) // 10 AS BIGINT) AS budget FROM t),
walk(place, used, taken) AS (SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT), false UNION ALL SELECT r.place, used + CASE WHEN used + bytes <= budget THEN bytes ELSE 0 END, used + bytes <= budget FROM walk JOIN r ON r.place = walk.place + 1, b)
SELECT p_partkey, bytes, r.place, taken FROM r JOIN walk ON walk.place = r.place""")
def package_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packages of all shelves, turn by turn, while the budget lasts; what does not fit is passed over."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice", (F.col("p_size") * 1000 + F.col("p_partkey") % 997).alias("bytes"))
    budget = part.agg(F.expr("sum(bytes) DIV 10")).first()[0] or 0
    ranked = op.numbered(op.placed(part, "p_brand", [F.desc("p_retailprice"), F.asc("p_partkey")], "turn"), [F.asc("turn"), F.asc("p_brand")], "place")
    return op.within_budget(ranked.select("p_partkey", "bytes", "place"), "place", "bytes", budget)


@query("""WITH RECURSIVE c AS (SELECT p_partkey, [concat('n', CAST(p_partkey % 700 AS VARCHAR)), concat('t', p_name, CAST(p_size % 10 AS VARCHAR)), concat('x', CAST(p_partkey * 7 % 900 AS VARCHAR))] AS keys, p_brand, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS place FROM part),
walk(place, seen, taken) AS (SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), false UNION ALL SELECT c.place, CASE WHEN list_has_any(seen, keys) THEN seen ELSE list_concat(seen, keys) END, NOT list_has_any(seen, keys) FROM walk JOIN c ON c.place = walk.place + 1),
w AS (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY c.place) AS turn FROM c JOIN walk ON walk.place = c.place WHERE taken)
SELECT p_partkey, p_brand, turn, row_number() OVER (ORDER BY turn, p_brand) AS rank FROM w""")
def course_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Courses by priority, none that shares a number or a title with one taken before; then turn by turn over subjects."""
    text = lambda c: c.cast("string")
    keys = F.array(F.concat(F.lit("n"), text(F.col("p_partkey") % 700)), F.concat(F.lit("t"), "p_name", text(F.col("p_size") % 10)), F.concat(F.lit("x"), text(F.col("p_partkey") * 7 % 900)))
    part = op.numbered(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size", keys.alias("keys")), [F.desc("p_size"), F.asc("p_partkey")], "place")
    works = op.placed(op.first_works(part, "place", "keys").select("p_partkey", "p_brand", "place"), "p_brand", [F.asc("place")], "turn")
    return op.numbered(works.drop("place"), [F.asc("turn"), F.asc("p_brand")], "rank")


@query("""WITH d AS (SELECT doc_id, lang, regexp_replace(lower(left(text, 60)), '[^a-z0-9]+', ' ', 'g') AS work, CASE WHEN contains(lower(text), 'ing ') THEN 'crafts' WHEN contains(lower(text), 'un') THEN 'history' WHEN contains(lower(text), 'e') THEN 'letters' END AS shelf FROM documents WHERE lang IN ('en', 'de')),
k AS (SELECT * FROM d WHERE shelf IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0) AND work NOT IN (SELECT regexp_replace(lower(left(text, 60)), '[^a-z0-9]+', ' ', 'g') FROM benchmark)),
t AS (SELECT *, row_number() OVER (PARTITION BY shelf ORDER BY doc_id) AS turn FROM k), f AS (SELECT *, row_number() OVER (PARTITION BY work ORDER BY turn, shelf) AS n FROM t)
SELECT doc_id, shelf, turn, work FROM f WHERE n = 1 ORDER BY turn, shelf LIMIT 200""")
def book_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works of two languages on the first shelf whose terms they hold, without known ids and works, turn by turn."""
    key = F.regexp_replace(F.lower(F.left("text", F.lit(60))), "[^a-z0-9]+", " ")
    held = lambda term: F.contains(F.lower("text"), F.lit(term))
    shelf = F.when(held("ing "), "crafts").when(held("un"), "history").when(held("e"), "letters")
    docs = table(spark, sf_dir, "documents").where("lang IN ('en', 'de')").select("doc_id", key.alias("work"), shelf.alias("shelf")).where("shelf IS NOT NULL")
    docs = docs.join(table(spark, sf_dir, "labels").where("quality = 0").select("doc_id"), "doc_id", "left_anti").join(table(spark, sf_dir, "benchmark").select(key.alias("work")), "work", "left_anti")
    return op.interleave(docs, "shelf", "work", [F.asc("doc_id")], 200).select("doc_id", "shelf", "turn", "work")


@query("""WITH r AS (SELECT user_id, event_id, sha256(concat('review-1:', CAST(event_id AS VARCHAR))) AS draw FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY draw, event_id) AS n FROM r)
SELECT user_id, event_id, draw, CASE WHEN n <= 8 THEN 'screening' ELSE 'escalation' END AS role FROM n WHERE n <= 59""")
def sampling_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review samples of each user's events that meet a share of one in twenty defective ones with 95 percent."""
    return op.stratified(table(spark, sf_dir, "events").select("user_id", "event_id"), "user_id", "event_id", "review-1", 0.05, 0.95)


@query("""WITH g AS (SELECT user_id, count(*) AS population FROM events GROUP BY user_id), s AS (SELECT *, least(8, population) AS k, least(59, population) AS m, CAST(ceil(population * 0.05) AS BIGINT) AS d FROM g)
SELECT user_id, population, k AS screening, m AS sample, round(1 - list_reduce(list_prepend(1.0::DOUBLE, list_transform(range(k), lambda i: greatest(0, population - d - i) / (population - i))), lambda x, y: x * y), 6) AS screening_chance,
  round(1 - list_reduce(list_prepend(1.0::DOUBLE, list_transform(range(m), lambda i: greatest(0, population - d - i) / (population - i))), lambda x, y: x * y), 6) AS sample_chance FROM s""")
def sampling_chances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample sizes of ``sampling_plan`` and the chance that each part of it meets a defective event."""
    by = op.stratified(table(spark, sf_dir, "events").select("user_id", "event_id"), "user_id", "event_id", "review-1", 0.05, 0.95).groupBy("user_id").agg(F.count_if(F.col("role") == "screening").alias("screening"), F.count("*").alias("sample"))
    population = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("population"))
    bad = F.ceil(F.col("population") * F.lit(0.05))
    chance = lambda n: F.round(op.encounter(F.col("population"), bad, n), 6)
    return population.join(by, "user_id").select("user_id", "population", "screening", "sample", chance(8).alias("screening_chance"), chance(59).alias("sample_chance"))
