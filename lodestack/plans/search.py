"""Search, index compilation and their evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import search as op
from ..sources import writers
from .registry import query, statement, table

ASKED = [(1, "the that of", "all"), (2, "de la en", "all"), (3, "der und sch", "de"), (4, "idiot", "all-with-legacy"), (5, "thes in", "legacy"), (6, "zzzz", "all"), (7, "ＴＨＥ　of", "all"), (8, "Item ７", "all-with-legacy")]
#: The phrases again in lower case and compatible form, for the SQL, which has no such function.
_PLAIN = {7: "the of", 8: "item 7"}
_ASKED_SQL = "(VALUES " + ", ".join(f"({i}, '{_PLAIN.get(i, p)}', '{shelf}')" for i, p, shelf in ASKED) + ") AS q(query_id, phrase, shelf)"

_SEARCH_SQL = r"""
asked AS (SELECT CAST(query_id AS INT) AS query_id, shelf, trim(regexp_replace(lower(phrase), '\s+', ' ', 'g')) AS phrase, list_distinct(regexp_extract_all(lower(phrase), '[\p{L}\p{N}]+')) AS words FROM """ + _ASKED_SQL + r"""),
w AS (SELECT query_id, unnest(words) AS word FROM asked),
h AS (SELECT record_id, unnest(list_distinct(regexp_extract_all(lower(concat(title, ' ', alias)), '[\p{L}\p{N}]+'))) AS word, 1 AS in_title FROM records
      UNION ALL SELECT record_id, unnest(list_distinct(regexp_extract_all(lower(concat(body, ' ', lang, ' ', source)), '[\p{L}\p{N}]+'))), 0 FROM records),
f AS (SELECT query_id, record_id, word, max(in_title) AS in_title FROM h JOIN w USING (word) GROUP BY ALL),
g AS (SELECT query_id, record_id, count(*) AS hits, sum(in_title) AS title_hits FROM f GROUP BY ALL),
s AS (SELECT g.query_id, g.record_id, title, href,
        CAST((CASE WHEN phrase IN (trim(regexp_replace(lower(title), '\s+', ' ', 'g')), trim(regexp_replace(lower(alias), '\s+', ' ', 'g'))) THEN 100000 WHEN hits = len(words) THEN 10000 ELSE 0 END) + hits * 100 + title_hits * 10 AS BIGINT) AS score
      FROM g JOIN records USING (record_id) JOIN asked ON asked.query_id = g.query_id
      WHERE CASE shelf WHEN 'legacy' THEN legacy WHEN 'all-with-legacy' THEN TRUE WHEN 'all' THEN NOT legacy ELSE NOT legacy AND coalesce(shelf IN (lang, source), FALSE) END),
d AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY query_id, href ORDER BY score DESC, title, record_id) = 1),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, title, record_id) AS rank, record_id, score FROM d)
"""
_RECORDS_SQL = "records AS (SELECT doc_id AS record_id, left(text, 60) AS title, concat('Item ', doc_id) AS alias, text AS body, lang, source, doc_id %% 7 = 3 AS legacy, concat(source, '/', sha256(text)) AS href FROM documents %s)"


def records(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").alias("record_id"),
        F.left("text", F.lit(60)).alias("title"),
        F.array(F.concat(F.lit("Item "), F.col("doc_id").cast("string"))).alias("aliases"),
        F.col("text").alias("body"),
        F.array_compact(F.array("lang", "source")).alias("shelves"),
        (F.col("doc_id") % 7 == 3).alias("legacy"),
        F.concat(F.col("source"), F.lit("/"), F.sha2("text", 256)).alias("href"),
        F.lit("Complete").alias("location"),
    )


def asked(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ASKED, "query_id int, phrase string, shelf string")


@query("WITH " + _RECORDS_SQL % "" + "," + _SEARCH_SQL + "SELECT * FROM r WHERE rank <= 50")
def search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.search(records(table(spark, sf_dir, "documents")), asked(spark))


@query("WITH " + _RECORDS_SQL % "WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AND doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)" + "," + _SEARCH_SQL + "SELECT * FROM r WHERE rank <= 20")
def search_shelf_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").join(labels.where("quality = 1").select("doc_id"), "doc_id", "left_semi")
    return op.search(records(docs.join(labels.where("toxic = 1").select("doc_id"), "doc_id", "left_anti")), asked(spark), 20)


_RECALL_SQL = """
WITH w AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(lower(left(text, 80)), '[\\p{L}\\p{N}]+'))) AS word, text FROM benchmark),
t AS (SELECT item_id, unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'))) AS word FROM benchmark),
g AS (SELECT w.item_id AS query_id, t.item_id AS record_id, count(*) AS hits FROM w JOIN t USING (word) GROUP BY ALL),
n AS (SELECT item_id, count(*) AS n FROM w GROUP BY 1),
s AS (SELECT query_id, record_id, hits * 100 + CASE WHEN hits = n THEN 10000 ELSE 0 END AS score FROM g JOIN n ON n.item_id = query_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, record_id) AS k FROM s)
SELECT count(*) AS tasks, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM r WHERE r.query_id = b.item_id AND r.record_id = b.item_id AND k <= 5)) AS passed FROM benchmark b
"""


@query(_RECALL_SQL)
def recall_at_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark")
    known = items.select(F.col("item_id").alias("record_id"), F.lit("").alias("title"), F.col("text").alias("body"), F.col("item_id").cast("string").alias("href"), F.lit("").alias("location"))
    found = op.search(known, items.select(F.col("item_id").alias("query_id"), F.left("text", F.lit(80)).alias("phrase")), 5)
    return op.recall(found, items.select(F.col("item_id").alias("query_id"), F.col("item_id").alias("record_id")), 5)


statement("compile_records", """
WITH location AS (
  SELECT [[sha2(text, 256)||sha256(text)]] AS location, min(doc_id) AS record_id, count(*) AS copies,
         [[array_join(sort_array(collect_set(source)), ',')||array_to_string(list_sort(list_distinct(list(source))), ',')]] AS labels,
         [[array_join(sort_array(collect_set(lang)), ',')||array_to_string(list_sort(list_distinct(list(lang))), ',')]] AS aliases
  FROM {documents} GROUP BY 1)
SELECT l.record_id, l.location, l.copies, l.labels, l.aliases, coalesce(r.quality, -1) AS quality, CASE WHEN b.item_id IS NULL THEN 'document' ELSE 'reference' END AS kind
FROM location l LEFT JOIN {labels} r ON r.doc_id = l.record_id LEFT JOIN {benchmark} b ON [[sha2(b.text, 256)||sha256(b.text)]] = l.location
""")

statement("label_az_index", """
SELECT letter, label, count(*) AS n, [[array_join(sort_array(collect_list(p_partkey)), ',')||array_to_string(list_sort(list(p_partkey)), ',')]] AS ids
FROM (SELECT p_partkey, lower(p_name) AS label, CASE WHEN upper(left(p_name, 1)) BETWEEN 'A' AND 'Z' THEN upper(left(p_name, 1)) WHEN left(p_name, 1) BETWEEN '0' AND '9' THEN '0-9' ELSE 'other' END AS letter FROM {part})
GROUP BY letter, label
""")

statement("annotation_upsert", """
SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'kept' WHEN d.doc_id IS NULL THEN 'inserted' ELSE 'merged' END AS action,
       concat_ws(',', d.lang, CASE WHEN l.quality = 1 THEN 'reviewed' END, CASE WHEN l.toxic = 1 THEN 'blocked' END) AS aliases
FROM {documents} d FULL OUTER JOIN {labels} l ON d.doc_id = l.doc_id
""")

@query("""WITH r AS (SELECT o_orderkey, sha256(concat('{"o_orderkey":', o_orderkey, ',"o_orderpriority":"', o_orderpriority, '","o_orderstatus":"', o_orderstatus, '"}')) AS h FROM orders), n AS (SELECT h, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM r),
a AS (SELECT n // 256 AS n, sha256(string_agg(h, '' ORDER BY n)) AS h FROM n GROUP BY 1), b AS (SELECT n // 256 AS n, CASE WHEN (SELECT count(*) FROM a) > 1 THEN sha256(string_agg(h, '' ORDER BY n)) ELSE min(h) END AS h FROM a GROUP BY 1), c AS (SELECT CASE WHEN count(*) > 1 THEN sha256(string_agg(h, '' ORDER BY n)) ELSE min(h) END AS h FROM b)
SELECT (SELECT count(*) FROM orders) AS records, h AS digest FROM c""")
def bundle_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest that names a bundle of all orders."""
    return writers.digest(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus"), ["o_orderkey"])


statement("topic_matrix", """
WITH topics(topic, word) AS (VALUES ('articles', ' the '), ('articles', ' der '), ('links', ' and '), ('links', ' und '), ('questions', ' que '), ('none', 'qqqq')),
hit AS (SELECT DISTINCT topic, doc_id, lang FROM topics JOIN {documents} ON contains(lower(text), word))
SELECT t.topic, lang, count(doc_id) AS n, min(doc_id) AS first_id FROM (SELECT DISTINCT topic FROM topics) t LEFT JOIN hit ON hit.topic = t.topic GROUP BY t.topic, lang
""")

statement("page_keyword_context", """
SELECT doc_id, CAST([[instr||strpos]](lower(text), ' with ') AS BIGINT) AS at,
       substring(text, [[greatest(1, instr(lower(text), ' with ') - 50), least(50, instr(lower(text), ' with ') - 1) + 96||CAST(greatest(1, strpos(lower(text), ' with ') - 50) AS INT), CAST(least(50, strpos(lower(text), ' with ') - 1) + 96 AS INT)]]) AS context
FROM {documents} WHERE contains(lower(text), ' with ')
""")

statement("excerpt_windows", """
WITH n AS (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n FROM {documents}),
o AS (SELECT doc_id, text, 0 AS start FROM n UNION SELECT doc_id, text, greatest(0, [[(n - 500) div 2||(n - 500) // 2]]) FROM n UNION SELECT doc_id, text, greatest(0, n - 500) FROM n)
SELECT doc_id, CAST(start AS BIGINT) AS start, [[sha2(substring(text, CAST(start AS INT) + 1, 500), 256)||sha256(substring(text, CAST(start AS INT) + 1, 500))]] AS excerpt FROM o
""")
