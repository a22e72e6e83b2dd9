"""Queries of the training-data operators, as registered by the entry module."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fill_in_middle, filter_audit, html_text, jaccard_join, langid, minhash, piece_fst, quality, secret_ledger, simhash, toxicity, warc_archive
from .common import fold, labelled, settle, shared_root, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.class_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_fst.encoded(table(spark, sf_dir, "documents"), piece_fst.read_model())


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = docs.select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL").where(fold("doc_id", 3) != 1)
    filters = langid.learn(quality.bounded(known, "doc_id", langid.TRAIN_DOCS))
    return langid.identify(docs.select("doc_id", "text"), filters).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def quality_model(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, quality.Discriminant]:
    """The documents' statistics, and the discriminant fitted on those with a known label outside fold 0 of 5."""
    stats = settle(quality.with_statistics(docs.select("doc_id", "text")).select("doc_id", "stats"), "statistics")
    known = quality.bounded(labelled(labels, "quality", 0, 5), "doc_id", quality.TRAIN_ROWS)
    return stats, quality.fit(stats.join(known, "doc_id"), "quality")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats, model = quality_model(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    held = (fold("doc_id", 5) == 0).alias("held_out")
    return quality.scored(stats, model).select("doc_id", held, "score", (F.col("score") >= quality.ACCEPT).cast("int").alias("predicted"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = f"{shared_root(spark)}/secret-ledger-{uuid.uuid4().hex}"
    return secret_ledger.digest_report(secret_ledger.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), ledger))


def op6_rendered_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages")).select("page_id", "text")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprint_report(table(spark, sf_dir, "documents"))


def edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op7_fingerprints`` that SQL can state."""
    return op7_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal().alias("fingerprint"), "component_id")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_archive.round_trip(table(spark, sf_dir, "pages"), f"{shared_root(spark)}/warc-{uuid.uuid4().hex}")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = toxicity.learn(docs, labelled(table(spark, sf_dir, "labels"), "toxic", 1, 3))
    held = (fold("doc_id", 3) == 1).alias("held_out")
    return toxicity.scored(docs, scorer).select("doc_id", held, "score", (F.col("score") >= toxicity.ACCEPT).cast("int").alias("predicted"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.transformed(table(spark, sf_dir, "documents")).withColumn("restored", fill_in_middle.restored())
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_decontaminate, op2_pieces, op3_language, op4_quality, op5_secrets, op6_rendered_text, op7_fingerprints, op8_near_duplicates, op9_warc, op10_toxicity, op11_ngram_join, op12_fill_in_middle, op13_filter_audit, edited_texts)}

ORACLE_SQL: dict[str, str] = {
    "edited_texts": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
e AS (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n_chars, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS after FROM d)
SELECT doc_id, n_chars, sha256(concat(left(text, CAST(n_chars - n_chars // 2 AS INT)), left(after, CAST(n_chars // 2 AS INT)))) AS edited_sha256 FROM e
""",
    "op9_warc": """
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages
), m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM m
""",
    "op12_fill_in_middle": r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, sha256(concat('42:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS x FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
  CAST(concat('0x', substr(x, 1, 8)) AS BIGINT) AS h1, CAST(concat('0x', substr(x, 9, 8)) AS BIGINT) AS h2, CAST(concat('0x', substr(x, 17, 8)) AS BIGINT) AS h3, CAST(concat('0x', substr(x, 25, 8)) AS BIGINT) AS h4 FROM h),
c AS (SELECT doc_id, t, units, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
s AS (SELECT doc_id, t, n, form, coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a + 1:b], ''), '') AS m, coalesce(array_to_string(units[b + 1:n], ''), '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN concat('<P>', p, '<S>', s, '<M>', m) WHEN 'spm' THEN concat('<S>', s, '<P>', p, '<M>', m) ELSE t END) AS output_sha256, sha256(t) AS restored_sha256 FROM s
""",
    "op13_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT d.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [
  CASE WHEN len(w) < 100 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' END,
  CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' END,
  CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 'E' END] AS failed FROM d LEFT JOIN l ON l.doc_id = d.doc_id),
m AS (SELECT part, list_filter(failed, lambda x: x IS NOT NULL) AS failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
x(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT concat(a.c, b.c, e.c, g.c, h.c) AS filter_order FROM x a, x b, x e, x g, x h WHERE len(list_distinct([a.c, b.c, e.c, g.c, h.c])) = 5),
s AS (SELECT filter_order, CAST(step AS INT) AS step, substr(filter_order, step, 1) AS c, substr(filter_order, 1, step - 1) AS before FROM o, range(1, 6) r(step)),
r AS (SELECT part, filter_order, step, c,
  CAST(sum(CASE WHEN NOT list_has_any(failed, string_split(concat(before, c), '')) THEN n ELSE 0 END) AS BIGINT) AS kept,
  CAST(sum(CASE WHEN list_contains(failed, c) AND NOT list_has_any(failed, string_split(before, '')) THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN list_contains(failed, c) AND list_has_any(failed, string_split(before, '')) THEN n ELSE 0 END) AS BIGINT) AS redundant,
  CAST(sum(CASE WHEN failed = [c] THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN list_contains(failed, c) AND NOT list_has_any(failed, string_split(before, '')) THEN good ELSE 0 END) AS BIGINT) AS good_lost,
  CAST(sum(CASE WHEN list_contains(failed, c) AND NOT list_has_any(failed, string_split(before, '')) THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM m, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, c) AS BIGINT) AS shapley FROM r
""",
}
