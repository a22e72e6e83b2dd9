"""Question-and-answer posts: user turns are questions, assistant turns answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import posts as op
from .registry import query, statement, table

statement("qa_top2_answers", """WITH q AS (SELECT conv_id, turn FROM {conversations} WHERE role = 'user'),
a AS (SELECT conv_id, turn, CAST(length(text) % 17 AS BIGINT) - 3 AS score FROM {conversations} WHERE role = 'assistant'),
p AS (SELECT q.conv_id, q.turn AS question, a.turn AS answer, a.score, a.turn = q.turn + 1 AND a.score >= 0 AS accepted FROM q JOIN a ON a.conv_id = q.conv_id AND a.turn > q.turn),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, question, accepted ORDER BY score DESC, answer) AS n FROM p WHERE accepted OR score > 0)
SELECT conv_id, question, answer, score, accepted FROM r WHERE (accepted AND n = 1) OR (NOT accepted AND n <= 2)""")

RULES = op.Rules(
    deny_tags=("lang1",), allow_tags=("lang2", "lang3"), legacy_tags=("lang4",), excluded_ids=(100, 300), legacy_ids=(500,), durable_ids=(700, 900), versions=(op.Versions("any", ("lang0", "lang2"), r"\b(\d+(?:\.\d+)*)", (1, 2, 3)),)
)
_POST = """post AS (SELECT conv_id * 100 + turn AS id, CASE WHEN role = 'user' THEN 1 ELSE 2 END AS type, length(text) % 7 AS score, conv_id % 4 AS answers, concat('<lang', conv_id % 6, '><t', turn, '>') AS tags, text AS title FROM conversations)"""


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: c.cast("string")
    tags = F.concat(F.lit("<lang"), text(F.col("conv_id") % 6), F.lit("><t"), text(F.col("turn")), F.lit(">"))
    own = table(spark, sf_dir, "conversations")
    return own.select((F.col("conv_id") * 100 + F.col("turn")).alias("id"), F.when(F.col("role") == "user", 1).otherwise(2).alias("type"), (F.length("text") % 7).alias("score"), (F.col("conv_id") % 4).alias("answers"), tags.alias("tags"), F.col("text").alias("title"))


@query(f"""WITH {_POST}, v AS (SELECT *, list_filter(regexp_extract_all(title, '\\b(\\d+(?:\\.\\d+)*)', 1), lambda x: x <> '') AS found, regexp_matches(title, '(?i)\\b(old|older|legacy|ancient)\\b') AS worded FROM post),
m AS (SELECT *, len(list_filter(found, lambda x: CAST(split_part(x, '.', 1) AS HUGEINT) IN (1, 2, 3))) AS old, (contains(tags, '<lang0>') OR contains(tags, '<lang2>')) AS tagged FROM v),
k AS (SELECT *, tagged AND old > 0 AND old = len(found) AS legacy, tagged AND old > 0 AND old < len(found) AS mixed FROM m),
w AS (SELECT *, worded AND NOT legacy AND NOT mixed AS wording, id IN (700, 900) OR contains(tags, '<lang2>') OR contains(tags, '<lang3>') AS chosen FROM k)
SELECT id, CASE WHEN type <> 1 OR score < 1 OR answers < 1 THEN NULL WHEN id IN (100, 300) OR contains(tags, '<lang1>') THEN NULL WHEN id = 500 OR contains(tags, '<lang4>') THEN 'legacy'
  WHEN mixed OR wording THEN 'review' WHEN legacy THEN 'legacy' WHEN chosen THEN 'durable' END AS bucket FROM w""")
def qa_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets of posts by rules given as data."""
    return op.classify(_posts(spark, sf_dir), RULES).select("id", "bucket")


@query(r"""WITH t AS (SELECT conv_id, turn, trim(text) AS t FROM conversations), n AS (SELECT *, len(list_filter(regexp_split_to_array(t, '\s+'), lambda w: w <> '')) AS words FROM t)
SELECT conv_id, turn FROM n WHERE NOT regexp_matches(t, '(?i)^(thanks|thank you|\+1)[.!\s]*$') AND ((length(t) >= 40 AND words >= 6)
  OR (length(t) >= 12 AND words >= 3 AND regexp_matches(t, '(?i)\b(""" + op.WARNING_WORDS.replace("'", "''") + r""")\b')))""")
def substantive_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that say something: prose, or a shorter warning; no thanks."""
    return table(spark, sf_dir, "conversations").where(op.substantive("text")).select("conv_id", "turn")


statement("qa_semi_joins", """WITH canon AS (SELECT doc_id AS id FROM {labels} WHERE quality = 1),
post AS (SELECT conv_id, turn, conv_id AS id, CASE WHEN role = 'assistant' THEN conv_id END AS parent, role FROM {conversations}),
kept AS (SELECT conv_id, turn, role FROM post WHERE id IN (SELECT id FROM canon) UNION SELECT conv_id, turn, role FROM post WHERE parent IN (SELECT id FROM canon))
SELECT k.conv_id, k.turn, coalesce(d.source, CASE WHEN k.role = 'user' THEN 'user' END, 'author unknown') AS author FROM kept k LEFT JOIN {documents} d ON d.doc_id = k.conv_id""")

statement("rule_gaps", """WITH hit AS (
SELECT doc_id AS id, 'no label' AS gap FROM {documents} d WHERE NOT EXISTS (SELECT 1 FROM {labels} l WHERE l.doc_id = d.doc_id)
UNION ALL SELECT doc_id, 'short' FROM {documents} WHERE n_chars < 100
UNION ALL SELECT doc_id, 'blocked' FROM {labels} WHERE toxic = 1
UNION ALL SELECT conv_id, 'unanswered' FROM {conversations} GROUP BY conv_id HAVING sum(CASE WHEN role = 'assistant' THEN 1 ELSE 0 END) = 0)
SELECT gap, count(*) AS n, count(DISTINCT id) AS ids, min(id) AS first_id FROM hit GROUP BY gap""")
