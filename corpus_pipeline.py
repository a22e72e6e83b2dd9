"""Training-corpus pipeline: quality filter, near-dedup, decontamination, secret removal, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs.
A stage's result is written and read again before the next one. Null texts count as empty texts throughout: they
are scored, linked and scanned like empty texts, and get null token ids at the end.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm import decontaminate, piece_fst, quality, secret_ledger, simhash
from lodestack.llm.common import labelled, prepared, settle, shared_root, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects (score under 0.3). It learns from the labelled ones.

    Null texts are scored as empty ones; rows without a doc_id are scored too, and equal texts share their fate.
    """
    known = quality.bounded(labelled(table(spark, sf_dir, "labels"), "quality", 0, 5), "doc_id", quality.TRAIN_ROWS)
    # A bounded number of (id, label) rows, so that side is broadcast and no text is shuffled.
    training = quality.with_statistics(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id"), out="__stats")
    model = quality.fit(settle(training.select("__stats", "quality"), "quality-training"), "quality", "__stats")
    graded = quality.scored(quality.with_statistics(docs, out="__stats"), model, "__stats", "__score")
    return graded.where(F.col("__score") >= quality.ACCEPT).select(*docs.columns)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies, texts linked at 0.8 of their five-word shingles, the least doc_id.

    Rows of one doc_id are kept or dropped together, but of repeated rows one stays. Rows without a doc_id cannot
    be told apart and stay.
    """
    prepared(spark)
    first = simhash.similar(docs).groupBy("component").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    kept = docs.where("doc_id IS NOT NULL").join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id IS NULL"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that leak a benchmark item, in the same or in other values.

    Null and empty texts leak nothing; repeated rows go or stay together, and rows without a doc_id go by their text.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; every document stays, repeated rows and null texts too."""
    prepared(spark)
    return secret_ledger.redact(docs, f"{shared_root(spark)}/secret-ledger-{uuid.uuid4().hex}")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it."""
    prepared(spark)
    return piece_fst.encoded(docs, piece_fst.read_model())


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", keep_distinct),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("SentencePiece encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = settle(docs, f"pipeline-{i}")
    return docs


#: The classifier, the near-duplicates and the encoding cannot be stated in SQL.
ORACLE_SQL = None
