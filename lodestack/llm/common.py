"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, importable, settled


def shared_root(spark: SparkSession) -> str:
    """Folder that the driver and all executors share."""
    return checkpoint_root(spark)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and survives lost executors."""
    return settled(df, name)


#: Rows that a Python worker gets at once: whole texts may be long, so fewer than Spark's own default.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepared(spark: SparkSession) -> None:
    """Lets workers import this package, and bounds the rows of a batch unless the session has set a bound itself."""
    importable(spark)
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepared(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str | Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; null keys fall in fold 0."""
    c = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % n, F.lit(0))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def labelled(labels: DataFrame, label: str, held_fold: int, folds: int) -> DataFrame:
    """(doc_id, label) of the rows to learn from: a label is known and the fold is not held out."""
    return labels.select("doc_id", label).where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", folds) != held_fold))
