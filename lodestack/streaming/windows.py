"""Structured Streaming over event files: watermarked windows, run to the end of what is there."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root


def tumbling(events: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts for each window and event type of a stream; state older than the watermark is dropped."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.window("at", width), "event_type").agg(F.count("*").alias("n"))


def stream_of(spark: SparkSession, path: str) -> DataFrame:
    """A stream of a Parquet file or folder with the schema of what is there."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "false").parquet(f"{folder}/{name[:-8]}*.parquet")


def daily_counts(spark: SparkSession, path: str) -> DataFrame:
    """All windows counted by a stream that ends when every file is read (complete mode, so open windows count). Each
    micro-batch replaces the written table, so a batch that is replayed does too."""
    folder = f"{checkpoint_root(spark)}/daily-{uuid.uuid4().hex}"

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/table")

    counts = tumbling(stream_of(spark, path)).select(F.unix_timestamp("window.start").alias("day_start"), "event_type", "n")
    run = counts.writeStream.outputMode("complete").foreachBatch(save).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema("day_start long, event_type string, n long").parquet(f"{folder}/table")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 days") -> DataFrame:
    """Sessions of each user of a stream: events without a pause of ``gap``."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.session_window("at", gap), "user_id").agg(F.count("*").alias("n"))


def once(events: DataFrame, key: str = "event_id", late: str = "2 days") -> DataFrame:
    """The stream without repeated keys within the watermark, for sources that deliver at least once."""
    return events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late).dropDuplicatesWithinWatermark([key])


def append_batches(stream: DataFrame, folder: str, checkpoint: str):
    """Writes each micro-batch to its own subfolder, so a batch that is replayed replaces itself."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
