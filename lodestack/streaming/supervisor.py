"""Job supervision as keyed state of a stream: retries with back-off, deadlines, and heartbeats that stop.

Each run is a key. A failure waits twice as long as the one before it, up to a bound, and is final after so many attempts
or past the deadline that counts from the first failure; a submission or a completion starts anew. A run whose events stop
for ``stale`` seconds, and which is neither complete nor failed, is reported stale once, by a timer in event time or by
the next event, whichever comes first. Batches of a stream must be in the order of time; rows of one batch may come in any
order. A batch that is replayed begins from the state before it, so it makes the same transitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..session import checkpoint_root
from .windows import append_batches

SCHEMA = "run_id long, event_id long, at_ms long, state string, attempt long, due_ms long"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@dataclass(frozen=True)
class Policy:
    first_delay: int = 5
    longest_delay: int = 300
    attempts: int = 6
    deadline: int = 3 * 86_400
    stale: int = 21_600


class Supervisor(StatefulProcessor):
    """State of a run: attempt, time of the first failure, whether it failed, last time, last state, stale told."""

    def __init__(self, policy: Policy):
        self.policy = policy

    def init(self, handle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "attempt long, since long, failed boolean, last long, state string, told boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values(["at_ms", "event_id"])
        attempt, since, failed, last, state, told = self.run.get() if self.run.exists() else (0, 0, False, None, "", True)
        out, p = [], self.policy
        for event, at, kind in zip(events["event_id"], events["at_ms"], events["kind"], strict=True):
            if last is not None and not told and at > last + 1000 * p.stale:
                out.append((key[0], None, last + 1000 * p.stale, "stale", attempt, None))
            due = None
            if kind == "submit":
                attempt, since, failed, state = 0, 0, False, "running"
            elif kind == "complete":
                attempt, since, failed, state = 0, 0, False, "complete"
            elif kind == "failure":
                attempt += 1
                since = since or int(at)
                delay = min(p.first_delay * 2 ** min(attempt - 1, 20), p.longest_delay)
                failed = failed or attempt >= p.attempts or at - since + 1000 * delay > 1000 * p.deadline
                state, due = ("failed", None) if failed else ("retry_wait", int(at) + 1000 * delay)
            else:
                state = "failed" if failed else "running"
            told, last = state in ("complete", "failed"), int(at)
            out.append((key[0], int(event), last, state, attempt, due))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not told:
            self.handle.registerTimer(last + 1000 * p.stale)
        self.run.update((attempt, since, failed, last, state, told))
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        attempt, since, failed, last, state, told = self.run.get()
        if told:
            yield self._frame([])
            return
        self.run.update((attempt, since, failed, last, state, True))
        yield self._frame([(key[0], None, last + 1000 * self.policy.stale, "stale", attempt, None)])

    def close(self) -> None:
        pass

    @staticmethod
    def _frame(rows: list[tuple]) -> pd.DataFrame:
        names = ["run_id", "event_id", "at_ms", "state", "attempt", "due_ms"]
        return pd.DataFrame(rows, columns=names).astype({c: "Int64" for c in names if c != "state"})


def transitions(events: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Of a stream (run_id, event_id, ts, kind) each event's transition, and stale reports (event_id is null)."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", "0 seconds").withColumn("at_ms", F.unix_millis("at"))
    return timed.groupBy("run_id").transformWithStateInPandas(Supervisor(policy), SCHEMA, "Append", "EventTime")


def run_once(spark: SparkSession, events: DataFrame, policy: Policy = Policy(), folder: str | None = None) -> DataFrame:
    """The transitions of all that a stream holds now, written and read again. Run again on the same folder it goes on from
    the state that the last run left."""
    folder = folder or f"{checkpoint_root(spark)}/supervisor-{uuid.uuid4().hex}"
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        append_batches(transitions(events, policy), f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)
    return spark.read.schema(SCHEMA).parquet(f"{folder}/table").drop("batch")


def batch_transitions(events: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """The same of a table, by windows over each run; the last event of all tells how far time has gone."""
    way = Window.partitionBy("run_id").orderBy("at_ms", "event_id")
    df = events.select("run_id", "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("at_ms"), "kind")
    now = df.agg(F.max("at_ms").alias("now"))
    fresh = (F.col("kind") == "submit") | F.coalesce(F.lag("kind").over(way) == "complete", F.lit(False))
    df = df.withColumn("segment", F.sum(fresh.cast("int")).over(way)).withColumn("ahead", F.lead("at_ms").over(way))
    here = Window.partitionBy("run_id", "segment").orderBy("at_ms", "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    failure: Column = F.col("kind") == "failure"
    df = df.withColumn("errors", F.count_if(failure).over(here)).withColumn("since", F.min(F.when(failure, F.col("at_ms"))).over(here))
    delay = F.least(F.lit(policy.first_delay) * F.pow(F.lit(2), F.least(F.col("errors") - 1, F.lit(20))), F.lit(policy.longest_delay)).cast("long")
    late = failure & ((F.col("errors") >= policy.attempts) | (F.col("at_ms") - F.col("since") + 1000 * delay > 1000 * policy.deadline))
    df = df.withColumn("failed", F.max(late).over(here))
    done = F.col("kind") == "complete"
    state = F.when(done, "complete").when(F.col("failed"), "failed").when(failure, "retry_wait").otherwise("running")
    due = F.when(failure & ~F.col("failed"), F.col("at_ms") + 1000 * delay)
    df = df.join(F.broadcast(now), F.lit(True)).withColumn("state", state).withColumn("attempt", F.when(done, 0).otherwise(F.col("errors")).cast("long"))  # one row
    gone = F.col("at_ms") + 1000 * policy.stale
    stale = df.where(~F.col("state").isin("complete", "failed") & F.coalesce(F.col("ahead") > gone, F.col("now") >= gone))
    none = F.lit(None).cast("long")
    return df.select("run_id", "event_id", "at_ms", "state", "attempt", due.alias("due_ms")).unionByName(stale.select("run_id", none.alias("event_id"), gone.alias("at_ms"), F.lit("stale").alias("state"), "attempt", none.alias("due_ms")))
