"""Job logs: events by time, sessions, retries, intervals, and their streaming twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ranking
from ..streaming import supervisor, windows
from .registry import query, statement, table

_SEC = "[[CAST(unix_timestamp(CAST(ts AS TIMESTAMP)) AS BIGINT)||CAST(floor(epoch(ts)) AS BIGINT)]]"

statement("retry_backoff", f"""WITH f AS (SELECT event_id, user_id, {_SEC} AS seen_at, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS attempt FROM {{events}} WHERE event_type = 'error'),
d AS (SELECT *, CAST(least(5 * power(2, least(attempt - 1, 20)), 300) AS BIGINT) AS delay, min(seen_at) OVER (PARTITION BY user_id) AS started FROM f)
SELECT event_id, user_id, CAST(attempt AS BIGINT) AS attempt, delay, CAST(sum(delay) OVER (PARTITION BY user_id ORDER BY attempt ROWS UNBOUNDED PRECEDING) AS BIGINT) AS waited, seen_at - started > 86400 AS past_deadline FROM d""")

statement("job_sessions", f"""WITH g AS (SELECT user_id, event_id, {_SEC} AS seen_at, ts FROM {{events}}), l AS (SELECT *, lag(seen_at) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM g),
s AS (SELECT *, sum(CASE WHEN before IS NULL OR seen_at - before >= 1800 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM l)
SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n, min(seen_at) AS first_at, max(seen_at) AS last_at FROM s GROUP BY user_id, session""")

statement("events_tumbling", f"SELECT CAST(floor({_SEC} / 86400) AS BIGINT) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM {{events}} GROUP BY 1, 2")
statement("events_json", "SELECT CAST([[get_json_object(props, '$.k')||json_extract_string(props, '$.k')]] AS BIGINT) AS k, count(*) AS n, round(avg(value), 6) AS mean FROM {events} GROUP BY 1")
statement("json_path_checks", "SELECT event_id, CAST([[get_json_object(props, '$.k')||json_extract_string(props, '$.k')]] AS BIGINT) = 1 AS equal_one, [[get_json_object(props, '$.none')||json_extract_string(props, '$.none')]] IS NULL AS absent FROM {events}")
statement("stale_runs", f"""WITH l AS (SELECT user_id, max({_SEC}) AS heartbeat, [[max_by(event_type, struct(ts, event_id))||arg_max(event_type, (ts, event_id))]] AS state FROM {{events}} GROUP BY 1), n AS (SELECT max(heartbeat) AS now FROM l)
SELECT user_id, state, now - heartbeat AS age, now - heartbeat > 600 AND state <> 'purchase' AS stale FROM l CROSS JOIN n""")
statement("latest_matching_report", """SELECT user_id, event_id AS report_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM {events} e WHERE event_type = 'purchase' AND EXISTS (SELECT 1 FROM {events} s WHERE s.user_id = e.user_id AND s.event_type = 'signup')) WHERE n = 1""")


@query("""WITH p AS (SELECT event_id, CAST(floor(event_id / 100) AS BIGINT) AS page, event_type FROM events),
d AS (SELECT page, count(*) AS n, sha256(array_to_string(list(event_type ORDER BY event_id), ',')) AS digest FROM p GROUP BY page)
SELECT page, n, coalesce(digest = lag(digest) OVER (ORDER BY page), FALSE) AS repeated, coalesce(n = lag(n) OVER (ORDER BY page), TRUE) AS stable FROM d""")
def page_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a hundred events that repeat the page before them, or differ from it in length."""
    own = table(spark, sf_dir, "events").select("event_id", F.floor(F.col("event_id") / 100).cast("long").alias("page"), "event_type")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("event_id", "event_type"))), lambda x: x["event_type"])
    pages = own.groupBy("page").agg(F.count("*").alias("n"), F.sha2(F.array_join(listed, ","), 256).alias("digest"))
    place = ranking.numbered(pages, [F.asc("page")])
    last = place.select((F.col("position") + 1).alias("position"), F.col("n").alias("n0"), F.col("digest").alias("digest0"))
    same = lambda a, b, none: F.coalesce(F.col(a) == F.col(b), F.lit(none))
    return place.join(last, "position", "left").select("page", "n", same("digest", "digest0", False).alias("repeated"), same("n", "n0", True).alias("stable"))


_MERGED = f"""iv AS (SELECT user_id, {_SEC} AS a, {_SEC} + CAST(floor(abs(value)) AS BIGINT) % 7200 AS b FROM {{events}}), p AS (SELECT * FROM iv WHERE b > a),
m AS (SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM p),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS island FROM m)"""
statement("interval_merge", f"WITH {_MERGED} SELECT user_id, min(a) AS start_at, max(b) AS end_at, count(*) AS parts FROM g GROUP BY user_id, island")
statement("interval_gaps", f"WITH {_MERGED}, u AS (SELECT user_id, min(a) AS a, max(b) AS b FROM g GROUP BY user_id, island), n AS (SELECT user_id, b AS gap_from, lead(a) OVER (PARTITION BY user_id ORDER BY a) AS gap_to FROM u) SELECT user_id, count(*) AS gaps, CAST(sum(gap_to - gap_from) AS BIGINT) AS uncovered FROM n WHERE gap_to IS NOT NULL GROUP BY user_id")
statement("space_ledger", """WITH u AS (SELECT user_id % 5 AS device, event_type AS phase, CAST(sum(floor(value)) AS BIGINT) AS used FROM {events} GROUP BY 1, 2), p AS (SELECT device, max(used) AS peak, CAST(sum(greatest(0, used)) AS BIGINT) AS total FROM u GROUP BY device)
SELECT device, peak, total, peak + 1000 <= 200000 AS fits FROM p""")
statement("histograms", """SELECT 'event' AS kind, event_type AS value, count(*) AS n FROM {events} GROUP BY event_type UNION ALL SELECT 'scheme', [[substring_index(url, ':', 1)||split_part(url, ':', 1)]], count(*) FROM {pages} GROUP BY 2""")
statement("transfer_decisions", """SELECT event_id, CAST(event_id % 4 AS BIGINT) AS attempt, CASE event_id % 3 WHEN 0 THEN 'primary' WHEN 1 THEN 'mirror-1' ELSE 'mirror-2' END AS mirror,
CASE WHEN event_type = 'error' THEN 'restart' WHEN value > 50 AND event_id % 4 > 0 THEN 'resume' ELSE 'start' END AS action, CAST(least(power(2, event_id % 4), 30) AS BIGINT) AS delay FROM {events}""")
statement("map_ops", """SELECT user_id, count(DISTINCT event_type) AS kinds, [[array_join(array_sort(map_keys(map_from_entries(collect_set(struct(event_type, 1))))), ',')||array_to_string(list_sort(list_distinct(list(event_type))), ',')]] AS keys FROM {events} GROUP BY user_id""")


@query(f"SELECT CAST(floor(epoch(ts) / 86400) * 86400 AS BIGINT) AS day_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def streaming_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.daily_counts(spark, f"{sf_dir}/events.parquet")


_RUNS = """e AS (SELECT user_id AS run_id, event_id, CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS at_ms, CASE event_type WHEN 'error' THEN 'failure' WHEN 'purchase' THEN 'complete' WHEN 'signup' THEN 'submit' ELSE 'beat' END AS kind FROM events),
s AS (SELECT *, lag(kind) OVER w AS k0, lead(at_ms) OVER w AS ahead FROM e WINDOW w AS (PARTITION BY run_id ORDER BY at_ms, event_id)),
g AS (SELECT *, sum(CASE WHEN kind = 'submit' OR k0 = 'complete' THEN 1 ELSE 0 END) OVER (PARTITION BY run_id ORDER BY at_ms, event_id) AS seg FROM s),
c AS (SELECT *, count(CASE WHEN kind = 'failure' THEN 1 END) OVER h AS errors, min(CASE WHEN kind = 'failure' THEN at_ms END) OVER h AS since FROM g WINDOW h AS (PARTITION BY run_id, seg ORDER BY at_ms, event_id)),
d AS (SELECT *, CAST(least(5 * power(2, least(errors - 1, 20)), 300) AS BIGINT) * 1000 AS delay FROM c),
f AS (SELECT *, bool_or(kind = 'failure' AND (errors >= 6 OR at_ms - since + delay > 259200000)) OVER (PARTITION BY run_id, seg ORDER BY at_ms, event_id) AS failed FROM d),
r AS (SELECT *, CASE WHEN kind = 'complete' THEN 'complete' WHEN failed THEN 'failed' WHEN kind = 'failure' THEN 'retry_wait' ELSE 'running' END AS state, CASE WHEN kind = 'complete' THEN 0 ELSE errors END AS attempt FROM f),
n AS (SELECT max(at_ms) AS now FROM e)
SELECT run_id, event_id, at_ms, state, attempt, CASE WHEN state = 'retry_wait' THEN at_ms + delay END AS due_ms FROM r
UNION ALL SELECT run_id, NULL, at_ms + 21600000, 'stale', attempt, NULL FROM r, n WHERE state NOT IN ('complete', 'failed') AND coalesce(ahead > at_ms + 21600000, now >= at_ms + 21600000)"""


def _runs(events: DataFrame) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "failure").when(F.col("event_type") == "purchase", "complete").when(F.col("event_type") == "signup", "submit").otherwise("beat")
    return events.select(F.col("user_id").alias("run_id"), "event_id", "ts", kind.alias("kind"))


@query(f"WITH {_RUNS}")
def supervised_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supervisor.batch_transitions(_runs(table(spark, sf_dir, "events")))


@query(f"WITH {_RUNS}")
def streaming_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users are runs: errors are failures, purchases completions, signups submissions, all else is a heartbeat."""
    return supervisor.run_once(spark, _runs(windows.stream_of(spark, f"{sf_dir}/events.parquet")))
