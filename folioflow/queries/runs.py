"""Queries on runs: lifecycle, failures, incidents, watchdog, summaries.  Events stand in for runs: a user is a run, its
events in time order are revisions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import calendar as c
from ..operators import lifecycle as life
from ..streaming import tables as streams
from .registry import query, read

_STATUS = "CASE event_type WHEN 'signup' THEN 'created' WHEN 'view' THEN 'running' WHEN 'click' THEN 'recovering' WHEN 'purchase' THEN 'success' ELSE 'failed' END"
_RUNS = f"SELECT user_id, event_id, ts, {_STATUS} AS status, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS revision FROM events"
_ALLOWED = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b" for a, then in life.TRANSITIONS.items() for b in then)


def runs(spark, d):
    e = read(spark, d, "events")
    t = F.col("event_type")
    status = F.when(t == "signup", "created").when(t == "view", "running").when(t == "click", "recovering").when(t == "purchase", "success").otherwise("failed")
    return e.select("user_id", "event_id", "ts", status.alias("status"), "value", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")).alias("revision"))


@query(f"""
WITH r AS (SELECT *, lag(status) OVER (PARTITION BY user_id ORDER BY revision) AS before FROM ({_RUNS}))
SELECT user_id, revision, before, status, 'status' AS problem FROM r WHERE before IS NOT NULL AND (before, status) NOT IN (SELECT (a, b) FROM ({_ALLOWED}))""")
def forbidden_transitions(spark, d):
    """Revisions that the transition table forbids."""
    return life.transition_violations(runs(spark, d), "user_id", "revision", "status")


@query(f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY revision DESC) AS k, sum(CASE WHEN status = 'failed' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY revision DESC) AS stopped FROM ({_RUNS}))
SELECT user_id, least(count(*) FILTER (stopped = 0), 4) AS failures FROM r WHERE k <= 100 GROUP BY user_id""")
def trailing_failures(spark, d):
    """failures at the end of a history."""
    r = runs(spark, d).withColumn("conclusion", F.when(F.col("status") == "failed", "failure").otherwise("success"))
    return life.trailing_failures(r, "user_id", "revision", "conclusion", threshold=5)


_FOLD = f"""
WITH r AS ({_RUNS}), g AS (SELECT user_id, max(revision) FILTER (status = 'success') AS good, arg_max(status, revision) AS last, max(revision) FILTER (status = 'success' AND event_id % 2 = 0) AS last_write FROM r GROUP BY user_id)
SELECT g.user_id, (SELECT count(*) FROM r WHERE r.user_id = g.user_id AND (g.good IS NULL OR r.revision > g.good)) AS failures,
  CASE WHEN last = 'success' THEN 'operational' WHEN last = 'blocked' THEN 'blocked' ELSE 'degraded' END AS state, last_write FROM g"""


@query(_FOLD)
def folded_status(spark, d):
    """Failures since the last good run, and the last write."""
    return life.fold_status(runs(spark, d).withColumn("changed", F.col("event_id") % 2 == 0), "user_id", "revision", "status", "changed")


@query(f"""
WITH f AS ({_FOLD}), i AS (SELECT *, CASE user_id % 3 WHEN 0 THEN 'open' WHEN 1 THEN 'closed' END AS issue FROM f)
SELECT user_id, CASE WHEN failures >= 2 AND issue IS NULL THEN 'create' WHEN failures >= 2 AND issue = 'open' THEN 'update' WHEN failures >= 2 THEN 'reopen' WHEN issue = 'open' AND state = 'operational' AND failures = 0 THEN 'heal' ELSE 'noop' END AS action FROM i""")
def incident_actions(spark, d):
    """What to do about an incident issue."""
    f = life.fold_status(runs(spark, d).withColumn("changed", F.col("event_id") % 2 == 0), "user_id", "revision", "status", "changed")
    issue = F.when(F.col("user_id") % 3 == 0, "open").when(F.col("user_id") % 3 == 1, "closed")
    return f.select("user_id", life.incident_action(F.col("failures"), 2, issue, F.col("state")).alias("action"))


@query(f"""
SELECT event_id, CASE WHEN job IN ('failure', 'cancelled') THEN 'failed' ELSE status END AS decided, CASE WHEN status = 'blocked' THEN 90 WHEN job IN ('failure', 'cancelled') THEN 30 WHEN status IN ('success', 'no_op', 'recovered') THEN 14 ELSE 30 END AS days
FROM (SELECT *, CASE event_id % 5 WHEN 0 THEN 'failure' WHEN 1 THEN 'cancelled' ELSE 'success' END AS job FROM ({_RUNS}))""")
def run_retention(spark, d):
    """Decided status and days to keep."""
    r = runs(spark, d).withColumn("job", F.when(F.col("event_id") % 5 == 0, "failure").when(F.col("event_id") % 5 == 1, "cancelled").otherwise("success"))
    return r.select("event_id", life.decided_status(F.col("status"), F.col("job")).alias("decided"), life.retention_days(F.col("status"), F.col("job")).alias("days"))


@query("""
WITH s AS (SELECT user_id, max(ts) FILTER (event_type = 'purchase') AS last_reset, max(ts) FILTER (event_type = 'error') AS last_bark FROM events GROUP BY user_id)
SELECT user_id, epoch(CASE WHEN last_bark >= last_reset THEN last_bark ELSE last_reset END) // 1 + 7 * 86400 AS deadline,
  epoch(CASE WHEN last_bark >= last_reset THEN last_bark ELSE last_reset END) // 1 + 7 * 86400 <= epoch(TIMESTAMP '2024-02-03 00:00:00') AS due FROM s""".replace("epoch(CASE", "CAST(floor(epoch(CASE").replace("END) // 1 + 7", "END)) AS BIGINT) + 7"))
def watchdog_deadlines(spark, d):
    """Anchors, deadlines and alarms."""
    e = read(spark, d, "events").withColumn("at", F.col("ts").cast("timestamp"))
    s = e.groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "purchase", F.col("at"))).alias("last_reset"), F.max(F.when(F.col("event_type") == "error", F.col("at"))).alias("last_bark"))
    return life.watchdog(s, F.lit("2024-02-03").cast("timestamp"), 7).select("user_id", F.unix_timestamp("deadline").alias("deadline"), "due")


@query("""
WITH k AS (SELECT event_type AS clock, max(ts) FILTER (event_type <> 'signup') AS seen FROM events GROUP BY event_type)
SELECT clock, CASE WHEN seen IS NULL THEN clock || '_missing' WHEN epoch(seen) < epoch(TIMESTAMP '2024-02-06') - 7 * 86400 THEN clock || '_stale' END AS cause FROM k""")
def clock_causes(spark, d):
    """missing and stale clocks."""
    e = read(spark, d, "events").groupBy(F.col("event_type").alias("clock")).agg(F.max(F.when(F.col("event_type") != "signup", F.col("ts").cast("timestamp"))).alias("at"))
    return life.clock_causes(e, F.lit("2024-02-06").cast("timestamp"), 7)


@query("""
WITH c AS (SELECT user_id, max(ts) FILTER (event_type = 'view') AS v, max(ts) FILTER (event_type = 'click') AS c FROM events GROUP BY user_id),
w AS (SELECT user_id, CASE WHEN v IS NULL THEN 'view_missing' WHEN epoch(v) < epoch(TIMESTAMP '2024-02-06') - 7 * 86400 THEN 'view_stale' END AS a, CASE WHEN c IS NULL THEN 'click_missing' WHEN epoch(c) < epoch(TIMESTAMP '2024-02-06') - 7 * 86400 THEN 'click_stale' END AS b FROM c)
SELECT user_id, coalesce(concat_ws(',', a, b), '') || CASE WHEN a IS NULL AND b IS NULL THEN 'scheduled_keepalive' ELSE '' END AS causes FROM w""")
def watchdog_causes(spark, d):
    """What wakes the watchdog of each user: missing and stale clocks, or a keep-alive."""
    seen = lambda kind: F.max(F.when(F.col("event_type") == kind, F.col("ts").cast("timestamp"))).alias(kind)
    e = read(spark, d, "events").groupBy("user_id").agg(seen("view"), seen("click"))
    causes = life.watchdog_causes({"view": F.col("view"), "click": F.col("click")}, F.lit("2024-02-06").cast("timestamp"), 7)
    return e.select("user_id", F.array_join(causes, ",").alias("causes"))


@query("""
SELECT user_id, count(*) FILTER (event_type = 'purchase') AS downloaded, count(*) FILTER (event_type = 'view') AS existing, count(*) FILTER (event_type = 'error') AS errors, bool_or(value > 400) AS large,
  CASE WHEN user_id % 10 = 0 THEN 'blocked' WHEN count(*) FILTER (event_type = 'error') > 0 AND count(*) FILTER (event_type <> 'error') > 0 THEN 'partial' WHEN count(*) FILTER (event_type = 'error') > 0 THEN 'failed' ELSE 'success' END AS outcome
FROM events GROUP BY user_id""")
def run_summary(spark, d):
    """Counts by state, flags, outcome."""
    t = F.col("event_type")
    s = read(spark, d, "events").groupBy("user_id").agg(F.count_if(t == "purchase").alias("downloaded"), F.count_if(t == "view").alias("existing"), F.count_if(t == "error").alias("errors"), F.bool_or(F.col("value") > 400).alias("large"), F.count_if(t != "error").alias("good"))
    return s.withColumn("outcome", life.outcome(F.col("user_id") % 10 == 0, F.col("errors"), F.col("good"))).drop("good")


@query("""
SELECT user_id, round(greatest(0, epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS duration_seconds FROM events GROUP BY user_id""")
def run_durations(spark, d):
    """Rounded durations."""
    return read(spark, d, "events").groupBy("user_id").agg(c.duration_seconds(F.min("ts"), F.max("ts")).alias("duration_seconds"))


@query("""
SELECT user_id, arg_min(status, revision) AS first_status, arg_max(status, revision) AS status, max(revision) AS revision, count(*) FILTER (status = 'failed') AS failed FROM (%s) GROUP BY user_id""" % _RUNS)
def run_state(spark, d):
    """The folded state of each run."""
    r = runs(spark, d)
    return r.groupBy("user_id").agg(F.min_by("status", "revision").alias("first_status"), F.max_by("status", "revision").alias("status"), F.max("revision").alias("revision"), F.count_if(F.col("status") == "failed").alias("failed"))


@query("""
SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def daily_windows(spark, d):
    """§0.1: tumbling event-time windows, the batch form of the streaming query."""
    return streams.tumbling(read(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "1 day").select(F.col("day").cast("timestamp_ntz").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))
