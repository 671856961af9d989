"""Run lifecycle, trailing failures, status folds, incident and watchdog decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Which status may follow which, and what a conclusion counts as.
TRANSITIONS = {
    "created": ("created", "running", "blocked", "failed"),
    "running": ("running", "success", "no_op", "blocked", "failed", "recovering"),
    "success": ("success",),
    "no_op": ("no_op",),
    "blocked": ("blocked", "recovering", "failed"),
    "failed": ("failed", "recovering"),
    "recovering": ("recovering", "recovered", "blocked", "failed"),
    "recovered": ("recovered", "running", "success", "no_op", "blocked", "failed"),
}
FAILING = ("action_required", "cancelled", "failure", "stale", "startup_failure", "timed_out")
GOOD = ("success", "no_op", "recovered")


def transition_violations(events: DataFrame, run: str, revision: str, status: str) -> DataFrame:
    """Revisions that do not follow the one before them: a gap in numbers or a forbidden change of status."""
    w = Window.partitionBy(run).orderBy(revision)
    rows = events.withColumns({"before": F.lag(status).over(w), "gap": F.col(revision) - F.lag(revision).over(w)}).where("before IS NOT NULL")
    ok = F.lit(False)
    for a, then in TRANSITIONS.items():
        ok = ok | ((F.col("before") == a) & F.col(status).isin(*then))
    return rows.withColumn("problem", F.when(F.col("gap") != 1, "revision").when(~ok, "status")).where("problem IS NOT NULL").select(run, revision, "before", status, "problem")


def trailing_failures(history: DataFrame, group: str, number: str, conclusion: str, threshold: int = 2, depth: int = 100) -> DataFrame:
    """Failures at the end of each group's history, up to the first run that did not fail, at most threshold - 1."""
    latest = Window.partitionBy(group).orderBy(F.col(number).desc())
    recent = history.withColumn("k", F.row_number().over(latest)).where(F.col("k") <= depth)
    stopped = F.sum(F.when(F.col(conclusion).isin(*FAILING), 0).otherwise(1)).over(latest)
    return recent.withColumn("stopped", stopped).groupBy(group).agg(F.least(F.count_if(F.col("stopped") == 0), F.lit(threshold - 1)).alias("failures"))


def fold_status(runs: DataFrame, group: str, order: str, status: str, changed: str) -> DataFrame:
    """Public status after each group's runs: failures since the last good run, and the last write.

    The last good run and the counts after it are one aggregation; runs are not walked one by one."""
    good = F.col(status).isin(*GOOD)
    marks = runs.groupBy(group).agg(F.max(F.when(good, F.col(order))).alias("last_good"), F.max(F.struct(order, status)).alias("last"), F.max(F.when(F.col(changed) & F.col(status).isin("success", "recovered"), F.col(order))).alias("last_write"))
    after = runs.join(marks, group).where(F.col("last_good").isNull() | (F.col(order) > F.col("last_good"))).groupBy(group).agg(F.count("*").alias("failures"))
    state = F.when(F.col(f"last.{status}").isin(*GOOD), "operational").when(F.col(f"last.{status}") == "blocked", "blocked").otherwise("degraded")
    return marks.join(after, group, "left").select(group, F.coalesce("failures", F.lit(0)).alias("failures"), state.alias("state"), "last_write")


def incident_action(failures: Column, threshold: int, issue: Column, state: Column) -> Column:
    """create, update, reopen, heal or noop; issue is null (none), open or closed."""
    return (
        F.when((failures >= threshold) & issue.isNull(), "create").when((failures >= threshold) & (issue == "open"), "update").when(failures >= threshold, "reopen")
        .when((issue == "open") & (state == "operational") & (failures == 0), "heal").otherwise("noop")
    )


def decided_status(manifest: Column, job: Column) -> Column:
    """A failed or cancelled job overrides what the manifest says."""
    return F.when(job.isin("failure", "cancelled"), "failed").otherwise(manifest)


def retention_days(status: Column, job: Column) -> Column:
    return F.when(status == "blocked", 90).when(job.isin("failure", "cancelled"), 30).when(status.isin(*GOOD), 14).otherwise(30)


def clock_causes(clocks: DataFrame, now: Column, days: int) -> DataFrame:
    """For each clock: missing, stale (older than the interval), or nothing."""
    cause = F.when(F.col("at").isNull(), F.concat("clock", F.lit("_missing"))).when(F.unix_timestamp("at") < F.unix_timestamp(now) - days * 86400, F.concat("clock", F.lit("_stale")))
    return clocks.select("clock", cause.alias("cause"))


def watchdog_causes(clocks: dict[str, Column], now: Column, days: int) -> Column:
    """Array of what wakes the watchdog, clocks in the order given: missing or stale ones, else a keep-alive."""
    old = lambda at: F.unix_timestamp(at) < F.unix_timestamp(now) - days * 86400
    causes = F.array_compact(F.array(*[F.when(at.isNull(), f"{name}_missing").when(old(at), f"{name}_stale") for name, at in clocks.items()]))
    return F.when(F.size(causes) > 0, causes).otherwise(F.array(F.lit("scheduled_keepalive")))


def watchdog(status: DataFrame, now: Column, days: int) -> DataFrame:
    """Deadline and alarm of each watched subject: the anchor is the last bark if it is not before the last reset."""
    anchor = F.when(F.col("last_bark") >= F.col("last_reset"), F.col("last_bark")).otherwise(F.col("last_reset"))
    due = status.withColumn("deadline", F.timestamp_seconds(F.unix_timestamp(anchor) + days * 86400))
    return due.withColumn("due", F.unix_timestamp("deadline") <= F.unix_timestamp(now))


def outcome(blocked: Column, issues: Column, good_records: Column) -> Column:
    return F.when(blocked, "blocked").when((issues > 0) & (good_records > 0), "partial").when(issues > 0, "failed").otherwise("success")


def transition_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a, b) for a, then in TRANSITIONS.items() for b in then], "before string, after string")
