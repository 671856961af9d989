"""Structured Streaming forms: windowed counts with late data, run state, rebuilding of late periods."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import calendar as c
from ..operators.lifecycle import TRANSITIONS

RUN_OUT = "run string, revision long, status string, accepted long, rejected long"
RUN_STATE = "revision long, status string, accepted long, rejected long"


def tumbling(events: DataFrame, width: str, delay: str | None = None) -> DataFrame:
    """Counts and sums by window and type.  With a delay the events carry a watermark: state is dropped once windows close."""
    rows = events.withWatermark("ts", delay) if delay else events
    return rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("day"), "event_type", "n", "total")


def _advance(key: tuple, batches, state: GroupState):
    """Folds new revisions of one run: what the transition table forbids, or a revision that does not follow, is rejected."""
    revision, status, accepted, rejected = state.get if state.exists else (0, None, 0, 0)
    rows = sorted((int(r.revision), r.status) for b in batches for r in b.itertuples())
    for number, then in rows:
        ok = number == 1 if status is None else number == revision + 1 and then in TRANSITIONS[status]
        if ok:
            revision, status, accepted = number, then, accepted + 1
        else:
            rejected += 1
    state.update((revision, status or "", accepted, rejected)) if status else state.update((0, "created", 0, rejected))
    yield pd.DataFrame([{"run": key[0], "revision": revision, "status": status, "accepted": accepted, "rejected": rejected}])


def run_states(updates: DataFrame) -> DataFrame:
    """The current state of each run after each batch of (run, revision, status)."""
    return updates.groupBy("run").applyInPandasWithState(_advance, RUN_OUT, RUN_STATE, "update", GroupStateTimeout.NoTimeout)


def rebuild_late(records: DataFrame, day: str, rebuild: Callable[[SparkSession, list[tuple[str, str]]], None], checkpoint: str) -> StreamingQuery:
    """For each batch of late records calls ``rebuild`` with the distinct (kind, value) of their periods.

    A batch touches a bounded number of periods (weeks, months and years of its records), which is all that the driver
    sees; ``rebuild`` overwrites those partitions, so a repeated batch does no harm."""

    def apply(batch: DataFrame, _: int) -> None:
        touched = batch.select(F.explode(c.periods_of(F.col(day))).alias("p")).select("p.kind", "p.value").distinct().collect()
        if touched:
            rebuild(batch.sparkSession, sorted((r["kind"], r["value"]) for r in touched))

    return records.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
