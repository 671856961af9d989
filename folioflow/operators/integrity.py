"""Catalog integrity: keys, references, content aliases, version edges, orders, cycles.

Each check returns the violating rows, so an empty result is a pass and nothing is collected to decide.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys that only one side has, with the side."""
    a, b = left.select(*keys).distinct(), right.select(*keys).distinct()
    return a.join(b, keys, "left_anti").withColumn("side", F.lit("left")).unionByName(b.join(a, keys, "left_anti").withColumn("side", F.lit("right")))


def duplicate_keys(frame: DataFrame, keys: list[str]) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def conflicting(frame: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys with more than one distinct value: equal repetitions collapse, different ones conflict."""
    return frame.select(*keys, *values).distinct().groupBy(*keys).agg(F.count("*").alias("n_values")).where("n_values > 1")


def content_aliases(frame: DataFrame, content: Column, key: str) -> DataFrame:
    """Rows with ``canonical`` (smallest key of the same content) and ``same_content_as``: empty for the canonical row,
    else just the canonical key, so aliases form a star.

    The minimum is a partial aggregation and the join splits under adaptive skew handling; no content group is sorted."""
    hashed = frame.withColumn("content_hash", content)
    canon = hashed.groupBy("content_hash").agg(F.min(key).alias("canonical"))
    return hashed.join(canon, "content_hash").withColumn("same_content_as", F.when(F.col(key) == F.col("canonical"), F.array().cast("array<bigint>")).otherwise(F.array(F.col("canonical"))))


def reciprocal_violations(edges: DataFrame) -> DataFrame:
    """Rows (node, supersedes, superseded_by) whose edge the other end does not return, or whose end is missing."""
    other = edges.select(F.col("node").alias("other"), F.col("superseded_by").alias("back"))
    down = edges.where("supersedes IS NOT NULL").join(other, F.col("supersedes") == F.col("other"), "left")
    return down.where(~F.col("back").eqNullSafe(F.col("node"))).select("node", "supersedes", F.when(F.col("other").isNull(), "missing").otherwise("not_returned").alias("problem"))


def order_violations(frame: DataFrame, group: list[str], position: str, key: str) -> DataFrame:
    """Rows whose key is not above the one before it in their group: out of order or repeated."""
    before = F.lag(key).over(Window.partitionBy(*group).orderBy(position))
    return frame.withColumn("before", before).where(F.col("before") >= F.col(key)).select(*group, position, key, "before", F.when(F.col("before") == F.col(key), "repeated").otherwise("unsorted").alias("problem"))


def shared_folder(frame: DataFrame) -> str:
    """The session's shared checkpoint folder, set if it was not; only a local master without one gets a temporary folder."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    folder = context.getConf().get("spark.checkpoint.dir")
    if not folder and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="folioflow-"))
    return context.getCheckpointDir()


def kept(frame: DataFrame) -> DataFrame:
    """The frame, worked out once: a checkpoint in the shared folder."""
    shared_folder(frame)
    return frame.checkpoint()


def on_cycles(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Nodes of (node, next) with one way out each that lie on a cycle or lead into one.

    Pointer doubling: after k rounds a pointer has gone 2**k steps or has left the graph; what has not left after more
    steps than there are nodes never will.  Rounds are cut with checkpoints, so plans stay short; both sides of a join have all nodes,
    so they are shuffled and none is sent through the driver."""
    jump = edges.where("next IS NOT NULL").select("node", F.col("next").alias("at"))
    nodes = jump.count()
    step = 1
    for k in range(max_rounds):
        if step > nodes:
            break
        hop = jump.select(F.col("node").alias("at"), F.col("at").alias("then"))
        jump = jump.join(hop.hint("merge"), "at").select("node", F.col("then").alias("at"))
        step *= 2
        if k % 4 == 3:
            shared_folder(jump)
            jump = jump.checkpoint()
    return jump.select("node")


def missing_targets(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges (node, next) whose target is no node."""
    return edges.where("next IS NOT NULL").join(nodes.select(F.col("node").alias("next")), "next", "left_anti").select("node", "next")


def leading_into_cycles(edges: DataFrame) -> DataFrame:
    """Nodes of (node, next), with any number of ways out, that lie on a cycle or lead into one.

    Peeling: a round takes out all edges into nodes that have no way out left, until none goes.  Rounds are as many as the longest
    chain has steps (:func:`on_cycles` takes the logarithm, for nodes with one way out); only edges that are left take part, and every
    fourth round is cut with a checkpoint."""
    left = edges.where("next IS NOT NULL").select("node", "next").distinct()
    shared_folder(left)
    left = left.checkpoint()
    n, k = left.count(), 0
    while n:
        left = left.join(left.select(F.col("node").alias("next")).distinct(), "next", "left_semi").select("node", "next")
        k += 1
        if k % 4 == 0:
            left = left.checkpoint()
        n, before = left.count(), n
        if n == before:
            break
    return left.select("node").distinct()


def strict_lines(lines: DataFrame, canonical: Column, max_bytes: int = 1 << 20) -> DataFrame:
    """Problems of text lines (line_no, value): blank, too long, not JSON, or not in canonical form."""
    shown = lines.withColumn("canonical", canonical)
    problem = (
        F.when(F.trim("value") == "", "blank")
        .when(F.octet_length("value") > max_bytes, "too_long")
        .when(F.col("canonical").isNull(), "not_json")
        .when(F.col("canonical") != F.concat("value", F.lit("\n")), "not_canonical")
    )
    return shown.withColumn("problem", problem).where("problem IS NOT NULL").select("line_no", "problem")
