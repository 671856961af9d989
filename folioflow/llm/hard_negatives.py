"""Hard negatives: distributed radix selection of the k best scores in every window of an anchor and a positive.

Components become ``floor(scale * x)``, a score is a whole inner product with the anchor.  The anchors are taken a block at a time
(``BLOCK_BYTES`` of vectors, broadcast: a fixed bound), each block against all rows of the table.  For a set of windows, each
an interval of scores of one anchor's rows of the same or of another label, the kth best score is found digit by digit: a pass
counts the scores of a window by ``RADIX`` equal parts of what is left of its interval, the counts of all tasks are summed, and the part
that holds the kth score is the interval of the next pass, until it is one score wide.  A task passes on counts from the top
only down to the part in which its own rows reach k, because lower parts cannot hold the kth score of all rows; so the
sums get at most k rows for each window and task.  A last pass gathers the rows above that score and, of those with just
that score, the smallest ids that are needed; each task keeps no more than k rows for each window, so a group of many
equal vectors is never gathered.  First the positives of each anchor are selected so, then the negatives of each pair.

A block's state (windows, their intervals, at most k rows for each) is bounded by the block.  The work is anchors times rows by the
contract; blocks only order it.  Products of components are summed in double precision while the largest norms prove all sums
below 2**53, else in 64-bit integers; norms that leave 62 bits raise an error.

Defined results: rows without vec_id, label or vector, or with a null, NaN or infinite component, take no part; a shorter
vector counts as if zeros followed, an empty one as zero; repeated rows each count, as candidates and as anchors, and an anchor is no positive of
itself, but a repeated row of it is; an anchor without positives, a pair without negatives and an empty table give no rows; other
columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import Workspace, table
from .centroids import finite

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these hundredths of its positive's score.
LOW, HIGH = 50, 95
RADIX = 512
BLOCK_BYTES = 1 << 20
#: Scores that are in memory together.
CHUNK_SCORES = 1 << 20


@dataclass(frozen=True)
class Block:
    """The anchors of a block, in a fixed order."""

    ids: np.ndarray
    labels: np.ndarray
    numbers: np.ndarray
    exact_doubles: bool


@dataclass
class Windows:
    """Intervals of scores: of anchor ``owner``, from ``low`` to ``high``, of rows of its own label (``same``) or of others."""

    owner: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool


def taking_part(frame: DataFrame) -> DataFrame:
    """vec_id, label and vector (doubles) of the rows that take part; where vec_id is divisible by 7 the label is the next of ten."""
    kept = frame.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite(F.col("embedding")), F.lit(False)))
    label = F.col("label").cast("long")
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), F.col("embedding").cast("array<double>").alias("vector"))


def _numbers(vectors: pd.Series, width: int, scale: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    lengths = np.fromiter((len(v) for v in vectors), dtype=np.int64, count=len(vectors))
    flat = np.concatenate([np.asarray(v, dtype=np.float64) for v in vectors]) if len(vectors) else np.zeros(0)
    out[np.arange(width) < lengths[:, None]] = np.floor(flat * float(scale)).astype(np.int64)
    return out


def _scores(batches: Iterator[pd.DataFrame], block: Block, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks of rows: ids, whether the labels are those of the anchors, and the scores (a row for each row, a column for each anchor)."""
    width, step = block.numbers.shape[1], max(1, CHUNK_SCORES // len(block.ids))
    anchors = block.numbers.T.astype(np.float64) if block.exact_doubles else block.numbers.T
    for batch in batches:
        for begin in range(0, len(batch), step):
            part = batch.iloc[begin : begin + step]
            numbers = _numbers(part["vector"], width, scale)
            scores = (numbers.astype(np.float64) @ anchors).astype(np.int64) if block.exact_doubles else numbers @ anchors
            yield part["vec_id"].to_numpy(dtype=np.int64), part["label"].to_numpy(dtype=np.int64)[:, None] == block.labels[None, :], scores


def _spans(windows: Windows, anchors: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """For each anchor the span of its windows, and its first, second, ... window (-1: none)."""
    first, last = np.full(anchors, np.iinfo(np.int64).max), np.full(anchors, np.iinfo(np.int64).min)
    np.minimum.at(first, windows.owner, windows.low)
    np.maximum.at(last, windows.owner, windows.high)
    per_owner: list[np.ndarray] = []
    seen = np.zeros(anchors, dtype=np.int64)
    for w, owner in enumerate(windows.owner):
        if seen[owner] == len(per_owner):
            per_owner.append(np.full(anchors, -1))
        per_owner[seen[owner]][owner] = w
        seen[owner] += 1
    return first, last, per_owner


def _hits(scores: np.ndarray, alike: np.ndarray, windows: Windows, first: np.ndarray, last: np.ndarray, per_owner: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, window, score) of the scores inside windows; every score is asked once against the span of all windows of its anchor."""
    rows, owners = np.nonzero((alike == windows.same) & (scores >= first) & (scores <= last))
    found = scores[rows, owners]
    for of in per_owner:
        window = of[owners]
        good = (window >= 0) & (found >= windows.low[window]) & (found <= windows.high[window])
        yield rows[good], window[good], found[good]


def _top_counts(counts: np.ndarray, need: np.ndarray) -> pd.DataFrame:
    """The counts of each window from the top down to the part in which this task's rows reach what is needed."""
    before = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
    window, digit = np.nonzero((counts > 0) & (before < need[:, None]))
    return pd.DataFrame({"window": window.astype(np.int32), "digit": digit.astype(np.int32), "n": counts[window, digit], "need": need[window]})


def kth_scores(rows: DataFrame, block: Block, windows: Windows, k: int, radix: int = RADIX, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """The kth best score in each window; a window of fewer than k rows keeps the lower end of its interval.  A pass for each digit."""
    low, high = windows.low.copy(), windows.high.copy()
    need = np.full(len(low), k, dtype=np.int64)
    asked = np.nonzero(low <= high)[0]
    while len(asked):
        part = Windows(windows.owner[asked], low[asked], high[asked], windows.same)
        shared = rows.sparkSession.sparkContext.broadcast((block, part, need[asked], -(-(part.high - part.low + 1) // radix)))

        def count(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            block, part, need, width = shared.value
            spans = _spans(part, len(block.ids))
            counts = np.zeros(len(part.owner) * radix, dtype=np.int64)
            for _, alike, scores in _scores(batches, block, scale):
                for _, window, score in _hits(scores, alike, part, *spans):
                    places, n = np.unique(window * radix + (score - part.low[window]) // width[window], return_counts=True)
                    counts[places] += n
            yield _top_counts(counts.reshape(-1, radix), need)

        counted = rows.mapInPandas(count, "window int, digit int, n long, need long").groupBy("window", "digit").agg(F.sum("n").alias("n"), F.max("need").alias("need"))
        upto = F.sum("n").over(Window.partitionBy("window").orderBy(F.desc("digit")))
        found = counted.withColumn("upto", upto).where("upto >= need AND upto - n < need").collect()  # a row for each window of the block
        shared.unpersist()
        width, reached = shared.value[3], []
        for r in found:
            w, at = asked[r["window"]], r["window"]
            need[w] -= r["upto"] - r["n"]
            low[w] += r["digit"] * width[at]
            high[w] = min(high[w], low[w] + width[at] - 1)
            if high[w] > low[w]:
                reached.append(w)
        asked = np.array(sorted(reached), dtype=np.int64)
    return low


def best_rows(rows: DataFrame, block: Block, windows: Windows, k: int, radix: int = RADIX, scale: int = SCALE) -> DataFrame:
    """window, rank (from 1), id and score of the k best rows of each window: higher scores first, then smaller ids."""
    low = kth_scores(rows, block, windows, k, radix, scale)
    shared = rows.sparkSession.sparkContext.broadcast((block, Windows(windows.owner, low, windows.high, windows.same)))

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, part = shared.value
        spans = _spans(part, len(block.ids))
        held, waiting = _best([], k), []
        for ids, alike, scores in _scores(batches, block, scale):
            waiting += [pd.DataFrame({"window": window, "id": ids[row], "score": score}) for row, window, score in _hits(scores, alike, part, *spans)]
            if sum(map(len, waiting)) > CHUNK_SCORES:
                held, waiting = _best([held, *waiting], k), []
        yield _best([held, *waiting], k)

    order = Window.partitionBy("window").orderBy(F.desc("score"), "id")
    gathered = rows.mapInPandas(gather, "window int, id long, score long")
    return gathered.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _best(parts: list[pd.DataFrame], k: int) -> pd.DataFrame:
    """The k best rows of each window."""
    if not parts:
        return pd.DataFrame({c: np.zeros(0, dtype=np.int64) for c in ("window", "id", "score")}).astype({"window": np.int32})
    rows = pd.concat(parts).sort_values(["window", "score", "id"], ascending=[True, False, True], kind="stable")
    return rows[rows.groupby("window").cumcount() < k].astype({"window": np.int32})


@dataclass(frozen=True)
class Reach:
    """What bounds the scores: the longest vector, the largest score of an anchor and a row, and the number of anchors."""

    width: int
    score: int
    anchors: int


def reach(rows: DataFrame, anchors: DataFrame, scale: int) -> Reach:
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + F.pow(F.floor(x * scale).cast("double"), 2.0))
    all_rows = rows.agg(F.max(F.size("vector")).alias("width"), F.max(norm).alias("norm")).first()
    asking = anchors.agg(F.max(norm).alias("norm"), F.count("*").alias("n")).first()
    score = math.ceil(math.sqrt((all_rows["norm"] or 0.0) * (asking["norm"] or 0.0)) * (1 + 1e-9)) + 1
    if score >= 1 << 55:
        raise ValueError("inner products of such vectors leave 64 bits")
    return Reach(all_rows["width"] or 0, score, asking["n"])


def mine(frame: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, block_bytes: int = BLOCK_BYTES, radix: int = RADIX) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for every anchor (vec_id divisible by ``every``) and positive."""
    spark = frame.sparkSession
    rows = taking_part(frame)
    anchors = rows.where(F.col("vec_id") % every == 0)
    bound = reach(rows, anchors, scale)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not bound.anchors:
        return spark.createDataFrame([], schema)
    work = Workspace(spark, "negatives")
    blocks = -(-bound.anchors * 8 * max(bound.width, 1) // block_bytes)
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    work.save(anchors.withColumn("block", dealt), "anchors", partition_by=["block"])
    for b in range(blocks):
        asked = work.load("anchors").where(F.col("block") == b).drop("block").collect()  # about block_bytes
        if asked:
            work.save(_mine_block(rows, asked, bound, positives, negatives, (low, high), scale, radix), f"found/part={b}")
    return work.load("found").drop("part")


def _mine_block(rows: DataFrame, asked: list, bound: Reach, positives: int, negatives: int, share: tuple[int, int], scale: int, radix: int) -> DataFrame:
    ids, labels = (np.array([r[c] for r in asked], dtype=np.int64) for c in ("vec_id", "label"))
    numbers = _numbers(pd.Series([np.array(r["vector"]) for r in asked]), bound.width, scale)
    block = Block(ids, labels, numbers, bound.score < 1 << 53)
    owner, ends = np.arange(len(ids)), np.full(len(ids), bound.score, dtype=np.int64)
    alike: dict[int, list] = {}
    for r in best_rows(rows, block, Windows(owner, -ends, ends, True), positives + 1, radix, scale).collect():  # at most positives + 1 for each anchor
        alike.setdefault(r["window"], []).append((r["rank"], r["id"], r["score"]))
    own = (numbers * numbers).sum(axis=1)
    pairs = []
    for a, best in sorted(alike.items()):
        best.sort()
        itself = next((x for x in best if x[1:] == (ids[a], own[a])), None)
        pairs += [(a, i, s) for r, i, s in best if itself is None or r != itself[0]][:positives]
    low, high = (np.array([f(s) for _, _, s in pairs], dtype=np.int64) for f in (lambda s: -(-share[0] * s // 100), lambda s: share[1] * s // 100))
    chosen = best_rows(rows, block, Windows(np.array([a for a, _, _ in pairs], dtype=np.int64), low, high, False), negatives, radix, scale)
    named = rows.sparkSession.createDataFrame([(w, int(ids[a]), i, s) for w, (a, i, s) in enumerate(pairs)], "window int, anchor_id long, positive_id long, positive_score long")
    out = chosen.join(F.broadcast(named), "window")  # a row for each window of the block
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"))


OP12_SQL = f"""
    WITH kept AS (
        SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})) AS v
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS alike, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
        FROM kept a JOIN kept r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id
    ),
    positive AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
    )
    SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank", vec_id AS negative_id, positive_score, score AS negative_score
    FROM positive JOIN scored USING (anchor_id) WHERE NOT alike AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
    QUALIFY "rank" <= {NEGATIVES}"""
