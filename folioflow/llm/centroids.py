"""Centroid clustering: plain Lloyd iterations over integer vectors.

A round broadcasts the centroids (``clusters`` times ``width`` integers, a fixed bound), and every task takes its rows a batch at a
time: NumPy forms the squared differences to one centroid after the other and the smallest distance wins, the
lower number on a tie.  A task passes on only the integer sums and the count of each cluster, at most ``clusters * width`` rows
whatever it has read; a grouped sum merges them.  So a round is one scan without a shuffle of vectors, a lost executor costs its
own tasks, and one cluster that holds most rows is no hot group.  All numbers are whole: results don't depend on the order of
rows or tasks.

Vectors are ``floor(scale * x)`` of each component.  Rows that are not exactly ``width`` long or hold a null, NaN or infinity take no part.

Defined results: an empty table, or one without a vector to keep, gives an empty result; fewer vectors than clusters start as many
clusters as there are vectors; repeated rows each count and each can start a cluster; a null id clusters like any other and starts a cluster only
if named ids run out; other columns are not looked at.  A component beyond ``LARGEST`` raises an error, because its squares leave 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Workspace, table

CLUSTERS = 16
ROUNDS = 3
WIDTH = 64
SCALE = 64
#: 64 squares of differences of such components stay below 2**63.
LARGEST = 1 << 27
#: Rows whose differences are in memory together.
CHUNK_ROWS = 4096


@dataclass(frozen=True)
class Clustering:
    """``members``: a row for each kept vector (id, cluster, distance); ``centroids``: the final ones."""

    members: DataFrame
    centroids: np.ndarray


def finite(vector: Column) -> Column:
    """Whether a vector has no null, NaN or infinite component; null for a null vector."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def whole_vectors(frame: DataFrame, vector: str, width: int = WIDTH) -> DataFrame:
    """The rows whose vectors take part, their components as doubles."""
    kept = (F.size(vector) == width) & finite(F.col(vector))
    return frame.where(F.coalesce(kept, F.lit(False))).withColumn(vector, F.col(vector).cast("array<double>"))


def _numbers(vectors: pd.Series, scale: int) -> np.ndarray:
    grown = np.floor(np.stack(vectors.to_numpy()) * float(scale))
    if np.abs(grown).max() > LARGEST:
        raise ValueError(f"a component beyond {LARGEST // scale} cannot be clustered in 64 bits")
    return grown.astype(np.int64)


def nearest(numbers: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the nearest centroid of each row, the lower one on a tie, and the squared distance."""
    best, where = None, np.zeros(len(numbers), dtype=np.int32)
    for k, centroid in enumerate(centroids):
        apart = numbers - centroid
        distance = np.einsum("ij,ij->i", apart, apart)
        if best is None:
            best = distance
        else:
            nearer = distance < best
            where[nearer] = k
            best = np.minimum(best, distance)
    return where, best


def _chunks(batches: Iterator[pd.DataFrame], vector: str, scale: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for batch in batches:
        for begin in range(0, len(batch), CHUNK_ROWS):
            part = batch.iloc[begin : begin + CHUNK_ROWS]
            yield part, _numbers(part[vector], scale)


def _sums(kept: DataFrame, vector: str, scale: int, centroids: np.ndarray) -> dict[int, tuple[list[int], int]]:
    """Component sums and count of each cluster that has a vector."""
    shared = kept.sparkSession.sparkContext.broadcast(centroids)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points = shared.value
        sums, counts = np.zeros(points.shape, dtype=np.int64), np.zeros(len(points), dtype=np.int64)
        for _, numbers in _chunks(batches, vector, scale):
            where, _ = nearest(numbers, points)
            for k in np.unique(where):
                rows = numbers[where == k]
                sums[k] += rows.sum(axis=0)
                counts[k] += len(rows)
        cluster, place = np.nonzero(np.broadcast_to(counts[:, None] > 0, sums.shape))
        yield pd.DataFrame({"cluster": cluster.astype(np.int32), "place": place.astype(np.int32), "total": sums[cluster, place], "n": counts[cluster]})

    rows = kept.select(vector).mapInPandas(partial, "cluster int, place int, total long, n long")
    merged = rows.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()
    shared.unpersist()
    out: dict[int, tuple[list[int], int]] = {}
    for r in merged:
        out.setdefault(r["cluster"], ([0] * centroids.shape[1], r["n"]))[0][r["place"]] = int(r["total"])
    return out


def first_centroids(kept: DataFrame, key: str, vector: str, clusters: int = CLUSTERS, scale: int = SCALE) -> np.ndarray:
    """The vectors of the smallest hashes of ``1:<key>``, in the order of the hashes; equal ids in the order of their components."""
    drawn = F.sha2(F.concat(F.lit("1:"), F.col(key).cast("string")), 256)
    rows = kept.select(drawn.alias("drawn"), F.col(vector).alias("numbers")).orderBy(F.asc_nulls_last("drawn"), "numbers").limit(clusters).collect()
    return _numbers(pd.Series([np.array(r["numbers"]) for r in rows]), scale) if rows else np.zeros((0, 0), dtype=np.int64)


def cluster_vectors(frame: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE) -> Clustering:
    """Lloyd's rounds over the vectors of ``frame``; the members are written to the shared folder once."""
    spark = frame.sparkSession
    kept = whole_vectors(frame.select(F.col(key).alias("key"), F.col(vector).alias("vector")), "vector", width)
    schema = frame.select(key).schema.add("cluster", "integer").add("distance", "long")
    centroids = first_centroids(kept, "key", "vector", clusters, scale)
    if not len(centroids):
        return Clustering(spark.createDataFrame([], schema), centroids)
    for _ in range(rounds):
        moved = centroids.copy()
        for k, (total, n) in _sums(kept, "vector", scale, centroids).items():
            moved[k] = [t // n for t in total]  # whole numbers: // is the floor
        centroids = moved
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, numbers in _chunks(batches, "vector", scale):
            where, distance = nearest(numbers, shared.value)
            yield pd.DataFrame({key: part["key"], "cluster": where, "distance": distance})

    return Clustering(Workspace(spark, "centroids").save(kept.mapInPandas(assign, schema), "members"), centroids)


def clustering_report(frame: DataFrame, key: str = "vec_id", vector: str = "embedding", **how) -> DataFrame:
    """key, cluster, distance, cluster_inertia, inertia and centroid_sha256 for every kept vector."""
    found = cluster_vectors(frame, key, vector, **how)
    spark = frame.sparkSession
    sums = {r["cluster"]: r["total"] for r in found.members.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # a row for each cluster
    digests = [sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in found.centroids]
    facts = [(k, total, sum(sums.values()), digests[k]) for k, total in sums.items()]
    named = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.members.join(F.broadcast(named), "cluster").select(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering_report(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The same rounds as DuckDB SQL: vectors as (id, place, number), every round a join with the centroids."""
    head = f"""
        WITH kept AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * {SCALE}) AS BIGINT)) AS v FROM embeddings
            WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        flat AS (SELECT vec_id, unnest(range({WIDTH})) AS j, unnest(v) AS x FROM kept),
        chosen AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS k FROM kept QUALIFY k < {CLUSTERS}),
        c0 AS (SELECT k, j, x FROM chosen JOIN flat USING (vec_id))"""
    near = """,
        a{r} AS (
            SELECT vec_id, k, d FROM (
                SELECT f.vec_id, c.k, CAST(sum((f.x - c.x) * (f.x - c.x)) AS BIGINT) AS d FROM flat f JOIN c{r} c USING (j) GROUP BY ALL
            ) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1
        )"""
    move = """,
        m{r} AS (SELECT k, j, sum(x)::BIGINT AS s, count(*) AS n FROM a{p} JOIN flat USING (vec_id) GROUP BY ALL),
        c{r} AS (SELECT k, j, CASE WHEN n IS NULL THEN x ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{p} LEFT JOIN m{r} USING (k, j))"""
    out = head
    for r in range(ROUNDS):
        out += near.format(r=r) + move.format(r=r + 1, p=r)
    out += near.format(r=ROUNDS)
    return out + f"""
        SELECT vec_id, CAST(k AS INTEGER) AS "cluster", d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM a{ROUNDS} JOIN (SELECT k, sha256(string_agg(x, ',' ORDER BY j)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY k) USING (k)"""


OP11_SQL = _sql()
