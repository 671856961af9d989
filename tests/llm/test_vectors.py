"""Centroid clustering and hard negatives against plain Python versions."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioflow.llm import centroids, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def made(n, width=64, seed=5):
    """Vectors with groups of equal ones, nulls, odd lengths and repeated rows."""
    rng = random.Random(seed)
    one = lambda: [rng.gauss(0, 0.2) for _ in range(width)]
    hot = one()
    rows = [(k, list(hot) if k % 3 == 0 else one(), rng.randrange(10)) for k in range(n)]
    rows += [rows[0], rows[0], rows[50 % n], (n, [NAN] * width, 1), (n + 1, [INF] + [0.0] * (width - 1), 1), (n + 2, None, 1), (n + 3, [None] + [0.1] * (width - 1), 1), (n + 4, [0.5] * (width - 1), 2)]
    return rows + [(n + 5, [], 3), (n + 6, one(), None), (None, one(), 4), (n + 7, [0.0] * width, 4), (n + 8, [1.0] * width, 4), (n + 8, [1.0] * width, 5)]


def lloyd(rows, clusters=16, rounds=3, width=64, scale=64):
    kept = [(i, [math.floor(float(np.float32(x)) * scale) for x in v]) for i, v, *_ in rows if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((r for r in kept if r[0] is not None), key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    points = [list(v) for _, v in (order + [r for r in kept if r[0] is None])[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, p, strict=True)), k) for k, p in enumerate(points))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for k, vs in groups.items():
            points[k] = [sum(c) // len(vs) for c in zip(*vs, strict=True)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    total = sum(d for *_, d in found)
    return [(i, k, d, sum(x[2] for x in found if x[1] == k), total, hashlib.sha256(",".join(map(str, points[k])).encode()).hexdigest()) for i, k, d in found]


@pytest.mark.parametrize("n", [0, 7, 150])
def test_lloyd_equals_plain_python(spark, n):
    rows = made(n) if n else [(1, None, 1), (2, [0.1], 1)]
    got = centroids.clustering_report(spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("key", "cluster", "distance", "vector", "total")}).repartition(5))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(lloyd(rows), key=repr)


def test_clusters_empty_and_ties(spark):
    rows = [(k, [float(k // 8 == j) for j in range(64)], 0) for k in range(16)] + [(k, [0.5, 0.5] + [0.0] * 62, 0) for k in range(16, 40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, centroids.clustering_report(docs).collect())) == sorted(lloyd(rows))
    assert centroids.clustering_report(docs.limit(0)).count() == 0


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="cannot be clustered in 64 bits"):
        centroids.clustering_report(spark.createDataFrame([(1, [3e9] + [0.0] * 63, 1)], SCHEMA)).count()


def negatives_of(rows, every=50, positives=5, negatives=3):
    kept = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(float(np.float32(x)) * 256) for x in v]))
    out = []
    for a, (aid, alabel, av) in enumerate(kept):
        if aid % every:
            continue
        ranked = sorted((-sum(x * y for x, y in zip(av, v, strict=False)), i, label, b) for b, (i, label, v) in enumerate(kept) if b != a)
        for ps, pid, *_ in [r for r in ranked if r[2] == alabel][:positives]:
            window = [r for r in ranked if r[2] != alabel and 50 * -ps <= 100 * -r[0] <= 95 * -ps][:negatives]
            out += [(aid, pid, n + 1, i, -ps, -s) for n, (s, i, *_) in enumerate(window)]
    return sorted(out)


@pytest.mark.parametrize(("radix", "block_bytes"), [(512, 1 << 20), (7, 600), (40, 4096)])
def test_negatives_equal_plain_python(spark, radix, block_bytes):
    rows = made(160)
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("score", "window", "rank", "id", "vector")}).repartition(5)
    every = 50 if radix != 40 else 20
    got = hard_negatives.mine(docs, every=every, radix=radix, block_bytes=block_bytes)
    assert sorted(map(tuple, got.collect())) == negatives_of(rows, every) and got.count() > 0


def test_negatives_with_many_ties_and_few_rows(spark):
    same = [0.25] * 8
    rows = [(k, same if k % 4 else [0.125] * 8, k % 2) for k in range(120)]
    assert sorted(map(tuple, hard_negatives.mine(spark.createDataFrame(rows, SCHEMA)).collect())) == negatives_of(rows)
    for few in ([], rows[:1], rows[:2], [(0, None, 1)], [(50, same, 1), (50, same, 1), (51, [0.2] * 8, 2)], [(1, same, 0), (2, same, 1)]):
        assert sorted(map(tuple, hard_negatives.mine(spark.createDataFrame(few, SCHEMA)).collect())) == negatives_of(few)


def test_integer_scores_beyond_doubles(spark):
    rows = [(k, [2.0**19 + k, 2.0**18 - 3 * k, 1.0], k % 3) for k in range(60)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    want = negatives_of([(i, v, label) for i, v, label in rows])
    assert sorted(map(tuple, hard_negatives.mine(docs).collect())) == want
    with pytest.raises(ValueError, match="leave 64 bits"):
        hard_negatives.mine(spark.createDataFrame([(0, [1e20], 1), (1, [1e20], 1)], "vec_id long, embedding array<double>, label int"))


def test_whole_tables_against_plain_python(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    assert sorted(map(tuple, centroids.op11_centroids(spark, "/root/testdata/sf0.001").collect())) == sorted(lloyd(rows))
    assert sorted(map(tuple, hard_negatives.op12_hard_negatives(spark, "/root/testdata/sf0.001").collect())) == negatives_of(rows)
