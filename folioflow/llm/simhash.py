"""SimHash near-dedup: tiled exact comparison of fingerprints, then connected components.

A fingerprint is the bitwise majority of the 64-bit hashes of a text's word shingles.  Two fingerprints link
when at most ``radius`` bits differ.  Equal fingerprints are one point, so copies never form pairs.

Every point falls into the cell of its population counts: the number of set bits in each of ``blocks`` equal
parts of the word.  The counts of two points differ in sum by no more than their bits do, so cells whose counts
differ beyond the radius cannot hold a link and are skipped.  Cells are cut into tiles of at most
``tile_points`` points; the tile pairs that remain are dealt out evenly and each is compared in full with numpy
exclusive-or and bit counts.  ``blocks`` follows the number of points, so that a cell stays near a tile at any
size; it changes what is skipped and never what is found.

A tile pair passes on a spanning forest of its links (at most one edge for each point), never all pairs.
The edges become components by alternating large-star and small-star rounds over DataFrames.

Defined results: null and empty texts and texts without words have fingerprint zero and link like any other; fewer
words than a shingle hash as the whole sequence; a null doc_id is a row that links by its fingerprint but is never
the smallest id of a component unless all are null (component_id is then null); repeated rows stay repeated;
an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import LOWER_AZ, Workspace, fresh, table

SHINGLE_WORDS = 3
RADIUS = 2
TILE_POINTS = 1024
#: Points that share a cell, as a part of all points, when bits are even: sum over k of (C(b,k)/2^b)^2, to the power of the parts.
_SHARE = {1: 0.0995, 2: 0.140**2, 4: 0.1964**4, 8: 0.2728**8, 16: 0.2734**16}
_HASH_SEED = 42
MAX_STEPS = 400


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """The fingerprint as an unsigned number."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER_AZ).split() if text else []
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), _HASH_SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    last = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for at in range(0, last, 1 << 16):  # very long texts in pieces
        to = min(last, at + (1 << 16))
        hashes = np.fromiter((digest(joined[b:e], _HASH_SEED) for b, e in zip(begins[at:to].tolist(), ends[at + shingle - 1 : to + shingle - 1].tolist(), strict=True)), np.uint64, to - at)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * total > last).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, out: str, text: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Adds the fingerprint as a signed long."""

    def prints(texts):
        return pa.array(np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(out, F.arrow_udf(prints, "long")(F.col(text)))


def _blocks(points: int, tile_points: int, radius: int) -> int:
    """The fewest parts that keep a cell near a tile, while a cell has at most ``MAX_STEPS`` neighbours to meet."""
    best = 1
    for blocks, share in _SHARE.items():
        if blocks > 1 and _balls(blocks, radius) > 2 * MAX_STEPS:
            break
        best = blocks
        if points * share <= tile_points:
            break
    return best


def _balls(blocks: int, radius: int) -> int:
    """How many integer vectors have absolute values of a sum of at most ``radius``."""
    return sum(math.comb(blocks, k) * math.comb(radius, k) << k for k in range(min(blocks, radius) + 1))


def _cells(values: np.ndarray, blocks: int) -> np.ndarray:
    """Population counts of the parts, packed into one long (seven bits each for up to 8 parts, else three)."""
    width = 64 // blocks
    mask, step = np.uint64((1 << width) - 1 if width < 64 else 0xFFFFFFFFFFFFFFFF), 7 if blocks <= 8 else 3
    out = np.zeros(len(values), np.int64)
    for k in range(blocks):
        out |= np.bitwise_count((values >> np.uint64(k * width)) & mask).astype(np.int64) << (k * step)
    return out


def _steps(blocks: int, radius: int) -> list[tuple[int, ...]]:
    """All differences of counts of a sum of at most ``radius``, one of each pair of opposites."""
    out: list[tuple[int, ...]] = [()]
    for _ in range(blocks):
        out = [x + (d,) for x in out for d in range(-radius, radius + 1) if sum(map(abs, x)) + abs(d) <= radius]
    return [x for x in out if next((d for d in x if d), 1) > 0]


def _forest(left: np.ndarray, right: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links left[i]-right[i] over the points 0..n-1."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _compare(a: np.ndarray, b: np.ndarray | None, radius: int, chunk: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links inside the tile ``a`` (b None) or between two tiles, as positions in a, or a followed by b."""
    other, found = a if b is None else b, []
    for at in range(0, len(a), max(1, chunk // max(1, len(other)))):
        part = a[at : at + max(1, chunk // max(1, len(other)))]
        i, j = np.nonzero(np.bitwise_count(part[:, None] ^ other[None, :]) <= radius)
        i = i + at
        if b is None:
            i, j = i[i < j], j[i < j]
        else:
            j = j + len(a)
        found += _forest(i, j, len(a) + (0 if b is None else len(b)))
    both = np.array(found, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def near_edges(points: DataFrame, work: Workspace, radius: int = RADIUS, tile_points: int = TILE_POINTS, blocks: int | None = None) -> DataFrame:
    """Links (a, b) that connect exactly the points (column ``fp``, distinct longs) within ``radius`` bits."""
    count = points.count()
    blocks = blocks or _blocks(count, tile_points, radius)
    step = 7 if blocks <= 8 else 3
    steps = [sum(d << (k * step) for k, d in enumerate(x)) for x in _steps(blocks, radius)]

    def cell(values):
        return pa.array(_cells(values.to_numpy(zero_copy_only=False).view(np.uint64), blocks))

    placed = points.select("fp", F.arrow_udf(cell, "long")("fp").alias("cell"))
    # tiles: a cell's points, dealt by hash into as many tiles as its size asks for.  Cells of more than one tile are few,
    # at most points / tile_points; while they can be broadcast, points are shuffled once, by cell and tile
    crowded = placed.groupBy("cell").agg(F.ceil(F.count("*") / tile_points).alias("tiles")).where("tiles > 1")
    crowded = F.broadcast(crowded) if count <= 100_000 * tile_points else crowded
    placed = placed.join(crowded, "cell", "left").select("cell", F.pmod(F.xxhash64("fp"), F.coalesce("tiles", F.lit(1))).cast("int").alias("tile"), "fp")
    tiles = work.save(placed.groupBy("cell", "tile").agg(F.sort_array(F.collect_list("fp")).alias("fps")), "tiles")
    names = tiles.select("cell", "tile")
    pairs = (
        names.select(F.col("cell").alias("cell_a"), F.col("tile").alias("tile_a"), F.explode(F.array(*[F.col("cell") + F.lit(s) for s in steps])).alias("cell_b"))
        .join(names.select(F.col("cell").alias("cell_b"), F.col("tile").alias("tile_b")), "cell_b")
        .where("cell_a <> cell_b OR tile_a <= tile_b")
    )
    pairs = pairs.join(tiles.select(F.col("cell").alias("cell_a"), F.col("tile").alias("tile_a"), F.col("fps").alias("fps_a")), ["cell_a", "tile_a"])
    pairs = pairs.join(tiles.select(F.col("cell").alias("cell_b"), F.col("tile").alias("tile_b"), F.col("fps").alias("fps_b")), ["cell_b", "tile_b"])
    pairs = pairs.select((F.col("cell_a") == F.col("cell_b")).__and__(F.col("tile_a") == F.col("tile_b")).alias("own"), "fps_a", "fps_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for own, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                a = a.values.to_numpy(zero_copy_only=False).view(np.uint64)
                b = None if own else b.values.to_numpy(zero_copy_only=False).view(np.uint64)
                i, j = _compare(a, b, radius)
                if len(i):
                    both = a if b is None else np.concatenate([a, b])
                    left.append(both[i])
                    right.append(both[j])
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)], names=["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


def components(edges: DataFrame, work: Workspace, rounds: int = 50) -> DataFrame:
    """(node, root) for every node of ``edges``; root is the component's smallest node.

    Alternates large-star (neighbours above a node move to the smallest around it) and small-star (the rest move
    likewise); each round is a few grouped minima and an equi-join, written out to cut the lineage.
    """
    edges = work.save(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "edges0")
    mark = _mark(edges)
    for k in range(1, rounds + 1):
        both = edges.select(F.col("b").alias("u"), F.col("a").alias("v")).union(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
        lows = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(lows, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = work.save(large.where("a < b").distinct(), f"large{k}")
        lows = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(lows, "b").select(F.col("m").alias("x"), F.col("a").alias("y")).where("x < y")
        edges = work.save(small.union(lows.select("m", "b")).toDF("a", "b").distinct(), f"edges{k}")
        work.drop(f"large{k}")
        work.drop(f"edges{k - 1}")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"the components did not settle in {rounds} rounds")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def _mark(edges: DataFrame):
    """What stays the same only if the set of edges does."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").bitwiseAND(0xFFFFFFFF))).first())


def _classes(prints: DataFrame, work: Workspace, doc_id: str, fp: str, **how) -> DataFrame:
    """For each fingerprint that is in ``prints``: the smallest doc_id that it reaches."""
    points = work.save(prints.groupBy(F.col(fp).alias("fp")).agg(F.min(doc_id).alias("low")), "points")
    roots = components(near_edges(points.select("fp"), work, **how), work)
    joined = points.join(roots, points["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = joined.groupBy("root").agg(F.min("low").alias("component"))
    return work.save(joined.join(lows, "root").select("fp", "component"), "classes")


def near_components(docs: DataFrame, shingle: int = SHINGLE_WORDS, **how) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``."""
    work = Workspace(docs.sparkSession, "simhash")
    prints = work.save(with_fingerprint(docs.select("doc_id", "text"), "fp", shingle=shingle).select("doc_id", "fp"), "prints")
    classes = _classes(prints, work, "doc_id", "fp", **how)
    return prints.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"))
