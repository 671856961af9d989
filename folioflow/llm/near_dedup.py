"""Near-dedup of a corpus: tiled exact comparison of wide SimHash sketches, verified on word shingles.

Documents are near copies when the sets of their five-word shingles have a Jaccard similarity of 0.8 or more; one
row of each connected group stays.  A sketch is 256 SimHash bits of the distinct shingles.  At the similarity asked
for, bits differ with probability p = acos(2s/(1+s))/pi; pairs up to ``SIGMAS`` standard deviations above that are
candidates, first on 64 bits, then on all.  This radius is too wide for population counts to part tiles, but sizes do:
similar sets have sizes within the factor s, so tiles hold documents of one size class, only equal and neighbouring
classes are compared, and rows of a tile pair meet only the columns within the factor.

Each tile pair passes on a minimum spanning forest of its candidates, nearest first: at most an edge for each
document, never all pairs of a group.  Edges are verified by the exact similarity and become components.  An edge that
fails may have stood for true links between the same groups, so groups that failed edges connect are compared
again: all their pairs of different groups, by the sets themselves, in tiles of at most about ``TILE_HASHES`` shingles.

Texts are told apart by 64-bit XXH64.  The number of compared pairs grows with the square of a size class; exact copies and equal sketches are one point.

Defined results: of a group the row of the smallest doc_id stays (null last, then the first row); texts without
words are copies of each other; fewer than five words are one shingle; repeated rows are copies, so one stays; an
empty table stays empty; all columns pass through.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import LOWER_AZ, Workspace, fresh
from .simhash import components

SHINGLE_WORDS = 5
SIMILARITY = 0.8
SIGMAS = 3.2
TILE_POINTS = 8192
TILE_HASHES = 1 << 18
_WORDS = ("w0", "w1", "w2", "w3")


def shingle_hashes(text: str | None, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct hashes of the word shingles, in order."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER_AZ).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    begins = [0, *[e + 1 for e in ends[:-1]]]
    digest = xxhash.xxh64_intdigest
    last = max(1, len(words) - shingle + 1)
    ends = ends[min(shingle, len(words)) - 1 :]
    return np.unique(np.fromiter((digest(joined[b:e]) for b, e in zip(begins[:last], ends, strict=True)), np.uint64, last))


def sketch(hashes: np.ndarray) -> list[int]:
    """Four 64-bit majorities: of the hashes, and of three mixes of them."""
    out = []
    for k in range(4):
        x = hashes
        if k:
            x = (x + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(32))
        total = np.zeros(64, np.int64)
        for at in range(0, len(x), 1 << 16):
            total += np.unpackbits(np.ascontiguousarray(x[at : at + (1 << 16)]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out.append(int(np.packbits((2 * total > len(x)).astype(np.uint8), bitorder="little").view(np.int64)[0]))
    return out


def radius(similarity: float, bits: int) -> int:
    """How many of ``bits`` sketch bits a pair of that similarity may differ in, with ``SIGMAS`` to spare."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(bits * p + SIGMAS * math.sqrt(bits * p * (1 - p)))


def _candidates(a: dict, b: dict | None, similarity: float, near: int, far: int) -> list[tuple[int, int]]:
    """A minimum spanning forest (pairs of points) of the candidates inside a tile, or between two."""
    other = a if b is None else b
    order = np.argsort(other["n"], kind="stable")
    sizes = other["n"][order]
    cols = [other[w][order] for w in _WORDS]
    rows = np.argsort(a["n"], kind="stable")
    left, right, far_bits = [], [], []
    step = max(16, (1 << 20) // max(1, len(order)))
    for at in range(0, len(rows), step):
        part = rows[at : at + step]
        low = np.searchsorted(sizes, a["n"][part[0]] * similarity - 1e-9)
        high = np.searchsorted(sizes, a["n"][part[-1]] / similarity + 1e-9, side="right")
        if low >= high:
            continue
        i, j = np.nonzero(np.bitwise_count(a["w0"][part][:, None] ^ cols[0][None, low:high]) <= near)
        i, j = part[i], j + low
        bits = sum(np.bitwise_count(a[w][i] ^ c[j]).astype(np.int64) for w, c in zip(_WORDS, cols, strict=True))
        keep = bits <= far
        if b is None:
            keep &= i < order[j]
        left.append(i[keep])
        right.append(order[j[keep]])
        far_bits.append(bits[keep])
    if not left:
        return []
    i, j, bits = np.concatenate(left), np.concatenate(right), np.concatenate(far_bits)
    nearest = np.argsort(bits, kind="stable")
    i, j = i[nearest], j[nearest] + (0 if b is None else len(a["n"]))
    pids = a["pid"] if b is None else np.concatenate([a["pid"], b["pid"]])
    return [(int(pids[x]), int(pids[y])) for x, y in _forest(i, j, len(pids))]


def _forest(left: np.ndarray, right: np.ndarray, n: int, chunk: int = 1 << 14) -> list[tuple[int, int]]:
    """Links, in the given order, that join what was not joined before.  Between chunks the links inside joined groups are
    taken out at once, so a dense group costs few steps beyond its members."""
    parent, out, at = np.arange(n), [], 0
    while at < len(left):
        while not np.array_equal(parent, flat := parent[parent]):
            parent = flat
        if at:
            keep = parent[left[at:]] != parent[right[at:]]
            left, right, at = left[at:][keep], right[at:][keep], 0
        own = parent.tolist()

        def root(x: int, own=own) -> int:
            while own[x] != x:
                own[x] = own[own[x]]
                x = own[x]
            return x

        for x, y in zip(left[:chunk].tolist(), right[:chunk].tolist(), strict=True):
            r, s = root(x), root(y)
            if r != s:
                own[max(r, s)] = min(r, s)
                out.append((x, y))
        parent, at = np.array(own), chunk
    return out


def _tile(array: pa.StructScalar) -> dict:
    flat = array.values
    out = {w: flat.field(w).to_numpy(zero_copy_only=False).view(np.uint64) for w in _WORDS}
    return out | {"n": flat.field("n").to_numpy(zero_copy_only=False), "pid": flat.field("pid").to_numpy(zero_copy_only=False)}


def _links(a: pa.ListScalar, b: pa.ListScalar | None, similarity: float) -> list[tuple[int, int]]:
    """Pairs of exact similarity that join different groups, inside a tile of sets or between two: enough of them to connect
    what all such pairs connect."""
    flat = a.values if b is None else pa.concat_arrays([a.values, b.values])
    lists, pids = flat.field("s"), flat.field("end").to_numpy(zero_copy_only=False)
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    begins = np.cumsum(sizes) - sizes
    distinct, ids = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
    group = np.unique(flat.field("group").to_numpy(zero_copy_only=False), return_inverse=True)[1]
    second = np.arange(len(pids)) >= len(a.values)
    order = np.argsort(sizes, kind="stable")
    by_size, inside, out = sizes[order], np.zeros(len(distinct), bool), []
    for at, x in enumerate(order.tolist()):
        cols = order[at + 1 : np.searchsorted(by_size, sizes[x] / similarity + 1e-9, side="right")]
        keep = (group[cols] != group[x]) & (sizes[cols] > 0)
        if b is not None:
            keep &= second[cols] != second[x]
        cols = cols[keep]
        if not len(cols):
            continue
        own, widths = ids[begins[x] : begins[x] + sizes[x]], sizes[cols]
        starts = np.cumsum(widths) - widths
        inside[own] = True
        common = np.add.reduceat(inside[ids[np.repeat(begins[cols] - starts, widths) + np.arange(widths.sum())]], starts, dtype=np.int64)
        inside[own] = False
        hits = cols[common >= similarity * (sizes[x] + widths - common)]
        for g, k in zip(*np.unique(group[hits], return_index=True), strict=True):
            out.append((int(pids[x]), int(pids[hits[k]])))
            group[group == g] = group[x]
    return out


def _lost_links(failed: DataFrame, roots: DataFrame, sets: DataFrame, similarity: float, tile_hashes: int, work: Workspace) -> DataFrame | None:
    """Links (a, b) between verified groups that failed edges connect; none if no failed edge is left between groups."""
    of = lambda end, name: roots.select(F.col("node").alias(end), F.col("root").alias(name))
    groups = failed.join(of("a", "ga"), "a", "left").join(of("b", "gb"), "b", "left").select(F.coalesce("ga", "a").alias("a"), F.coalesce("gb", "b").alias("b"))
    groups = work.save(groups.where("a <> b").distinct(), "loose")
    if groups.isEmpty():
        return None
    found = components(groups, work)
    cluster = work.save(found.union(found.select("root", "root")).distinct().toDF("group", "cluster"), "clusters")
    named = sets.select("end", F.size("s").cast("long").alias("n")).join(of("end", "root"), "end", "left").select("end", "n", F.coalesce("root", "end").alias("group"))
    named = work.save(named.join(cluster, "group"), "members")
    # a group of more than a tile has tiles of its own, which need not be compared with each other; the others of a cluster share tiles
    large = named.groupBy("cluster", "group").agg((F.sum("n") > tile_hashes).alias("large"))
    named = named.join(large, ["cluster", "group"]).withColumn("part", F.when(F.col("large"), F.col("group")).otherwise(F.lit(0)))
    key = ["cluster", "large", "part"]
    count = named.groupBy(*key).agg(F.ceil(F.sum("n") / tile_hashes).cast("long").alias("count"))
    placed = work.save(named.join(count, key).select("end", "group", *key, F.pmod(F.xxhash64("end"), F.greatest("count", F.lit(1))).alias("tile")), "placed")
    tiles = placed.join(sets, "end").groupBy(*key, "tile").agg(F.collect_list(F.struct("end", "group", "s")).alias("points"))
    tiles = work.save(tiles, "set-tiles")
    a, b = (tiles.select("cluster", *[F.col(c).alias(f"{c}_{x}") for c in ("large", "part", "tile")]) for x in "ab")
    order = lambda x: F.struct(f"large_{x}", f"part_{x}", f"tile_{x}")
    same = F.col("large_a") & F.col("large_b") & (F.col("part_a") == F.col("part_b"))
    names = work.save(a.join(b, "cluster").where((order("a") <= order("b")) & ~same).withColumn("own", order("a") == order("b")), "set-pairs")
    sides = [tiles.select("cluster", *[F.col(c).alias(f"{c}_{x}") for c in ("large", "part", "tile")], F.col("points").alias(x)) for x in "ab"]
    dealt = names.join(sides[0], ["cluster", "large_a", "part_a", "tile_a"]).join(sides[1], ["cluster", "large_b", "part_b", "tile_b"]).select("own", "a", "b")

    def compare(batches):
        for batch in batches:
            found = []
            for own, x, y in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                found += _links(x, None if own else y, similarity)
            if found:
                both = np.array(found, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    return work.save(dealt.mapInArrow(compare, "a long, b long").distinct(), "lost")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE_WORDS, similarity: float = SIMILARITY, text: str = "text", doc_id: str = "doc_id", tile_points: int = TILE_POINTS, tile_hashes: int = TILE_HASHES) -> DataFrame:
    """One row of each group of near copies, with the columns of ``docs``."""
    work = Workspace(docs.sparkSession, "near-dedup")
    # a row is known by its id and hashes of its text; row numbers would not survive a second scan
    doc, mark, of = fresh(docs, "doc", "mark", "of")
    text_hash, id_or, row_hash = F.xxhash64(F.col(text)), F.coalesce(F.col(doc_id), F.lit(-1)), F.xxhash64(F.lit(7), F.col(doc_id), F.col(text))
    kind = pa.struct([*[(w, pa.int64()) for w in _WORDS], ("n", pa.int32())])

    def sketches(texts):
        out = []
        for t in texts:
            hashes = shingle_hashes(t.as_py(), shingle)
            out.append(dict(zip((*_WORDS, "n"), (*sketch(hashes), len(hashes)), strict=True)))
        return pa.array(out, kind)

    named = docs.select(text_hash.alias("row"), F.col(doc_id).alias("doc"), row_hash.alias("mark"), F.arrow_udf(sketches, "struct<w0:long,w1:long,w2:long,w3:long,n:int>")(F.col(text)).alias("k"))
    rows = work.save(named.select("row", "doc", "mark", "k.*"), "sketches")
    points = work.save(rows.groupBy(*_WORDS, "n").agg(F.min("row").alias("pid")), "points")
    # size classes, cut into tiles by hash
    size_class = F.when(F.col("n") > 0, F.floor(F.log(F.col("n").cast("double")) / math.log(1 / similarity) + 1e-9).cast("int")).otherwise(-9)
    placed = points.withColumn("class", size_class)
    tiles_of = {r["class"]: -(-r["count"] // tile_points) for r in placed.groupBy("class").count().collect()}  # fewer than 200 classes
    count = F.element_at(F.create_map(*[F.lit(x) for c, n in sorted(tiles_of.items()) for x in (c, n)]), F.col("class")) if tiles_of else F.lit(1)
    placed = placed.withColumn("tile", F.pmod(F.xxhash64("pid"), count.cast("long")).cast("int"))
    tiles = work.save(placed.groupBy("class", "tile").agg(F.collect_list(F.struct("pid", "n", *_WORDS)).alias("points")), "tiles", codec="none")
    dealing = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a fixed number, or few small pairs would share a task
    names = _pair_names(tiles).repartition(dealing, "ca", "ta", "cb", "tb")
    a, b = (tiles.select(F.col("class").alias(f"c{x}"), F.col("tile").alias(f"t{x}"), F.col("points").alias(x)) for x in "ab")
    dealt = names.join(a, ["ca", "ta"]).join(b, ["cb", "tb"]).select(((F.col("ca") == F.col("cb")) & (F.col("ta") == F.col("tb"))).alias("own"), "a", "b")
    near, far = radius(similarity, 64), radius(similarity, 256)

    def compare(batches):
        for batch in batches:
            found = []
            for own, x, y in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                found += _candidates(_tile(x), None if own else _tile(y), similarity, near, far)
            if found:
                both = np.array(found, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    edges = work.save(dealt.mapInArrow(compare, "a long, b long").distinct(), "candidates")
    ends = work.save(edges.select(F.col("a").alias("end")).union(edges.select("b")).distinct(), "ends")

    def hashes_of(texts):
        return pa.array([shingle_hashes(t.as_py(), shingle).view(np.int64) for t in texts], pa.list_(pa.int64()))

    few = ends.limit(500_001).count() <= 500_000  # eight bytes each
    # one text of each end: copies of a text are many, its hashes are the same
    wanted = docs.select(text_hash.alias("end"), F.col(text).alias("text")).join(F.broadcast(ends) if few else ends, "end")
    sets = wanted.select("end", F.arrow_udf(hashes_of, "array<long>")(F.col("text")).alias("s"))
    sets = work.save(sets.groupBy("end").agg(F.first("s").alias("s")), "sets")
    both = edges.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    judged = work.save(both.select("a", "b", (common >= F.lit(similarity) * (F.size("sa") + F.size("sb") - common)).alias("holds")), "judged")
    true = judged.where("holds").select("a", "b")
    roots, again, final = components(true, work), Workspace(docs.sparkSession, "near-dedup"), Workspace(docs.sparkSession, "near-dedup")
    lost = _lost_links(judged.where("NOT holds").select("a", "b"), roots, sets, similarity, tile_hashes, again)
    if lost is not None:
        roots = components(true.union(lost), final)
        again.drop()
    grouped = points.join(roots, points["pid"] == roots["node"], "left").select(*_WORDS, "n", F.coalesce("root", "pid").alias("group"))
    ranked = rows.join(grouped, [*_WORDS, "n"]).select("doc", "mark", "group")
    first = F.min(F.struct(F.col("doc").isNull().alias("last"), "doc", "mark")).alias("first")
    keep = work.save(ranked.groupBy("group").agg(first).select(F.coalesce("first.doc", F.lit(-1)).alias(doc), F.col("first.mark").alias(mark)).distinct(), "keep")
    for name in ("sets", "candidates", "judged", "tiles", "sketches"):
        work.drop(name)
    final.drop()
    # rows of equal id and text are repetitions: one of them is left where they are read, so they never meet in the shuffle
    one = docs.withColumns({of: id_or, mark: row_hash}).dropDuplicates([of, mark])
    return one.join(keep.withColumnRenamed(doc, of), [of, mark]).select(*docs.columns)


def _pair_names(tiles: DataFrame) -> DataFrame:
    """Pairs of tiles of equal or neighbouring classes, by an equi-join on the class."""
    names = tiles.select("class", "tile")
    left = names.select(F.col("class").alias("ca"), F.col("tile").alias("ta"), F.explode(F.array(F.col("class"), F.col("class") + 1)).alias("cb"))
    return left.join(names.select(F.col("class").alias("cb"), F.col("tile").alias("tb")), "cb").where("ca <> cb OR ta <= tb").select("ca", "ta", "cb", "tb")
