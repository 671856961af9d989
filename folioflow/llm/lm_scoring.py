"""Language-model scoring from a log-frequency Bloom filter.

Words are lower-cased runs of non-white-space; one end token closes each text.  The n-grams of order one and two of all
training texts are counted exactly.  An n-gram of count c goes into the filter with each level 1..1+floor(log2 c), so
one seen once has level 1.  A reader asks for level 1, 2, ... until the filter says no; the last yes q stands for a count
of 2**(q-0.5), and of 1 for level 1, which has no other.

    P(w|v) = (c(v,w) + A*P1(w)) / (c(v) + A),   P1(w) = (c(w)+0.5) / (N+0.5*(V+1))

Here c(v,w) comes from the filter; c(v) and c(w) come from a broadcast table of the ``VOCABULARY`` most frequent words, and from
the filter for all other words.  The base score has exact counts of all words: those outside the table meet the full
counts in a join on the word, which only numbers pass, never texts.

Counting is one pass over the training texts.  Each task sorts the n-grams that it has seen and sends them on as packed arrays, cut
into blocks by ranges of their hashes; one task for each block adds up the counts and builds that block's part of the filter, so there is
about one block for each ``BLOCK_TEXT`` bytes of training text and none depends on the size of the whole.

Scoring is one pass over all texts, whatever the size of the filter.  A filter of at most ``BROADCAST_BYTES`` is broadcast to the workers.  A
larger one stays in its blocks: each task asks for the distinct n-grams of ``PART_BYTES`` of text at a time, requests go to the
blocks, and levels come back to the part.  Both ways give the same levels.

Defined results: null and empty texts have the end token alone; a null doc_id is in the training folds; an empty
training set has N = V = 0, so every token has P1 = 0.5/0.5 and both scores are 0; repeated rows count and are
scored as often as they stand there.  N-grams are counted by 64 bits of a mix of XXH64
hashes of words; a block of the filter tells its own apart by 32 bits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.types import _parse_datatype_string as ddl

from ._common import Workspace, parts_of, table, word_codes

VOCABULARY = 1 << 18
ALPHA = 200.0
BITS = 12
PROBES = 6
BLOCK_TEXT = 16 << 20
BROADCAST_BYTES = 16 << 20
PART_BYTES = 4 << 20
#: N-grams that a task holds before it sorts them and sends them on.
HELD_GRAMS = 4_000_000
END_HASH = xxhash.xxh64_intdigest("\n")  # no word can be this
_WORD_SEED = np.uint64(0x9E3779B97F4A7C15)
_BINS = 256
_MODEL = "block int, bits binary, words binary, counts binary, tokens bigint, types bigint, bins array<bigint>"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pairs(before: np.ndarray, now: np.ndarray) -> np.ndarray:
    """Keys of bigrams, from the hashes of their words."""
    return _mix(_mix(before) + now)


def _singles(words: np.ndarray) -> np.ndarray:
    """Keys of words as n-grams of order one."""
    return _mix(words ^ _WORD_SEED)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct tokens of some texts (the first is the end), the number of each token in text order, end tokens
    included, and how many each text has."""
    words, codes, many = word_codes(texts)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    return np.concatenate([np.array([END_HASH], np.uint64), hashes]), np.insert(codes + 1, np.cumsum(many), 0), many + 1


def _before(codes: np.ndarray) -> np.ndarray:
    """The token before each; before a text's first word stands an end."""
    return np.concatenate([np.zeros(1, codes.dtype), codes[:-1]])


def _cuts(blocks: int) -> np.ndarray:
    """The least key of each block but the first."""
    return np.array([-(-(k << 64) // blocks) for k in range(1, blocks)], np.uint64)


def _within(keys: np.ndarray, block: np.ndarray | int, blocks: int) -> np.ndarray:
    """The 32 bits that tell n-grams of one block apart in the filter: the leading bits of the distance from its least key.  A block has
    some 3 million entries at most, so two n-grams share them once in over 1,000 times, less often than the filter errs."""
    least = np.concatenate([np.zeros(1, np.uint64), _cuts(blocks)])
    return (keys - least[block]) >> np.uint64(max(0, 33 - blocks.bit_length()))


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often they occur."""
    if counts is None:
        keys = np.sort(keys)
        counts = np.ones(len(keys), np.int64)
    else:
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def train_fold(doc_id: Column, folds: int = 5) -> Column:
    """True for training rows: crc32 of the id as text, modulo ``folds``, is not 1 (a null id trains)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds != 1, F.lit(True))


def _places(keys: np.ndarray, level: int, probe: int, size: np.ndarray) -> np.ndarray:
    """The bit of a block of ``size`` bits that a probe of (n-gram, level) looks at."""
    h = _mix(keys + np.uint64(level * int(_WORD_SEED) & 0xFFFFFFFFFFFFFFFF))
    return (((h + np.uint64(probe) * ((h << np.uint64(32)) | np.uint64(1 << 32))) >> np.uint64(32)) * size) >> np.uint64(32)


def filter_of(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The packed bits of a block: every n-gram with all its levels, ``BITS`` bits for each entry."""
    levels = np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1
    size = max(64, -(-int(levels.sum()) * BITS // 64) * 64)
    if size >= 1 << 32:
        raise ValueError("a block of the filter is too large: lower BLOCK_TEXT")
    bits = np.zeros(size, np.uint8)
    for q in range(1, int(levels.max(initial=0)) + 1):
        at = keys[levels >= q]
        for p in range(PROBES):
            bits[_places(at, q, p, np.uint64(size)).astype(np.int64)] = 1
    return np.packbits(bits)


def levels_in(keys: np.ndarray, bits: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Quantised levels of n-grams by repeated membership probes; ``begin`` and ``size`` give the first byte and the number of bits of the
    block of each."""
    out, left = np.zeros(len(keys), np.uint8), np.arange(len(keys))
    for q in range(1, 64):
        for p in range(PROBES):
            at = _places(keys[left], q, p, size[left])
            byte = bits[begin[left] + (at >> np.uint64(3)).astype(np.int64)]
            left = left[(byte >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 == 1]
            if not len(left):
                return out
        out[left] = q
    return out


def _read(level: np.ndarray) -> np.ndarray:
    """The count that a level stands for."""
    level = level.astype(np.float64)
    return np.where(level > 1, np.exp2(level - 0.5), level)


def quantised(c: int) -> float:
    """What the filter gives back for a count."""
    return float(_read(np.array([1 + int(math.log2(c)) if c else 0]))[0])


class Model:
    """What scoring needs: totals, counts of frequent words, and the filter's blocks in the shared folder."""

    def __init__(self, work: Workspace, train: DataFrame, vocabulary: int = VOCABULARY, alpha: float = ALPHA, block_text: int = BLOCK_TEXT):
        self.alpha, self.work = alpha, work
        nbytes = train.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        blocks = self.blocks = max(1, -(-nbytes // block_text))
        cuts = _cuts(blocks)

        def count(batches):
            pairs, singles, held = [], [], 0

            def flush():
                parts = [(*_summed(np.concatenate(pairs)), False), (*_summed(np.concatenate(singles)), True)]
                for keys, counts, single in parts:
                    keyed = _singles(keys) if single else keys  # a word's block goes by its key as an n-gram
                    if single:
                        order = np.argsort(keyed)
                        keys, counts, keyed = keys[order], counts[order], keyed[order]
                    ends = np.concatenate([[0], np.searchsorted(keyed, cuts), [len(keyed)]])
                    full = np.flatnonzero(np.diff(ends)).tolist()
                    sides = [[x[ends[b] : ends[b + 1]].astype(kind).tobytes() for b in full] for x, kind in ((keys, "<u8"), (counts, "<u4"))]
                    yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([single] * len(full), pa.bool_()), *[pa.array(s, pa.binary()) for s in sides]], names=["block", "single", "keys", "counts"])

            for batch in batches:
                for begin, many in parts_of(batch.column(0), PART_BYTES):
                    hashes, codes, _ = tokens_of(batch.column(0).slice(begin, many))
                    stream = hashes[codes]
                    pairs.append(_pairs(hashes[_before(codes)], stream))
                    singles.append(stream)
                    held += len(stream)
                    if held >= HELD_GRAMS:
                        yield from flush()
                        pairs, singles, held = [], [], 0
            if held:
                yield from flush()

        def build(batches):
            got: dict = {}
            for batch in batches:
                for block, single, keys, counts in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
                    got.setdefault(block, ([], []))[single].append((np.frombuffer(keys, "<u8"), np.frombuffer(counts, "<u4").astype(np.int64)))
            for block, kinds in got.items():
                (pairs, n), (words, c) = (_summed(*map(np.concatenate, zip(*rows, strict=True))) if rows else (np.zeros(0, np.uint64), np.zeros(0, np.int64)) for rows in kinds)
                bits = filter_of(_within(np.concatenate([pairs, _singles(words)]), block, blocks), np.concatenate([n, c]))
                bins = np.bincount(np.floor(4 * np.log2(c)).astype(np.int64), minlength=_BINS)
                row = {"block": block, "bits": bits.tobytes(), "words": words.tobytes(), "counts": c.tobytes(), "tokens": int(c.sum()), "types": len(c), "bins": bins.tolist()}
                yield pa.RecordBatch.from_pylist([row], pa.schema([("block", pa.int32()), ("bits", pa.binary()), ("words", pa.binary()), ("counts", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64()), ("bins", pa.list_(pa.int64()))]))

        grams = train.select("text").mapInArrow(count, "block int, single boolean, keys binary, counts binary")
        self.table = work.save(grams.repartitionById(blocks, F.col("block")).mapInArrow(build, _MODEL), "model", codec="none")
        sums = self.table.select(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("types"), F.lit(0)).alias("v"), F.coalesce(F.sum(F.octet_length("bits")), F.lit(0)).alias("bytes")).first()
        self.tokens, self.types, self.bytes = sums
        self.z = self.tokens + 0.5 * (self.types + 1)
        # frequent: all words from a count on, the lowest at which they are no more than the vocabulary
        bins = {r["bin"]: r["n"] for r in self.table.select(F.posexplode("bins").alias("bin", "n")).groupBy("bin").agg(F.sum("n").alias("n")).collect()}
        cut, held = _BINS, 0
        for b in sorted(bins, reverse=True):
            held += bins[b]
            if held > vocabulary:
                break
            cut = b
        found = self.words(cut).orderBy("h").collect()
        h, c = np.array([r["h"] for r in found], np.int64).view(np.uint64), np.array([r["c"] for r in found], np.int64)
        order = np.argsort(h)
        self.frequent = h[order], c[order]
        self.cut = cut

    def words(self, low: int = 0, below: int = _BINS) -> DataFrame:
        """(h, c) of the words whose counts lie in the given bins."""

        def unpack(batches):
            for batch in batches:
                for words, counts in zip(batch.column(0), batch.column(1), strict=True):
                    h, c = np.frombuffer(words.as_buffer(), "<i8"), np.frombuffer(counts.as_buffer(), "<i8")
                    at = np.floor(4 * np.log2(c))
                    keep = (at >= low) & (at < below)
                    yield pa.RecordBatch.from_arrays([pa.array(h[keep]), pa.array(c[keep])], names=["h", "c"])

        return self.table.select("words", "counts").mapInArrow(unpack, "h long, c long")

    def filter(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The whole filter, and the first byte and the number of bits of each block; the blocks come one after the other."""
        sizes = np.full(self.blocks, 8, np.int64)  # a block without n-grams has no row
        for r in self.table.select("block", F.octet_length("bits").alias("n")).collect():
            sizes[r["block"]] = r["n"]
        begin = np.cumsum(sizes) - sizes
        bits = np.zeros(int(sizes.sum()), np.uint8)
        for r in self.table.select("block", "bits").toLocalIterator():
            bits[begin[r["block"]] : begin[r["block"]] + sizes[r["block"]]] = np.frombuffer(r["bits"], np.uint8)
        return bits, begin, (sizes * 8).astype(np.uint64)


class Part:
    """Some texts: their distinct n-grams, and what a score needs beside the levels of these."""

    def __init__(self, texts: pa.Array, frequent: tuple[np.ndarray, np.ndarray]):
        hashes, codes, self.many = tokens_of(texts)
        keys, counts = frequent
        at = np.minimum(np.searchsorted(keys, hashes), max(len(keys) - 1, 0))
        known = keys[at] == hashes if len(keys) else np.zeros(len(hashes), bool)
        #: counts of words in the table, -1 for others
        self.counts = np.where(known, counts[at], -1) if len(keys) else np.full(len(hashes), -1)
        self.hashes, self.codes = hashes, codes.astype(np.int32)
        self.keys, self.turn, self.rare, self.rare_at = Part.placed(hashes, codes, self.counts)
        # the words outside the table, for their exact counts
        out = np.flatnonzero(self.counts[codes] < 0)
        row = np.repeat(np.arange(len(self.many)), self.many)[out]
        word, n = np.unique(row * np.int64(len(hashes)) + codes[out], return_counts=True)
        ends = np.searchsorted(word, np.arange(len(self.many) + 1) * np.int64(len(hashes))).astype(np.int32)
        lists = (hashes[word % len(hashes)].view(np.int64), n.astype(np.int64))
        self.others = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in lists]
        begins = np.cumsum(self.many) - self.many
        exact = np.log10(np.maximum(self.counts, 0) + 0.5)[codes]  # a word outside the table counts as unseen until it meets its count
        self.base = np.add.reduceat(exact, begins)
        self.seen = np.add.reduceat((self.counts > 0)[codes].astype(np.int64), begins)

    @staticmethod
    def placed(hashes: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct keys in order, where the bigram of each token stands among them, the words outside the table, and where these stand."""
        pair = _before(codes) * np.int64(len(hashes)) + codes
        order = np.argsort(pair)
        new = np.concatenate([[True], pair[order[1:]] != pair[order[:-1]]])
        turn = np.empty(len(pair), np.int32)
        turn[order] = np.cumsum(new, dtype=np.int32) - 1
        first, rare = pair[order[new]], np.flatnonzero(counts < 0)
        grams = np.concatenate([_pairs(hashes[first // len(hashes)], hashes[first % len(hashes)]), _singles(hashes[rare])])
        by_key = np.lexsort((np.arange(len(grams)), grams))
        place = np.empty(len(grams), np.int32)
        place[by_key] = np.arange(len(grams), dtype=np.int32)
        return grams[by_key], place[turn], rare, place[len(first) :]

    @staticmethod
    def scores(placed: tuple, codes: np.ndarray, counts: np.ndarray, levels: np.ndarray, many: np.ndarray, alpha: float, z: float) -> np.ndarray:
        """log10 probabilities of the texts, from the levels of the keys."""
        _, turn, rare, rare_at = placed
        got, c = _read(levels), counts.astype(np.float64)
        c[rare] = got[rare_at]
        before, now = np.zeros(len(got), np.int32), np.zeros(len(got), np.int32)
        before[turn], now[turn] = _before(codes), codes
        before, now = c[before], c[now]
        both = np.minimum(got, np.minimum(before, now))  # no bigram occurs more often than its words
        logs = np.log10(both + alpha * ((now + 0.5) / z)) - np.log10(before + alpha)
        return np.add.reduceat(logs[turn], np.cumsum(many) - many)


#: What a part of the texts keeps while its requests are answered.
_KINDS = {"hashes": np.uint64, "codes": np.int32, "counts": np.int64}


def score(docs: DataFrame, folds: int = 5, broadcast_bytes: int = BROADCAST_BYTES, part_bytes: int = PART_BYTES, **how) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``."""
    work = Workspace(docs.sparkSession, "lm")
    rows = docs.select("doc_id", "text", train_fold(F.col("doc_id"), folds).alias("train"))
    model = Model(work, rows.where("train"), **how)
    one = _scored_by_broadcast if model.bytes <= broadcast_bytes else _scored_by_blocks
    scored = work.save(one(rows, model, work, part_bytes).withColumn("row", F.monotonically_increasing_id()), "scored")
    work.drop("asked")
    work.drop("levels")
    # exact counts of the words outside the table; the rows have no texts any more
    met = scored.select("row", F.explode(F.arrays_zip("h", "tf")).alias("x")).select("row", "x.h", "x.tf").join(model.words(below=model.cut), "h")
    more = met.groupBy("row").agg(F.sum(F.col("tf") * (F.log10(F.col("c") + 0.5) - math.log10(0.5))).alias("more"), F.sum("tf").alias("also"))
    base = F.col("base") + F.coalesce("more", F.lit(0.0)) - F.col("n") * F.lit(math.log10(model.z))
    return scored.drop("h", "tf").join(more, "row", "left").select(
        "doc_id", (~F.col("train")).alias("held_out"), F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )


def _result(key: StructField) -> StructType:
    return StructType([key, *ddl("train boolean, n bigint, base double, known bigint, score double, h array<bigint>, tf array<bigint>").fields])


def _scored_by_broadcast(rows: DataFrame, model: Model, work: Workspace, part_bytes: int) -> DataFrame:
    spark, alpha, z, cuts = rows.sparkSession, model.alpha, model.z, _cuts(model.blocks)
    table, whole = spark.sparkContext.broadcast(model.frequent), spark.sparkContext.broadcast(model.filter())

    def look(batches):
        bits, begin, size = whole.value
        for batch in batches:
            for at, many in parts_of(batch.column(1), part_bytes):
                p = Part(batch.column(1).slice(at, many), table.value)
                block = np.searchsorted(cuts, p.keys, side="right")
                levels = levels_in(_within(p.keys, block, len(size)), bits, begin[block], size[block])
                score = Part.scores((p.keys, p.turn, p.rare, p.rare_at), p.codes, p.counts, levels, p.many, alpha, z)
                arrays = [batch.column(0).slice(at, many), batch.column(2).slice(at, many), pa.array(p.many), pa.array(p.base), pa.array(p.seen), pa.array(score), *p.others]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "train", "n", "base", "known", "score", "h", "tf"])

    return rows.mapInArrow(look, _result(rows.schema["doc_id"]))


def _scored_by_blocks(rows: DataFrame, model: Model, work: Workspace, part_bytes: int) -> DataFrame:
    """The same scores from a filter that is too large to broadcast: requests go to its blocks, levels come back."""
    spark, alpha, z, cuts, blocks = rows.sparkSession, model.alpha, model.z, _cuts(model.blocks), model.blocks
    table = spark.sparkContext.broadcast(model.frequent)
    result = _result(rows.schema["doc_id"])
    texts = StructType([f for f in result if f.name != "score"])
    blobs = ", ".join(f"{k} binary" for k in _KINDS)
    kind = StructType([*ddl("part bigint, at int, block int, keys binary, text boolean").fields, *texts.fields, *ddl(blobs).fields])

    def ask(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, many in parts_of(batch.column(1), part_bytes):
                p = Part(batch.column(1).slice(at, many), table.value)
                ends = np.concatenate([[0], np.searchsorted(p.keys, cuts), [len(p.keys)]])
                full = np.flatnonzero(np.diff(ends)).tolist()
                asked = len(full)
                packed = _within(p.keys, np.repeat(np.arange(len(ends) - 1), np.diff(ends)), blocks).astype("<u4")
                own = [batch.column(0).slice(at, many), batch.column(2).slice(at, many), pa.array(p.many), pa.array(p.base), pa.array(p.seen), *p.others]
                state = {k: pa.array([getattr(p, k).astype(v).tobytes()], pa.binary()) for k, v in _KINDS.items()}
                # requests, then a row for each text, the first of which carries the state of the part
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * asked, pa.int64()), pa.nulls(asked, pa.int32()), pa.array(full, pa.int32()), pa.array([packed[ends[b] : ends[b + 1]].tobytes() for b in full], pa.binary()), pa.array([False] * asked, pa.bool_()), *[pa.nulls(asked, x.type) for x in own], *[pa.nulls(asked, pa.binary())] * len(_KINDS)],
                    names=kind.names,
                )
                yield pa.RecordBatch.from_arrays([pa.array([number] * many, pa.int64()), pa.array(range(many), pa.int32()), pa.nulls(many, pa.int32()), pa.nulls(many, pa.binary()), pa.array([True] * many, pa.bool_()), *own, *[pa.concat_arrays([state[k], pa.nulls(many - 1, pa.binary())]) for k in _KINDS]], names=kind.names)
                number += 1

    # two folders, so that the requests can go when they are answered
    asked = work.save(rows.mapInArrow(ask, kind), "asked", partition_by=["text"])
    requests, parts = asked.where("text = 'false'").select("part", "block", "keys"), asked.where("text = 'true'").drop("block", "keys", "text")

    def answer(key, requests, blocks):
        if not len(requests):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int32()), pa.array([], pa.binary())], names=["part", "block", "levels"])
        bits = np.frombuffer(blocks.column("bits")[0].as_py() if len(blocks) else b"\0" * 8, np.uint8)  # a block without n-grams has no row
        size = np.uint64(8 * len(bits))
        sent = requests.column("keys").to_pylist()
        keys = np.frombuffer(b"".join(sent), "<u4").astype(np.uint64)
        levels = levels_in(keys, bits, np.zeros(len(keys), np.int64), np.full(len(keys), size)).tobytes()
        ends = np.cumsum([0, *[len(x) // 4 for x in sent]]).tolist()
        return pa.table([requests.column("part"), requests.column("block"), pa.array([levels[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())], names=["part", "block", "levels"])

    def finish(key, texts, levels):
        own = texts.sort_by("at")
        state = {k: np.frombuffer(own.column(k)[0].as_py(), kind) for k, kind in _KINDS.items()}
        got = sorted(zip(levels.column("block").to_pylist(), levels.column("levels").to_pylist(), strict=True))
        placed = Part.placed(*state.values())
        score = Part.scores(placed, state["codes"], state["counts"], np.frombuffer(b"".join(x for _, x in got), np.uint8), own.column("n").to_numpy(), alpha, z)
        return pa.table([own.column(k) if k != "score" else pa.array(score) for k in result.names], names=result.names)

    answers = requests.groupBy("block").cogroup(model.table.select("block", "bits").groupBy("block")).applyInArrow(answer, "part long, block int, levels binary")
    levels = work.save(answers, "levels")
    work.drop("asked/text=false")
    return parts.groupBy("part").cogroup(levels.groupBy("part")).applyInArrow(finish, result)


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
