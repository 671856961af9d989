"""Benchmark decontamination: a prefix-filtered set join of benchmark windows with whole documents.

Every benchmark item is cut into windows of ``window`` consecutive words (an item of fewer words is one
window); a window is the set of its ``shingle``-word shingles.  Shingles are ordered by rarity, that is by
the number of all documents that have them, counted over the whole table.  A document window that contains
a share ``containment`` of an item window's n shingles has at least one of its n - ceil(containment*n) + 1
rarest: only those necessary prefix shingles are looked up.  Each lookup fixes where an item-sized window of
the document may begin; those that do not fit in the document (length and positional bounds) are dropped and
the rest are verified word by word.

The benchmark is a stated query set.  It is processed in blocks of at most ``block_bytes`` of text (plus one
item), so what a worker holds has a bound that does not grow with it; with more than one block the state so far
is written to the shared folder between blocks.

Defined results: null or empty text has no words and no hits; a null item text has no windows; a null item_id is
written as the empty string; repeated item ids count once; repeated rows are judged each for itself; an empty
benchmark hits nothing; other columns are carried along untouched by :func:`decontaminate`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Workspace, fresh, table

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
BLOCK_BYTES = 4 << 20

#: Bytes to words: A-Z become a-z; digits, letters and everything beyond ASCII stay; the rest separates words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
STATE = "struct<n_words:bigint,hits:array<int>,items:array<string>>"


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


@dataclass
class Windows:
    """One block of the benchmark, before rarity is known."""

    vocab: dict[bytes, int]
    rows: list[tuple[int, ...]]  # distinct windows as word numbers
    items: list[list[str]]  # the items of each

    def codes(self, row: tuple[int, ...], shingle: int) -> tuple[int, list[int]]:
        """Shingle size used for this window, and the code of the shingle at each offset."""
        s = min(shingle, len(row))
        base = _base(len(self.vocab), s)
        powers = [pow(base, s - 1 - k, 1 << 64) for k in range(s)]
        return s, [_signed(sum(w * p for w, p in zip(row[i : i + s], powers, strict=True))) for i in range(len(row) - s + 1)]


def _signed(x: int) -> int:
    return (x + (1 << 63)) % (1 << 64) - (1 << 63)


def _base(vocab: int, size: int) -> int:
    """The base of shingle codes: the vocabulary's size where codes fit in 63 bits, else an odd number modulo 2**64.

    Codes then are hashes: equal shingles have equal codes, and occurrences are verified word by word anyway."""
    return vocab if vocab**size < 1 << 63 else 0x9E3779B97F4A7C15


def cut(items: list[tuple[str | None, str | None]], window: int) -> Windows:
    vocab: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set[str]] = {}
    for item, text in items:
        ids = tuple(vocab.setdefault(w, len(vocab)) for w in words_of(text))
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            found.setdefault(ids[i : i + window], set()).add(item or "")
    return Windows(vocab, list(found), [sorted(x) for x in found.values()])


def _positions(ids: np.ndarray, size: int, vocab: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose ``size`` words are all in the vocabulary, and the codes of those shingles."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    known = ids >= 0
    ok = known[:n].copy()
    for k in range(1, size):
        ok &= known[k : k + n]
    at = np.flatnonzero(ok)
    code, base = ids[at], np.int64(_signed(_base(vocab, size)))
    for k in range(1, size):
        code = code * base + ids[at + k]
    return at, code


def _find(sorted_codes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For the codes that are in ``sorted_codes``: where they stand in ``codes``, and where in ``sorted_codes``."""
    if not len(sorted_codes) or not len(codes):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)
    hit = np.flatnonzero(sorted_codes[at] == codes)
    return hit, at[hit]


def _word_ids(text: str | None, vocab: dict[bytes, int]) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(vocab.get, words, [-1] * len(words)), np.int64, len(words))


def _document_frequencies(docs: DataFrame, text: str, windows: Windows, shingle: int) -> dict[tuple[int, int], int]:
    """In how many documents each shingle of the block occurs, over all documents."""
    context = docs.sparkSession.sparkContext
    sizes: dict[int, set[int]] = {}
    for row in windows.rows:
        s, codes = windows.codes(row, shingle)
        sizes.setdefault(s, set()).update(codes)
    known = {s: np.array(sorted(c), np.int64) for s, c in sizes.items()}
    shared = context.broadcast((windows.vocab, known))

    def count(batches):
        vocab, known = shared.value
        totals = {s: np.zeros(len(c), np.int64) for s, c in known.items()}
        for batch in batches:
            for value in batch.column(0):
                ids = _word_ids(value.as_py(), vocab)
                for s, codes in known.items():
                    _, at = _find(codes, _positions(ids, s, len(vocab))[1])
                    totals[s][np.unique(at)] += 1
        for s, n in totals.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), s, np.int32)), pa.array(known[s][at]), pa.array(n[at])], names=["s", "code", "n"])

    rows = docs.select(text).mapInArrow(count, "s int, code long, n long").groupBy("s", "code").agg(F.sum("n").alias("n")).collect()
    return {(r["s"], r["code"]): r["n"] for r in rows}


@dataclass
class Index:
    """Necessary prefix shingles of one block: per shingle size, sorted codes and the (window, offset) pairs of each."""

    vocab: dict[bytes, int]
    flat: np.ndarray  # all windows' words, one after the other
    begins: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]
    prefix: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    containment: float
    shingle: int

    @staticmethod
    def build(windows: Windows, frequency: dict[tuple[int, int], int], shingle: int, containment: float) -> Index:
        pairs: dict[int, list[tuple[int, int, int]]] = {}
        for w, row in enumerate(windows.rows):
            s, codes = windows.codes(row, shingle)
            first = {}
            for offset, code in enumerate(codes):
                first.setdefault(code, offset)
            order = sorted(first, key=lambda code: (frequency.get((s, code), 0), code))
            for code in order[: len(order) - math.ceil(containment * len(order)) + 1]:
                pairs.setdefault(s, []).append((code, w, first[code]))
        prefix = {}
        for s, rows in pairs.items():
            table = np.array(sorted(rows), np.int64)
            codes, at = np.unique(table[:, 0], return_index=True)
            prefix[s] = (codes, np.append(at, len(table)), table[:, 1], table[:, 2])
        lengths = np.array([len(r) for r in windows.rows], np.int64)
        return Index(
            windows.vocab, np.array([w for r in windows.rows for w in r], np.int64), np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths,
            lengths, windows.items, prefix, containment, shingle,
        )

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begins in the document, and windows, of all verified occurrences."""
        starts, wins = [], []
        for s, (codes, bounds, of, offsets) in self.prefix.items():
            where, code = _positions(ids, s, len(self.vocab))
            hit, at = _find(codes, code)
            if not len(hit):
                continue
            many = bounds[at + 1] - bounds[at]
            rows = np.repeat(bounds[at] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            starts.append(np.repeat(where[hit], many) - (offsets[rows] if self.containment >= 1 else 0))
            wins.append(of[rows])
        if not starts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        begin, win = np.concatenate(starts), np.concatenate(wins)
        if self.containment < 1:
            return self._contained(ids, begin, win)
        fits = (begin >= 0) & (begin + self.lengths[win] <= len(ids))
        begin, win = begin[fits], win[fits]
        good = np.ones(len(begin), bool)
        for k in range(int(self.lengths[win].max()) if len(win) else 0):
            left = np.flatnonzero(good & (self.lengths[win] > k))
            good[left] = ids[begin[left] + k] == self.flat[self.begins[win[left]] + k]
        return begin[good], win[good]

    def _contained(self, ids: np.ndarray, position: np.ndarray, win: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Item-sized document windows around a prefix shingle that hold the asked share of the item's shingles."""
        found = set()
        for p, w in set(zip(position.tolist(), win.tolist(), strict=True)):
            size = int(self.lengths[w])
            row = self.flat[self.begins[w] : self.begins[w] + size]
            s = min(self.shingle, size)
            want = {tuple(row[i : i + s]) for i in range(size - s + 1)}
            for begin in range(max(0, p - (size - s)), min(p, len(ids) - size) + 1):
                have = {tuple(ids[i : i + s]) for i in range(begin, begin + size - s + 1)}
                if len(want & have) >= math.ceil(self.containment * len(want)):
                    found.add((begin, w))
        both = np.array(sorted(found), np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]

    def state(self, text: str | None, before: dict | None) -> dict:
        ids = _word_ids(text, self.vocab)
        begin, win = self.occurrences(ids) if self.prefix else (np.empty(0, np.int64), np.empty(0, np.int64))
        items = {x for w in np.unique(win).tolist() for x in self.items[w]}
        edges = np.zeros(len(ids) + 1, np.int64)
        np.add.at(edges, begin, 1)
        np.add.at(edges, begin + self.lengths[win] if len(win) else begin, -1)
        if before:
            items.update(before["items"])
            np.add.at(edges, np.array(before["hits"][0::2], np.int64), 1)
            np.add.at(edges, np.array(before["hits"][1::2], np.int64), -1)
        if not items:
            return {"n_words": len(ids), "hits": [], "items": []}
        turns = np.diff(np.concatenate([[0], (np.cumsum(edges) > 0).astype(np.int8)]))
        return {"n_words": len(ids), "hits": np.flatnonzero(turns).tolist(), "items": sorted(items)}


def with_hits(
    docs: DataFrame, benchmark: DataFrame, out: str, text: str = "text", window: int = WINDOW_WORDS, shingle: int = SHINGLE_WORDS,
    containment: float = 1.0, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct column ``out``: number of words, hit word ranges (begin, end, begin, end, ...), items."""
    spark = docs.sparkSession
    kind = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    work = Workspace(spark, "decontaminate") if blocks > 1 else None
    (before,) = fresh(docs, "before")
    frame = docs
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        windows = cut([(r["item"], r["text"]) for r in mine.toLocalIterator()], window)
        index = spark.sparkContext.broadcast(Index.build(windows, _document_frequencies(docs, text, windows, shingle), shingle, containment))

        def scan(texts, *state, index=index):
            held = index.value
            earlier = state[0].to_pylist() if state else [None] * len(texts)
            return pa.array([held.state(t.as_py(), e) for t, e in zip(texts, earlier, strict=True)], kind)

        if block:
            scan_next = F.arrow_udf(lambda t, e, scan=scan: scan(t, e), STATE)
            frame = frame.withColumnRenamed(out, before).withColumn(out, scan_next(F.col(text), F.col(before))).drop(before)
        else:
            scan_first = F.arrow_udf(lambda t, scan=scan: scan(t), STATE)
            frame = frame.withColumn(out, scan_first(F.col(text)))
        if blocks > 1:
            frame = work.save(frame, f"block{block}", codec="snappy")
            if block:
                work.drop(f"block{block - 1}")
    return frame


def hit_words(state: Column) -> Column:
    return F.aggregate(state["hits"], F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("sign")), lambda a, x: F.struct((a["n"] + a["sign"] * x).alias("n"), (-a["sign"]).alias("sign")), lambda a: a["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``docs``."""
    frame = with_hits(docs.select("doc_id", "text"), benchmark, "s", **how)
    s = F.col("s")
    return frame.select("doc_id", "s").select(
        "doc_id", s["n_words"].alias("n_words"), hit_words(s).alias("n_hit"), F.size(s["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(s["items"]), ",").cast("binary"), 256).alias("items_sha256"), (F.size(s["hits"]) > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, with the columns of ``docs``."""
    (state,) = fresh(docs, "state")
    return with_hits(docs, benchmark, state, **how).where(F.size(F.col(state)["hits"]) == 0).select(*docs.columns)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_SQL_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP2_SQL = f"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_SQL_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item, w[k:k + 9] AS win FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM iw),
dw AS (SELECT doc_id, k, n, w[k:k + n - 1] AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes)),
m AS (SELECT dw.doc_id, dw.k, dw.n, iw.item FROM dw JOIN iw ON dw.win = iw.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM m) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""
