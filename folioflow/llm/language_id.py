"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +-1 in ``DIM`` dimensions.  A letter n-gram is bound as the product of
its letters' vectors, each rotated by its place; a text is bundled as the sum of its n-grams' vectors, and a
language's prototype as the sum over all its training texts, every document of the training folds included.
The common direction of all languages is taken out, and a text is given the language of the highest cosine.

Bundling is linear, so the sums over documents are made of n-gram counts: a task adds up the vectors of its texts
by language and passes on one vector for each language, which makes hot languages as cheap as others.  Languages
number in the hundreds; ``MAX_LANGUAGES`` prototypes are the proven bound of the broadcast (16 MB) and more of them
are an error.

Defined results: null text and text without a letter give ``und`` with score 0; without training rows every text
does; a null lang is not learned from; ties go to the language of the lower code points; texts shorter than an n-gram
are padded by word boundaries, so any letter has n-grams; repeated rows count as often as they stand there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import table

DIM = 512
ORDER = 3
SEED = 1789
MAX_LANGUAGES = 8192
#: Letters are told apart by code point modulo this prime; number 0 is the word boundary.
ALPHABET = 1021
#: Share of the score's slope: cosine differences of this size move the score from even to about three to one.
SHARPNESS = 0.05
_LETTER = regex.compile(r"\p{L}")


class Space:
    """The random vectors, and bundling of texts into them."""

    def __init__(self, dim: int = DIM, order: int = ORDER, seed: int = SEED):
        rng = np.random.default_rng(seed)
        letters = rng.integers(0, 2, (ALPHABET + 1, dim), dtype=np.int8) * 2 - 1
        self.order, self.dim = order, dim
        self.rotated = [np.roll(letters, order - 1 - k, axis=1) for k in range(order)]
        #: n-gram vectors met so far, by number
        self.known: dict[int, int] = {}
        self.vectors = np.zeros((0, dim), np.float32)
        table_ = np.zeros(0x110000, np.int32)
        for cp in range(0x250):
            c = chr(cp)
            if _LETTER.match(c):
                table_[cp] = 1 + ord(c.lower()[0]) % ALPHABET
        for cp in range(0x250, 0x110000):
            if not 0xD800 <= cp < 0xE000:
                c = chr(cp)
                if c.isalpha():
                    table_[cp] = 1 + ord(c.lower()[0]) % ALPHABET
        self.table = table_

    def grams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams (numbers) of the text and their counts; empty if it has no letter."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        codes = self.table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        if not codes.any():
            return none, none
        codes = np.concatenate([[0], codes, [0]])
        letter = codes > 0
        keep = letter | np.concatenate([[True], letter[:-1]])  # runs of other characters become one boundary
        codes = np.pad(codes[keep].astype(np.int64), (0, max(0, self.order - int(keep.sum()))))
        n = len(codes) - self.order + 1
        numbers = np.zeros(n, np.int64)
        for k in range(self.order):
            numbers = numbers * (ALPHABET + 1) + codes[k : k + n]
        return np.unique(numbers, return_counts=True)

    def _rows(self, numbers: np.ndarray) -> np.ndarray:
        try:
            return np.fromiter(map(self.known.__getitem__, numbers.tolist()), np.int64, len(numbers))
        except KeyError:
            new = np.array([x for x in numbers.tolist() if x not in self.known], np.int64)
            if len(self.known) + len(new) > 60_000:  # bounded memory: forget and begin anew
                self.known, self.vectors, new = {}, np.zeros((0, self.dim), np.float32), numbers
            bound, rest = np.ones((len(new), self.dim), np.int8), new.copy()
            for k in range(self.order - 1, -1, -1):
                bound *= self.rotated[k][rest % (ALPHABET + 1)]
                rest //= ALPHABET + 1
            self.known.update(zip(new.tolist(), range(len(self.vectors), len(self.vectors) + len(new)), strict=True))
            self.vectors = np.concatenate([self.vectors, bound.astype(np.float32)])
            return self._rows(numbers)

    def bundle(self, text: str | None) -> np.ndarray | None:
        """The text's vector, or None without a letter."""
        numbers, counts = self.grams(text)
        if not len(numbers):
            return None
        out = np.zeros(self.dim, np.float32)
        for at in range(0, len(numbers), 20_000):
            part = numbers[at : at + 20_000]
            rows = self._rows(part)  # may extend the vectors
            out += counts[at : at + 20_000].astype(np.float32) @ self.vectors[rows]
        return out


_SPACES: dict[tuple, Space] = {}


def space(*key) -> Space:
    if key not in _SPACES:  # a worker keeps it from task to task
        _SPACES[key] = Space(*key)
    return _SPACES[key]


def held_out(doc_id: Column, folds: int = 3) -> Column:
    """Whether the document is kept from learning: crc32 of its id as text, modulo ``folds``, is 1 (null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 1, F.lit(False))


def learn(rows: DataFrame, dim: int = DIM, order: int = ORDER, seed: int = SEED) -> tuple[list[str], np.ndarray]:
    """Languages in code-point order and their prototypes, from columns text and lang of ``rows``."""

    def add(batches):
        own, sums = space(dim, order, seed), {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                numbers, counts = own.grams(text.as_py())
                if len(numbers):
                    held = sums.setdefault(lang, {})
                    for g, n in zip(numbers.tolist(), counts.tolist(), strict=True):
                        held[g] = held.get(g, 0) + n
                    if len(held) > 200_000:
                        yield _bundled(own, lang, sums.pop(lang))
        for lang, held in sums.items():
            yield _bundled(own, lang, held)

    def _bundled(own, lang, held):
        total = np.zeros(own.dim, np.float64)
        numbers = np.array(list(held), np.int64)
        counts = np.array(list(held.values()), np.float64)
        for at in range(0, len(numbers), 20_000):
            rows = own._rows(numbers[at : at + 20_000])
            total += counts[at : at + 20_000] @ own.vectors[rows]
        return pa.RecordBatch.from_arrays([pa.array([lang] * own.dim), pa.array(np.arange(own.dim, dtype=np.int32)), pa.array(total)], names=["lang", "d", "v"])

    taught = rows.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    sums = taught.mapInArrow(add, "lang string, d int, v double").groupBy("lang", "d").agg(F.sum("v").alias("v"))
    found = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("d", "v"))).alias("v")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not found:
        return [], np.zeros((0, dim), np.float32)
    protos = np.array([[x["v"] for x in r["v"]] for r in found])
    protos /= np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-12)
    return [r["lang"] for r in found], protos


def with_language(docs: DataFrame, langs: list[str], protos: np.ndarray, out: str, text: str = "text", dim: int = DIM, order: int = ORDER, seed: int = SEED) -> DataFrame:
    """Adds a struct ``out`` of lang and score (a softmax over the centred cosines, 0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast((langs, protos))
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def predict(texts):
        langs, protos = shared.value
        own = space(dim, order, seed)
        common = protos.mean(0) if len(langs) > 1 else np.zeros(dim)
        base = protos - common
        base = base / np.maximum(np.linalg.norm(base, axis=1, keepdims=True), 1e-12)
        found = []
        for value in texts:
            v = own.bundle(value.as_py()) if langs else None
            if v is None:
                found.append({"lang": "und", "score": 0.0})
                continue
            v = v / max(float(np.linalg.norm(v)), 1e-12)
            v = v - common * float(v @ common) / max(float(common @ common), 1e-12)
            cosine = base @ v / max(float(np.linalg.norm(v)), 1e-12)
            best = int(cosine.argmax())
            found.append({"lang": langs[best], "score": float(1 / np.exp((cosine - cosine[best]) / SHARPNESS).sum())})
        return pa.array(found, kind)

    return docs.withColumn(out, F.arrow_udf(predict, "struct<lang:string,score:double>")(F.col(text)))


def identify(docs: DataFrame, **how) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``; learned from the rows that are not held out."""
    rows = docs.select("doc_id", "text", "lang").withColumn("held", held_out(F.col("doc_id")))
    langs, protos = learn(rows.where("NOT held"), **how)
    done = with_language(rows.select("doc_id", "text", "held"), langs, protos, "p", **how)
    return done.select("doc_id", F.col("held").alias("held_out"), F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
