"""Token ids and their binary files: range asymmetric numeral systems with one shared static table.

Writing takes two passes.  Texts are tokenised once, to 16-bit ids (32-bit for larger vocabularies) in the shared
folder, and counted as they are; the counts are scaled to the table; then documents are ordered by id over range
partitions and encoded.

File format: two Parquet tables, written by Spark's own committer (a lost task leaves nothing behind): ``table``, one row
with the scaled frequencies and the block settings, and ``chunks``, a row for each chunk of whole documents.  A chunk holds its documents' ids and lengths, and
independent blocks of ``BLOCK`` symbols.  Symbol j of a block belongs to lane j % ``LANES``; lanes share one
stream of 32-bit words.  Every ``CHECKPOINT`` rows of a block the lanes' states and the place in the stream are
kept, so a decoder can begin at any checkpoint, and all of them are decoded side by side.  Each chunk carries
a CRC-32 of its words and one of its decoded ids; a mismatch is an error.

Coding step, for a symbol of scaled frequency f and cumulative frequency c, with frequencies summing to 2**SCALE:
encode x -> (x // f << SCALE) + x % f + c, after moving 32 bits to the stream if x >= f << (63 - SCALE);
decode x -> f * (x >> SCALE) + (x & mask) - c, then taking 32 bits if x < 2**31.

Defined results: null and empty texts have the end id alone; a null doc_id sorts before all others; rows of equal
doc_id stand in the order of a hash of their ids; repeated rows stay repeated; an empty table writes no chunk.
"""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from ._common import Workspace, partitions_for, parts_of, table

END_ID = 1
SCALE = 20
LANES = 256
BLOCK = 1 << 17
CHECKPOINT = 256
CHUNK_IDS = 1 << 20
#: Bytes of cached words in a worker, and of text that is encoded together.
CACHE_BYTES = 192 << 20
PART_BYTES = 4 << 20
_ENTRY_BYTES = 150  # of two small objects and a place in a dictionary
_END_WORD = "\n"  # no piece can be this
_LOW = np.uint64(1 << 31)
#: Marks (no apostrophe) at the end of a word, after an ASCII letter.
_MARKS = re.compile(r"(?<=[a-z])[!-&(-/:-@\[-`{-~]+\Z")
#: Letters whose lower-case form is one letter and the same with or without composition: ASCII and Latin-1.
_PLAIN = re.compile("[a-zA-Z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies, the space left as it is."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + k) for k, b in enumerate(hidden) if b != 32}


_BYTE_LEVEL = _alphabet()


class WordCache:
    """Ids of the pieces of a text between ASCII white space.

    A tokenizer that drops white space before it merges gives such a piece the same ids wherever it stands.  One that
    also lower-cases, and parts letters from what follows them, lets A-Z be lowered and the marks at the end of a word be
    parted from it before the look-up.  Whether a tokenizer is of this form is read from its own description; any other
    one encodes each text whole.  Texts in which lowering could matter (strings of special tokens, or marks that
    combine with the letter before) are not lowered.

    Words of a batch are told apart by Arrow, so Python sees each distinct word of a batch once.  New words are encoded
    together.  The cache is emptied when its entries come to ``limit`` bytes.
    """

    def __init__(self, path: str, limit: int = CACHE_BYTES):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max([self.size, END_ID + 1, *(i + 1 for i in vocab.values())])
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.limit = limit
        form = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in form.get("added_tokens", [])]
        steps = (form.get("normalizer") or {}).get("normalizers", [])
        cuts = (form.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_word = (
            [x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"]
            and steps[1]["pattern"] == {"Regex": r"\s+"}
            and [x["type"] for x in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["pattern"] == {"Regex": _SPLIT}
            and (cuts[0]["behavior"], cuts[0]["invert"]) == ("Removed", True)
            and not (cuts[1]["add_prefix_space"] or cuts[1]["use_regex"])
            and form["model"]["end_of_word_suffix"] == "</w>"
            and form["post_processor"] is None
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or any(map(str.isspace, t["content"])) for t in form["added_tokens"])
        )
        self.ends = np.zeros(self.size, bool)  # ids that end a word
        self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        if self.by_word:  # the same merges over words that are cut and mapped already
            self.bare = Tokenizer(self.tokenizer.model)
            self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self._empty()

    def _empty(self) -> None:
        self.ids: dict[str, bytes] = {"": b"", _END_WORD: np.array([END_ID], self.kind).tobytes()}
        self.held = 0

    def learn(self, words: list[str]) -> None:
        """Adds the ids of new words, the marks at their ends parted."""
        cuts = {}
        for w in words:
            at = _MARKS.search(w) if "<|" not in w else None
            cuts[w] = (w[: at.start()], w[at.start() :]) if at else (w, "")
        new = {p for both in cuts.values() for p in both if p not in self.ids}
        plain = [p for p in new if _PLAIN.fullmatch(p)]
        for at in range(0, len(plain), 8192):
            part = plain[at : at + 8192]
            mapped = " ".join(part).lower().encode().decode("latin-1").translate(_BYTE_LEVEL)
            ids = np.array(self.bare.encode_batch_fast([mapped], add_special_tokens=False)[0].ids, self.kind)
            self._keep(part, ids, (np.flatnonzero(self.ends[ids]) + 1).tolist())
        self._by_offsets(sorted(new.difference(plain)))
        for w, (stem, marks) in cuts.items():
            if marks:
                self._put(w, self.ids[stem] + self.ids[marks])

    def _by_offsets(self, words: list[str]) -> None:
        for at in range(0, len(words), 8192):
            part = words[at : at + 8192]
            ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
            got = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            begins = np.fromiter((a for a, _ in got.offsets), np.int64, len(got.offsets))
            self._keep(part, np.array(got.ids, self.kind), np.searchsorted(begins, ends).tolist())

    def _keep(self, words: list[str], ids: np.ndarray, cuts: list[int]) -> None:
        size, raw, low = self.kind.itemsize, ids.tobytes(), 0
        for word, high in zip(words, cuts, strict=True):
            self._put(word, raw[low * size : high * size])
            low = high

    def _put(self, word: str, ids: bytes) -> None:
        self.ids[word] = ids
        self.held += _ENTRY_BYTES + 2 * len(word) + len(ids)

    def _lowered(self, texts: pa.StringArray) -> pa.StringArray:
        low = pc.ascii_lower(texts)
        keep = [pc.match_substring(low, t.lower()) for t in self.special]
        data = texts.buffers()[2]
        if data is not None and ((np.frombuffer(data, np.uint8) & 0xFE) == 0xCC).any():  # U+0300 to U+037F
            keep.append(pc.match_substring_regex(texts, "[A-Z][\u0300-\u036f]"))
        for k in keep:
            if pc.any(k).as_py():
                low = pc.if_else(k, texts, low)
        return low

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, end ids included, and how many each text has."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            got = [np.array([*e.ids, END_ID], self.kind) for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.concatenate(got), np.fromiter(map(len, got), np.int64, len(got))
        pieces = pc.ascii_split_whitespace(self._lowered(texts))
        coded = pieces.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if self.held > self.limit:
            self._empty()
        new = [w for w in words if w not in self.ids]
        if new:
            self.learn(new)
        words.append(_END_WORD)
        ids = [*map(self.ids.__getitem__, words)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        flat = np.frombuffer(b"".join(ids), self.kind)
        many = pieces.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.insert(coded.indices.to_numpy(zero_copy_only=False), np.cumsum(many), len(words) - 1)
        widths = sizes[order]
        ends = np.cumsum(widths)
        begins = (np.cumsum(sizes) - sizes)[order] - (ends - widths)
        out = flat[np.repeat(begins, widths) + np.arange(ends[-1])]
        last = ends[np.cumsum(many + 1) - 1]
        return out, np.diff(last, prepend=0)


_CACHES: dict[str, WordCache] = {}


def cache_of(path: str) -> WordCache:
    """The worker's own cache.  Of the module, so that it lives on from task to task: what a shipped function
    names is copied with it."""
    if path not in _CACHES:
        _CACHES[path] = WordCache(path)
    return _CACHES[path]


def tokenise(docs: DataFrame, path: str, work: Workspace) -> tuple[DataFrame, np.ndarray, int]:
    """doc_id, ids (binary), tie (a hash of the ids), written to the work folder; how often each id occurs in all
    documents; the bytes of an id.  Each task counts its own ids and writes the counts as one more row, which has no ids."""

    def run(batches):
        cache = cache_of(path)
        counts, key = np.zeros(cache.size, np.int64), None
        for batch in batches:
            key = batch.column(0).type
            for begin, many in parts_of(batch.column(1), PART_BYTES):
                ids, sizes = cache.encode(batch.column(1).slice(begin, many))
                counts += np.bincount(ids, minlength=cache.size)
                at = np.concatenate([[0], np.cumsum(sizes * cache.kind.itemsize)])
                if at[-1] >= 1 << 31:
                    raise ValueError("the ids of one text do not fit in 2 GB")
                column = pa.Array.from_buffers(pa.binary(), many, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, many), column, pa.nulls(many, pa.binary())], names=["doc_id", "ids", "counts"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, key), pa.nulls(1, pa.binary()), pa.array([counts.astype("<i8").tobytes()], pa.binary())], names=["doc_id", "ids", "counts"])

    key = StructField("doc_id", docs.schema["doc_id"].dataType)
    coded = docs.select("doc_id", "text").mapInArrow(run, StructType([key, StructField("ids", BinaryType()), StructField("counts", BinaryType())]))
    table = work.save(coded.withColumn("tie", F.xxhash64("ids")), "ids")

    def unpacked(batches):
        for batch in batches:
            total = sum(np.frombuffer(c.as_buffer(), "<i8") for c in batch.column(0))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.atleast_1d(total)[at])], names=["id", "n"])

    rows = table.where("ids IS NULL").select("counts").mapInArrow(unpacked, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # a row for each id of the vocabulary
    counts = np.zeros(max([r["id"] for r in rows], default=0) + 1, np.int64)
    for r in rows:
        counts[r["id"]] = r["n"]
    return table.where("ids IS NOT NULL").select("doc_id", "ids", "tie"), counts, WordCache(path).kind.itemsize


def scaled(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies of a sum of 2**scale, at least 1 for every id that occurs."""
    seen = np.flatnonzero(counts)
    total, full = int(counts.sum()), 1 << scale
    out = np.zeros(len(counts), np.int64)
    if not len(seen):
        return out
    if len(seen) > full:
        raise ValueError(f"{len(seen)} distinct ids do not fit in a table of {full}")
    out[seen] = np.maximum(1, (counts[seen].astype(np.float64) * (full / total)).astype(np.int64))
    order = seen[np.argsort(-counts[seen], kind="stable")]
    over = int(out.sum()) - full
    k = 0
    while over:  # the most frequent ids give or take what rounding left
        i = order[k % len(order)]
        step = min(over, int(out[i]) - 1, max(1, int(out[i]) // 8)) if over > 0 else over
        out[i] -= step
        over -= step
        k += 1
    return out


@dataclass
class Table:
    """Scaled frequencies, cumulative frequencies and the symbol of each slot."""

    freq: np.ndarray
    cum: np.ndarray
    slot: np.ndarray

    @staticmethod
    def of(freq: np.ndarray) -> Table:
        return Table(freq.astype(np.uint64), (np.cumsum(freq) - freq).astype(np.uint64), np.repeat(np.arange(len(freq), dtype=np.uint32), freq))


def encode(ids: np.ndarray, t: Table) -> dict:
    """Blocks of one chunk: words, and for each checkpoint its place in the words and the lanes' states."""
    rows = BLOCK // LANES
    blocks = -(-len(ids) // BLOCK)
    padded = np.full(blocks * BLOCK, int(t.freq.argmax()), np.int64)  # the cheapest id fills up the last block
    padded[: len(ids)] = ids
    grid = padded.reshape(blocks, rows, LANES)
    state = np.full((blocks, LANES), _LOW, np.uint64)
    last_rows = rows if blocks > 1 else max(1, -(-len(ids) // LANES))
    words, owners, marks = [], [], {}
    shift = np.uint64(63 - SCALE)
    for r in range(last_rows - 1, -1, -1):
        s = grid[:, r]
        f, c = t.freq[s], t.cum[s]
        out = state >= f << shift
        words.append((state[out] & np.uint64(0xFFFFFFFF)).astype(np.uint32))
        owners.append(np.nonzero(out)[0].astype(np.int32))
        state = np.where(out, state >> np.uint64(32), state)
        q = state // f
        state = (q << np.uint64(SCALE)) + (state - q * f) + c
        if r % CHECKPOINT == 0:
            marks[r] = (state.copy(), len(words))
    # the decoder reads rows upwards
    many = np.array([np.bincount(o, minlength=blocks) for o in owners[::-1]], np.int64).reshape(last_rows, blocks)
    flat, owner = np.concatenate(words[::-1]), np.concatenate(owners[::-1])
    stream = flat[np.argsort(owner, kind="stable")]
    base = np.concatenate([[0], np.cumsum(many.sum(0))[:-1]])
    ahead = np.concatenate([np.zeros((1, blocks), np.int64), np.cumsum(many, 0)])
    points = sorted(marks)
    return {
        "words": stream.astype("<u4").tobytes(),
        "states": np.stack([marks[r][0] for r in points], 1).astype("<u8").tobytes(),
        "places": np.stack([base + ahead[r] for r in points], 1).ravel().tolist(),
        "n": len(ids),
        "words_crc": zlib.crc32(stream.astype("<u4").tobytes()),
        "ids_crc": zlib.crc32(ids.astype("<u4").tobytes()),
    }


def decode(chunk: dict, t: Table) -> np.ndarray:
    """The ids of a chunk; all checkpoints of all blocks step together."""
    n = chunk["n"]
    if zlib.crc32(chunk["words"]) != chunk["words_crc"]:
        raise ValueError("a chunk's words do not match their checksum")
    words = np.frombuffer(chunk["words"], "<u4")
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint32)
    rows = BLOCK // LANES if blocks > 1 else max(1, -(-n // LANES))
    points = -(-rows // CHECKPOINT)
    state = np.frombuffer(chunk["states"], "<u8").reshape(blocks * points, LANES).copy()
    place = np.array(chunk["places"], np.int64)
    out = np.zeros((blocks * points, CHECKPOINT, LANES), np.uint32)
    mask = np.uint64((1 << SCALE) - 1)
    live = np.minimum(CHECKPOINT, rows - CHECKPOINT * (np.arange(blocks * points) % points))
    for r in range(int(live.max())):
        if int(live.min()) <= r:  # only the last checkpoint of a single block is short
            keep = live > r
            part = _step(state[keep], place[keep], words, t, mask)
            out[keep, r], state[keep], place[keep] = part
        else:
            out[:, r], state, place = _step(state, place, words, t, mask)
    got = out.reshape(blocks, points * CHECKPOINT * LANES)[:, : max(rows * LANES, 1)].ravel()[:n]
    if zlib.crc32(got.astype("<u4").tobytes()) != chunk["ids_crc"]:
        raise ValueError("a chunk's ids do not match their checksum")
    return got


def _step(state, place, words, t, mask):
    slot = state & mask
    s = t.slot[slot]
    state = t.freq[s] * (state >> np.uint64(SCALE)) + slot - t.cum[s]
    low = state < _LOW
    rank = np.cumsum(low, 1)
    at = (place[:, None] + rank - 1)[low]
    state[low] = state[low] << np.uint64(32) | words[at]
    return s, state, place + rank[:, -1]


def _chunk_type(key) -> StructType:
    many = ArrayType(LongType())
    kinds = [("docs", ArrayType(key)), ("lengths", many), ("n", LongType()), ("words", BinaryType()), ("states", BinaryType()), ("places", many), ("words_crc", LongType()), ("ids_crc", LongType())]
    return StructType([StructField(k, kind) for k, kind in kinds])


def write_files(docs: DataFrame, path: str, out: str, work: Workspace) -> None:
    """Writes the ids of all documents below ``out`` in ascending doc_id order: the chunks, and the table that decodes them."""
    spark = docs.sparkSession
    ids, counts, width = tokenise(docs, path, work)
    freq = scaled(counts)
    shared = spark.sparkContext.broadcast(freq)  # at most as long as the vocabulary
    kind = _chunk_type(docs.schema["doc_id"].dataType)

    def chunks(batches):
        t = Table.of(shared.value)
        held, keys, size = [], [], 0

        def flush():
            lengths = np.fromiter(map(len, held), np.int64, len(held))
            return {"docs": pa.concat_arrays(keys), "lengths": lengths, **encode(np.concatenate(held), t)}

        for batch in batches:
            rows, column = [], batch.column(1)
            ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
            # the ids of all rows lie next to each other
            flat = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].copy().view(f"<u{width}")
            ends = (ends - ends[0]) // width
            begin = 0
            while begin < len(column):
                end = min(len(column), int(np.searchsorted(ends, ends[begin] + CHUNK_IDS - size)))
                end = max(end, begin + 1)
                held += np.split(flat[ends[begin] : ends[end]], ends[begin + 1 : end] - ends[begin])
                keys.append(batch.column(0).slice(begin, end - begin))
                size += int(ends[end] - ends[begin])
                if size >= CHUNK_IDS:
                    rows.append(flush())
                    held, keys, size = [], [], 0
                begin = end
            if rows:
                yield _batch(rows, kind)
        if held:
            yield _batch([flush()], kind)

    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]
    parts = partitions_for(spark, int(counts.sum()) * width, 32 << 20)
    ordered = ids.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    coded = ordered.select("doc_id", "ids").mapInArrow(chunks, kind)
    coded = coded.select(F.monotonically_increasing_id().alias("seq"), "*")
    coded.write.mode("overwrite").option("compression", "none").parquet(f"{out}/chunks")
    header = spark.createDataFrame([(SCALE, LANES, BLOCK, CHECKPOINT, freq.tolist())], "scale int, lanes int, block int, checkpoint int, freq array<bigint>")
    header.coalesce(1).write.mode("overwrite").parquet(f"{out}/table")


def _batch(rows: list[dict], kind: StructType) -> pa.RecordBatch:
    arrays = []
    for f in kind:
        if f.name == "docs":
            values = pa.concat_arrays([r["docs"] for r in rows])
            ends = np.cumsum([0, *[len(r["docs"]) for r in rows]])
            arrays.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values))
        else:
            arrays.append(pa.array([r[f.name] for r in rows], to_arrow_type(f.dataType)))
    return pa.RecordBatch.from_arrays(arrays, names=kind.names)


def read_files(spark: SparkSession, out: str, digest: bool = True) -> DataFrame:
    """Documents from the files alone: doc_id, start, n_tokens and ids_crc32, or with ``digest`` False the ids."""
    header = spark.read.parquet(f"{out}/table").first()
    if (header["scale"], header["lanes"], header["block"], header["checkpoint"]) != (SCALE, LANES, BLOCK, CHECKPOINT):
        raise ValueError("the files were written with other block settings")
    shared = spark.sparkContext.broadcast(np.array(header["freq"], np.int64))
    coded = spark.read.parquet(f"{out}/chunks")
    key = coded.schema["docs"].dataType.elementType

    def documents(batches):
        t = Table.of(shared.value)
        for batch in batches:
            docs, chunks = batch.column("docs"), batch.drop_columns(["docs", "lengths"]).to_pylist()
            for at, row in enumerate(chunks):
                ids = decode(row, t).astype("<u4")
                lengths = batch.column("lengths")[at].values.to_numpy()
                ends = np.cumsum(lengths)
                begins = ends - lengths
                parts = (ids[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True))
                last = pa.array([zlib.crc32(p) for p in parts], pa.int64()) if digest else pa.array([p.tolist() for p in parts], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(lengths), row["seq"])), docs[at].values, pa.array(begins), pa.array(lengths), last],
                    names=["seq", "doc_id", "within", "n_tokens", "last"],
                )

    last = LongType() if digest else ArrayType(LongType())
    kinds = [("seq", LongType()), ("doc_id", key), ("within", LongType()), ("n_tokens", LongType()), ("last", last)]
    rows = coded.select("seq", "docs", "lengths", "n", "words", "states", "places", "words_crc", "ids_crc").mapInArrow(documents, StructType([StructField(k, kind) for k, kind in kinds]))
    # partitions are in doc_id order and chunk numbers ascend in each, so chunk numbers give the order of all
    upto = Window.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    begin = coded.select("seq", "n").select("seq", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("begin"))
    begin = F.broadcast(begin) if coded.count() <= 200_000 else begin  # 16 bytes for each million ids
    name = "ids_crc32" if digest else "ids"
    return rows.join(begin, "seq").select("doc_id", (F.col("begin") + F.col("within")).alias("start"), "n_tokens", F.col("last").alias(name))


def encode_corpus(docs: DataFrame, path: str, digest: bool = True) -> DataFrame:
    """Tokenises, writes the files, and returns what reading them back gives."""
    work = Workspace(docs.sparkSession, "token-ids")
    out = f"{work.root}/files"
    write_files(docs, path, out, work)
    work.drop("ids")
    return read_files(docs.sparkSession, out, digest)


def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_corpus(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
