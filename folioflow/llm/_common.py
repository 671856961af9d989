"""Helpers shared by the corpus operators: the shared work folder, fresh column names, table readers."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that end a word in the white-space tokenisation (code points 09-0D and 20).
SPACE_CLASS = r"[\x20\x09-\x0D]+"
#: Lower-cases A-Z in UTF-8 bytes and leaves every other byte as it is.
LOWER_AZ = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

#: Lets a write's shuffle files go when it has ended, not when the driver happens to collect its garbage.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables; Spark's own reader, so any store that Spark knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share.

    It is ``spark.checkpoint.dir`` of the session.  Only where that is unset on a local master (tests) a
    temporary folder is made and set as the checkpoint folder of the context; on a cluster it must be set.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="folioflow-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


class Workspace:
    """Intermediate tables, written as Parquet below the shared folder.

    A written table cuts the lineage and survives the loss of any executor.  Tables go when
    :meth:`drop` is called, or when the driver's Python ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def save(self, frame: DataFrame, name: str, codec: str = "zstd", partition_by: list[str] | None = None) -> DataFrame:
        path = f"{self.root}/{name}"
        before = self.spark.conf.get(_CLEAN_UP, "false")
        self.spark.conf.set(_CLEAN_UP, "true")  # the written table stands for the frame from here on
        try:
            writer = frame.write.mode("overwrite").option("compression", codec)
            (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        finally:
            self.spark.conf.set(_CLEAN_UP, before)
        return self.load(name, frame.schema if not partition_by else None)

    def load(self, name: str, schema=None) -> DataFrame:
        reader = self.spark.read
        return (reader.schema(schema) if schema is not None else reader).parquet(f"{self.root}/{name}")

    def drop(self, name: str = "") -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001  the session has ended: the cluster's own clean-up takes over
            if name:
                raise


def fresh(frame: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that the frame does not have (compared without case)."""
    taken = {c.lower() for c in frame.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def partitions_for(spark: SparkSession, nbytes: int, target: int = 64 << 20) -> int:
    """Partitions of about ``target`` bytes, at least the session's own number of shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-nbytes // target))


def parts_of(texts: pa.Array, limit: int):
    """Slices (begin, length) of a batch with about ``limit`` bytes of text each, one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(texts):
        base = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield begin, end - begin
        begin = end


def word_codes(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words (A-Z lowered, cut at white space) of some texts, the number of each word in text order, and how many words each
    text has; a null text has none."""
    pieces = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = pieces.flatten().dictionary_encode()
    words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    many = pieces.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if "" in words:  # white space at the ends of a text
        void = words.index("")
        keep = codes != void
        upto, ends = np.concatenate([[0], np.cumsum(keep)]), np.cumsum(many)
        many = upto[ends] - upto[ends - many]
        codes = codes[keep]
        codes -= codes > void
        words.pop(void)
    return words, codes, many


def bound(value: Column, f) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` names it."""
    return F.transform(F.array(value), lambda x: f(x))[0]


#: Matches whose places are summed up together: arrays that grow an element at a time stay this short.
_MATCHES = 256


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (s, e, v) of all matches, in code points: the pieces between matches give the places; ``v`` is what the group matched.

    Places are summed up within runs of matches, then over the runs, so the time is near linear in their number.
    """
    kind = "array<struct<s:int,e:int,v:string>>"
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.struct(whole.alias("m"), (F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole).alias("v"), F.split(text, pattern).alias("g"))

    def grown(a: Column, x: Column) -> Column:
        begin = a["at"] + F.length(x["g"])
        end = begin + F.length(x["m"])
        return F.struct(end.alias("at"), F.array_append(a["out"], F.struct(begin.alias("s"), end.alias("e"), x["v"].alias("v"))).alias("out"))

    def run(pieces: Column) -> Column:
        return F.aggregate(pieces, F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")), grown)

    def joined(runs: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<from:int,spans:{kind}>>").alias("out"))
        placed = F.aggregate(runs, start, lambda a, x: F.struct((a["at"] + x["at"]).alias("at"), F.array_append(a["out"], F.struct(a["at"].alias("from"), x["out"].alias("spans"))).alias("out")), lambda a: a["out"])
        return F.flatten(F.transform(placed, lambda p: F.transform(p["spans"], lambda x: F.struct((x["s"] + p["from"]).alias("s"), (x["e"] + p["from"]).alias("e"), x["v"].alias("v")))))

    def placed(x: Column) -> Column:
        pieces = F.arrays_zip(x["m"].alias("m"), x["v"].alias("v"), F.slice(x["g"], 1, F.size(x["m"])).alias("g"))
        cut = bound(pieces, lambda p: F.transform(F.sequence(F.lit(0), F.size(p) - 1, F.lit(_MATCHES)), lambda h: F.slice(p, h + 1, F.lit(_MATCHES))))
        return F.when(F.size(x["m"]) > 0, joined(F.transform(cut, lambda c: run(c)))).otherwise(F.array().cast(kind))

    return bound(found, placed)
