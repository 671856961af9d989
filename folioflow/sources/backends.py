"""Storage backends: inventories of files, content-addressed writes, verified reads, and a registry by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identity import pointer, storage_key
from ..operators.storage import to_append

OBJECT = "key string, sha256 string, bytes long, content binary"


@dataclass(frozen=True)
class FileBackend:
    """Files below a folder of any store that Spark reads."""

    spark: SparkSession
    root: str

    def inventory(self, pattern: str = "*", suffixes: tuple[str, ...] = ("pdf", "zip", "md")) -> DataFrame:
        """path, sha256 and bytes of the files with the given suffixes."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(self.root)
        kept = files.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*suffixes))
        return kept.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))

    def verify(self, references: DataFrame) -> DataFrame:
        """References (path, sha256) with ok: the file is there and its hash is the stated one."""
        have = self.inventory().select(F.col("path").alias("p"), F.col("sha256").alias("h"))
        return references.join(have, F.col("path") == F.col("p"), "left").select("path", F.coalesce(F.col("sha256") == F.col("h"), F.lit(False)).alias("ok"))


@dataclass(frozen=True)
class TableBackend:
    """Objects as rows of a Parquet table; keys have a prefix, objects are written once."""

    spark: SparkSession
    path: str
    prefix: str = "objects/"

    def read(self) -> DataFrame:
        return self.spark.read.schema(OBJECT).parquet(self.path)

    def put(self, objects: DataFrame) -> DataFrame:
        """Appends what is new; equal objects are no-ops, others under the same key stop the write."""
        named = objects.select(storage_key(self.prefix, F.col("key")).alias("key"), F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("bytes"), "content")
        effects = to_append(self.read() if self._exists() else named.limit(0), named, "key", "sha256")
        if effects.where("effect = 'conflict'").limit(1).count():
            raise ValueError("another object has the same key")
        effects.where("effect = 'append'").select("key", "sha256", "bytes", "content").write.mode("append").parquet(self.path)
        return self.read()

    def _exists(self) -> bool:
        from .catalog_files import exists

        return exists(self.spark, self.path)


BACKENDS: dict[str, Callable[..., object]] = {"files": FileBackend, "table": TableBackend}


def backend(name: str, *args):
    if name not in BACKENDS:
        raise KeyError(f"no storage backend {name}")
    return BACKENDS[name](*args)


def resolve_pointers(pointers: DataFrame, objects: DataFrame) -> DataFrame:
    """Pointer texts (path, text) with their objects; ok is false for a broken pointer, a missing object or another size."""
    p = pointers.select("path", pointer(F.col("text")).alias("p")).select("path", "p.oid", "p.size")
    o = objects.select(F.col("sha256").alias("oid"), "bytes").dropDuplicates(["oid"])
    return p.join(o, "oid", "left").select("path", "oid", F.coalesce(F.col("bytes") == F.col("size"), F.lit(False)).alias("ok"))
