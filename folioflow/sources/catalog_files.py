"""Catalog files: strict reading, canonical writing, immutable reports, partition overwrite, flat exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_collection(frame: DataFrame, path: str, key: str) -> DataFrame:
    """Writes a collection as JSON lines in key order and returns its descriptor (count, bytes, hash of line hashes).

    Line hashes are summed up by exclusive or and sum, so the hash needs no single task; it does not depend on files."""
    lines = frame.select(F.to_json(F.struct(*sorted(frame.columns)), {"ignoreNullFields": "false"}).alias("value"), key)
    lines.repartitionByRange(key).sortWithinPartitions(key).select("value").write.mode("overwrite").text(path)
    return describe(frame.sparkSession, path)


def describe(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path)
    h = F.xxhash64("value")
    return lines.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0)).alias("bytes"), F.sha2(F.concat_ws(":", F.bit_xor(h).cast("string"), F.sum(F.pmod(h, F.lit(1 << 31))).cast("string")).cast("binary"), 256).alias("fingerprint"))


def load_collection(spark: SparkSession, path: str, schema: StructType | str, descriptor: dict | None = None) -> DataFrame:
    """Reads a collection with its fixed schema; a malformed line or a descriptor that does not match is an error."""
    if descriptor is not None:
        got = describe(spark, path).first().asDict()
        if got != descriptor:
            raise ValueError(f"the collection at {path} does not match its descriptor: {got}")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_if_changed(frame: DataFrame, path: str, key: str, columns: list[str]) -> bool:
    """Replaces a snapshot unless it holds the same rows; returns whether it wrote."""
    spark = frame.sparkSession
    if exists(spark, path):
        old = spark.read.schema(frame.schema).parquet(path)
        if not frame.select(*columns).exceptAll(old.select(*columns)).limit(1).count() and not old.select(*columns).exceptAll(frame.select(*columns)).limit(1).count():
            return False
    frame.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)
    return True


def write_report_once(report: DataFrame, path: str) -> str:
    """Writes a report that never changes: ``written``, ``no_op`` if it is there already, an error if it differs."""
    spark = report.sparkSession
    if not exists(spark, path):
        report.coalesce(1).write.json(path)
        return "written"
    old = spark.read.schema(report.schema).json(path)
    if report.exceptAll(old).limit(1).count() or old.exceptAll(report).limit(1).count():
        raise ValueError(f"another report stands at {path}")
    return "no_op"


def overwrite_periods(frame: DataFrame, path: str, keys: tuple[str, ...] = ("kind", "value")) -> None:
    """Writes the partitions that ``frame`` has; all others stay as they are."""
    frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def export(records: DataFrame, path: str, columns: list[str], order: list[str]) -> None:
    """Flat exports of records: JSON lines, and CSV of fixed columns; other columns are left out of the CSV."""
    ranged = records.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").json(f"{path}/records")
    ranged.select(*columns).write.mode("overwrite").option("header", True).csv(f"{path}/csv")
