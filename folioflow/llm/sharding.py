"""Sharding by a two-pass external shuffle; law ``rows``: shard counts differ by one at most.

Pass one scatters whole records into buckets of about ``bucket_bytes`` by a seeded hash of id and text, one
bucket for each partition.  Pass two shuffles every bucket in memory (Spark's ``shuffle`` of an array is
a seeded Fisher-Yates shuffle; the array is sorted first, so a repeated attempt gives the same order) and
writes it.  The position of a record in the whole order is its bucket's offset, a prefix sum over bucket counts,
plus its position in the bucket; the order is cut into ``shards`` runs of equal count.

A record whose repetitions alone fill a bucket is scattered by row number over all buckets in place of its hash, so
no bucket outgrows memory whatever the keys are, and its copies are spread over the whole order like any other rows.

A bucket takes what a task's share of an executor's heap can hold several times over (``bucket_bytes_for``), so the
number of buckets of a table falls as executors grow.

Defined results: null text has size 1 and the checksum of no bytes, 0; null ids are scattered by their text;
repeated rows take places of their own, and which of them takes which is of no matter because they are equal;
an empty table gives an empty result; all columns of the input are carried along by :func:`external_shuffle`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import Workspace, fresh, table, text_or_empty

SHARDS = 8
SEED = 29
MIN_BUCKET_BYTES = 16 << 20
#: A bucket is held as rows, as an array, and as the sorted and the shuffled array, each wider than the text itself.
HEAP_SHARE = 14
MAX_FILL = 3


def record_bytes(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long")


def bucket_bytes_for(spark: SparkSession) -> int:
    """The part of an executor's heap that one of its tasks may take for a bucket."""
    context = spark.sparkContext
    conf, local = context.getConf(), context.master.startswith("local")
    heap = context._jvm.java.lang.Runtime.getRuntime().maxMemory() if local else context._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get("spark.executor.memory", "1g"))
    tasks = context.defaultParallelism if local else int(conf.get("spark.executor.cores", "1"))
    return max(MIN_BUCKET_BYTES, heap // max(1, tasks) // HEAP_SHARE)


@dataclass
class Shuffled:
    """Written buckets: every record with its bucket and position, and the offset of each bucket."""

    records: DataFrame
    offsets: DataFrame
    total: int
    bucket: str
    position: str


def external_shuffle(docs: DataFrame, work: Workspace, seed: int = SEED, bucket_bytes: int | None = None, extra: dict[str, Column] | None = None) -> Shuffled:
    """Writes all records of ``docs`` (and the columns ``extra`` computed on the way) in shuffled order."""
    bucket, position, packed, load, hot = fresh(docs.select("*", *[c.alias(n) for n, c in (extra or {}).items()]), "bucket", "position", "packed", "load", "hot")
    bucket_bytes = bucket_bytes or bucket_bytes_for(docs.sparkSession)
    draw = F.xxhash64(F.lit(seed), "doc_id", "text")
    total = docs.agg(F.sum(record_bytes())).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    cell = F.pmod(draw, F.lit(buckets)).cast("int")
    columns = [*docs.columns, *(extra or {})]
    frame = docs.withColumns(extra or {})
    # at most buckets / MAX_FILL cells are overfull; in them, records whose repetitions fill a bucket: fewer than buckets
    loads = docs.groupBy(cell.alias(bucket)).agg(F.sum(record_bytes()).alias(load))
    full = work.save(loads.where(F.col(load) > MAX_FILL * max(bucket_bytes, total // buckets)).select(bucket), "full")
    if full.isEmpty():
        frame = frame.withColumn(bucket, cell)
    else:
        inside = docs.select(cell.alias(bucket), draw.alias(hot), record_bytes().alias(load)).join(F.broadcast(full), bucket, "left_semi")
        often = work.save(inside.groupBy(hot).agg(F.sum(load).alias(load), F.count("*").alias(position)).where((F.col(load) > bucket_bytes) & (F.col(position) > 1)).select(hot), "hot")
        anywhere = F.pmod(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), F.lit(buckets)).cast("int")
        frame = frame.join(F.broadcast(often), draw == F.col(hot), "left").withColumn(bucket, F.when(F.col(hot).isNull(), cell).otherwise(anywhere)).drop(hot)
    dealt = frame.repartitionById(buckets, F.col(bucket))
    # one bucket to a partition: sorted, then shuffled with the partition's seed
    lists = dealt.groupBy(bucket).agg(F.sort_array(F.collect_list(F.struct(*columns))).alias(packed))
    shuffled = lists.select(bucket, F.posexplode(F.shuffle(F.col(packed), F.lit(seed))).alias(position, load))
    records = work.save(shuffled.select(bucket, position, *[F.col(load)[c].alias(c) for c in columns]), "records", codec="snappy")
    counts = records.groupBy(bucket).agg(F.count("*").alias("n"))
    upto = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = work.save(counts.select(bucket, F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("begin"), "n").coalesce(1), "offsets")
    total_rows = offsets.agg(F.sum("n")).first()[0] or 0
    return Shuffled(records, offsets, total_rows, bucket, position)


def with_shard(shuffled: Shuffled, shards: int, shard: str, slot: str) -> DataFrame:
    """The shuffled records with their shard and their slot in it, gapless from 0."""
    (begin,) = fresh(shuffled.records, "begin")
    offsets = shuffled.offsets.select(shuffled.bucket, F.col("begin").alias(begin))
    # a row for each bucket: broadcast while there are no more than a few MB of them
    joined = shuffled.records.join(F.broadcast(offsets) if offsets.limit(200_001).count() <= 200_000 else offsets, shuffled.bucket)
    total = max(1, shuffled.total)
    # shard k holds the places from ceil(k*total/shards) on
    at = f"(`{begin}` + `{shuffled.position}`)"
    number = f"({at} * {shards}L div {total}L)"
    first = f"(({number} * {total}L + {shards - 1}L) div {shards}L)"
    return joined.withColumns({shard: F.expr(f"CAST({number} AS int)"), slot: F.expr(f"{at} - {first}")}).drop(begin, shuffled.bucket, shuffled.position)


def assign(docs: DataFrame, shards: int = SHARDS, **how) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``."""
    work = Workspace(docs.sparkSession, "sharding")
    extra = {"size": record_bytes(), "text_crc32": F.crc32(text_or_empty().cast("binary"))}
    done = external_shuffle(docs.select("doc_id", "text"), work, extra=extra, **how)
    out = with_shard(done, shards, "shard", "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def sharded(docs: DataFrame, shards: int = SHARDS, **how) -> DataFrame:
    """All rows and columns of ``docs`` with two more: shard and slot."""
    shard, slot = fresh(docs, "shard", "slot")
    return with_shard(external_shuffle(docs, Workspace(docs.sparkSession, "sharding"), **how), shards, shard, slot)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, **how) -> None:
    """Writes the shards as Parquet below ``path``/shard=k, each file a run of slots in order."""
    out = sharded(docs, shards, **how)
    shard, slot = out.columns[-2:]
    out.repartition(shards, shard).sortWithinPartitions(shard, slot).write.partitionBy(shard).mode("overwrite").parquet(path)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents"))
