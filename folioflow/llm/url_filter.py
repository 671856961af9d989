"""URL filters: a temporal join of captures with dated list entries.

A list is a log of dated events: (key, action, at), with action ``block``, ``allow`` or ``drop`` (the key leaves the
list).  The key is a host or a domain; a domain covers all hosts below it.  Events of a key become validity intervals:
each lasts until the key's next event.  A capture is judged by the intervals that hold at its fetch time, the key
with the most labels first; a capture without one is kept.

Captures meet intervals by equality of key and time bucket, then by the interval itself, so the product of a key's
captures with its whole history never arises; a capture has as many keys as its host has labels (at most
``MAX_LABELS``, the limit of the DNS).  Captures are reduced to distinct (host, time) first.  The join is planned by Spark
from sizes: a small list is broadcast, else the adaptive skew join splits hot keys.

A host in brackets (IPv6) is one key with its brackets and has no domains above it; ports are no part of a host.

Defined results: null or unparsable URLs have a null host and are kept; a null fetch time meets no entry and is kept;
events with a null key, action or time are ignored; repeated events count once; of events of one key at one time the
strictest holds (block, allow, drop); an empty list keeps everything; other columns pass through, and a new column whose
name a capture column already has gets underscores in front.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import fresh, table

MAX_LABELS = 127
BUCKET_DAYS = 32


def host_of(url: Column) -> Column:
    """Lower-cased host without a final dot; null if there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\[\]/?#@]+\]|[^/?#:@\[\]]+)", 1)), r"\.+$", "")
    return F.when(host != "", host)


def suffixes(host: Column) -> Column:
    """The host and every domain above it, longest first."""
    labels = F.when(host.startswith("["), F.array(host)).otherwise(F.split(host, r"\."))
    return F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(MAX_LABELS))), lambda i: F.array_join(F.slice(labels, i, MAX_LABELS), "."))


def intervals(events: DataFrame) -> DataFrame:
    """key, action, begin, end (null: still holds) of the entries that are on the list."""
    strict = F.when(F.col("action") == "block", 0).when(F.col("action") == "allow", 1).otherwise(2)
    clean = events.where("key IS NOT NULL AND action IS NOT NULL AND at IS NOT NULL").select(F.lower("key").alias("key"), "action", "at")
    one = clean.groupBy("key", "at").agg(F.min(F.struct(strict.alias("rank"), "action"))["action"].alias("action"))
    ends = F.lead("at").over(Window.partitionBy("key").orderBy("at"))
    return one.select("key", "action", F.col("at").alias("begin"), ends.alias("end")).where("action <> 'drop'")


def judge(captures: DataFrame, events: DataFrame, url: str = "url", at: str = "fetched") -> DataFrame:
    """``captures`` with host, entry (the key that decided), action, entry_begin and kept, in this order behind its own columns."""
    new = fresh(captures, "host", "entry", "action", "entry_begin", "kept")
    host, when, verdict = fresh(captures.select("*", *[F.lit(0).alias(c) for c in new]), "of_url", "when", "verdict")
    rows = captures.withColumn(host, host_of(F.col(url)))
    days = lambda c: F.floor(F.unix_timestamp(c.cast("timestamp")) / (86400 * BUCKET_DAYS))
    asked = rows.where(F.col(host).isNotNull() & F.col(at).isNotNull()).select(F.col(host), F.col(at).alias(when)).distinct()
    span = asked.agg(F.min(days(F.col(when))).alias("low"), F.max(days(F.col(when))).alias("high"))
    low, high = span.first()
    if low is None:
        low, high = 0, -1
    # each interval once for each bucket of the captures' own time that it touches
    first, last = F.greatest(days(F.col("begin")), F.lit(low)), F.least(F.coalesce(days(F.col("end")), F.lit(high)), F.lit(high))
    listed = intervals(events).where(first <= last).select(F.col("key").alias("entry"), F.col("action").alias("does"), "begin", "end", F.explode(F.sequence(first, last)).alias("b"))
    asked = asked.select(F.col(host).alias("of"), F.col(when).alias("then"))
    keyed = asked.select("of", "then", days(F.col("then")).alias("bucket"), F.explode(suffixes(F.col("of"))).alias("asks"))
    holds = (F.col("then") >= F.col("begin")) & (F.col("end").isNull() | (F.col("then") < F.col("end")))
    met = keyed.join(listed, (F.col("asks") == F.col("entry")) & (F.col("bucket") == F.col("b")) & holds)
    best = met.groupBy("of", "then").agg(F.max(F.struct(F.length("entry").alias("n"), "entry", F.col("does").alias("action"), F.col("begin").alias("entry_begin"))).alias(verdict))
    of, then = fresh(rows, "of", "then")
    joined = rows.join(best.toDF(of, then, verdict), (F.col(host) == F.col(of)) & (F.col(at) == F.col(then)), "left")
    v = F.col(verdict)
    found = (F.col(host), v["entry"], v["action"], v["entry_begin"], F.coalesce(v["action"] != "block", F.lit(True)))
    return joined.select(*captures.columns, *[c.alias(name) for c, name in zip(found, new, strict=True)])


def url_filter(captures: DataFrame, events: DataFrame, url: str = "url", at: str = "fetched") -> DataFrame:
    """The captures that are kept, with their own columns."""
    judged = judge(captures.select(F.struct("*").alias("capture"), F.col(url).alias("url"), F.col(at).alias("fetched")), events)
    return judged.where("kept").select("capture.*")


def _number(c: Column) -> Column:
    return F.conv(F.substring(F.md5(c.cast("binary")), 1, 8), 16, 10).cast("long")


def _day(n: Column) -> Column:
    return F.timestamp_seconds(F.lit(1704067200) + n * 86400).cast("timestamp_ntz")


def sample_events(hosts: DataFrame) -> DataFrame:
    """A dated list over the hosts of a capture table, made by rule: the tables bring none of their own."""
    rule = hosts.withColumn("domain", F.array_join(F.slice(F.split("host", r"\."), -3, 3), ".")).where(F.size(F.split("host", r"\.")) >= 3)
    domains = rule.select(F.col("domain").alias("key")).distinct().withColumn("x", _number(F.col("key")))
    own = rule.select(F.col("host").alias("key")).where("key LIKE 'm.%' OR key LIKE 'blog.%'").distinct().withColumn("x", _number(F.col("key")))
    event = lambda frame, where, action, day: frame.where(where).select("key", F.lit(action).alias("action"), _day(F.expr(day)).alias("at"))
    return (
        event(domains, "x % 3 <> 0", "block", "x % 300")
        .unionByName(event(domains, "x % 3 <> 0 AND x % 2 = 0", "drop", "x % 300 + 60 + x % 90"))
        .unionByName(event(domains, "x % 5 = 0", "allow", "x % 300 + 200"))
        .unionByName(event(own, "x % 4 = 0", "allow", "x % 200"))
        .unionByName(event(own, "x % 4 = 1", "block", "x % 150"))
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page of ``pages``, fetched on a day of 2024 that follows from its id, against the list made by rule."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", _day(F.col("page_id") * 7919 % 366).alias("fetched"))
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host IS NOT NULL").distinct()
    return judge(pages, sample_events(hosts)).select("page_id", "host", "fetched", "entry", "action", "entry_begin", "kept")


OP5_SQL = r"""
WITH captures AS (
  SELECT page_id, nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.+$', ''), '') AS host,
         TIMESTAMP '2024-01-01' + to_days(CAST(page_id * 7919 % 366 AS INTEGER)) AS fetched
  FROM pages),
hosts AS (SELECT DISTINCT host, string_split(host, '.') AS labels FROM captures WHERE host IS NOT NULL),
domains AS (SELECT DISTINCT array_to_string(labels[-3:], '.') AS key FROM hosts WHERE len(labels) >= 3),
own AS (SELECT host AS key FROM hosts WHERE len(labels) >= 3 AND (host LIKE 'm.%' OR host LIKE 'blog.%')),
d AS (SELECT key, CAST('0x' || md5(key)[1:8] AS BIGINT) AS x FROM domains),
o AS (SELECT key, CAST('0x' || md5(key)[1:8] AS BIGINT) AS x FROM own),
events AS (
  SELECT key, 'block' AS action, x % 300 AS day FROM d WHERE x % 3 <> 0
  UNION ALL SELECT key, 'drop', x % 300 + 60 + x % 90 FROM d WHERE x % 3 <> 0 AND x % 2 = 0
  UNION ALL SELECT key, 'allow', x % 300 + 200 FROM d WHERE x % 5 = 0
  UNION ALL SELECT key, 'allow', x % 200 FROM o WHERE x % 4 = 0
  UNION ALL SELECT key, 'block', x % 150 FROM o WHERE x % 4 = 1),
one AS (
  SELECT key, TIMESTAMP '2024-01-01' + to_days(CAST(day AS INTEGER)) AS since, arg_min(action, CASE action WHEN 'block' THEN 0 WHEN 'allow' THEN 1 ELSE 2 END) AS action
  FROM events GROUP BY key, day),
spans AS (SELECT key, action, since AS starts, lead(since) OVER (PARTITION BY key ORDER BY since) AS ends FROM one),
met AS (
  SELECT c.page_id, s.key, s.action, s.starts, row_number() OVER (PARTITION BY c.page_id ORDER BY length(s.key) DESC) AS k
  FROM captures c JOIN spans s ON (c.host = s.key OR ends_with(c.host, '.' || s.key))
   AND s.action <> 'drop' AND c.fetched >= s.starts AND (s.ends IS NULL OR c.fetched < s.ends))
SELECT c.page_id, c.host, c.fetched, m.key AS entry, m.action, m.starts AS entry_begin, coalesce(m.action <> 'block', true) AS kept
FROM captures c LEFT JOIN met m ON m.page_id = c.page_id AND m.k = 1
"""
