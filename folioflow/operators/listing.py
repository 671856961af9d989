"""Listings: first-seen rows, redirects, robots rules, staged operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_seen(rows: DataFrame, key: str, page: str, position: str) -> DataFrame:
    """The first row of each key in page order; a grouped minimum, so hot keys are combined before the shuffle."""
    first = rows.groupBy(key).agg(F.min(F.struct(page, position)).alias("f"))
    return first.select(key, f"f.{page}", f"f.{position}")


def follow(redirects: DataFrame, max_hops: int) -> DataFrame:
    """(start, final, hops, verdict) of every source after at most so many hops."""
    walk = redirects.select(F.col("src").alias("start"), F.col("src").alias("here"), F.lit(0).alias("hops"))
    step = redirects.where("dst IS NOT NULL").select(F.col("src").alias("here"), F.col("dst").alias("then"))
    for _ in range(max_hops + 1):
        walk = walk.join(step, "here", "left").select("start", F.coalesce("then", "here").alias("here"), (F.col("hops") + F.col("then").isNotNull().cast("int")).alias("hops"))
    over = F.col("hops") > max_hops
    return walk.select("start", F.when(~over, F.col("here")).alias("final"), "hops", F.when(over, "too_many").otherwise("ok").alias("verdict"))


def robots_allowed(paths: DataFrame, rules: DataFrame) -> DataFrame:
    """Whether the longest matching prefix rule allows a path.  Paths meet rules by equality of their own prefixes of the
    lengths that rules have, not by comparing each with each."""
    lengths = [r[0] for r in rules.select(F.length("prefix")).distinct().collect()]
    asked = paths.withColumn("prefix", F.explode(F.array(*[F.substring("path", 1, n) for n in sorted(lengths)]))) if lengths else paths.withColumn("prefix", F.lit(""))
    best = asked.join(rules, "prefix").groupBy("page_id").agg(F.max_by("allow", F.length("prefix")).alias("allow"))
    return paths.join(best, "page_id", "left").select("page_id", F.coalesce("allow", F.lit(True)).alias("allowed"))


def staged_operations(raw: Column) -> Column:
    """Operations of a NUL-separated status listing; renames and copies count as a deletion and an addition.

    Records are ``XY path`` and, after R or C, one more part with the old path."""
    parts = F.filter(F.split(raw, "\x00"), lambda x: x != "")
    return F.aggregate(
        parts,
        F.struct(F.lit("").alias("pending"), F.array().cast("array<struct<change:string,path:string>>").alias("out")),
        lambda a, x: F.when(a["pending"] != "", F.struct(F.lit("").alias("pending"), F.concat(a["out"], F.array(F.struct(F.when(a["pending"] == "R", "D").otherwise("-").alias("change"), x.alias("path")))).alias("out")))
        .otherwise(F.struct(F.when(x.rlike("^[RC]"), F.substring(x, 1, 1)).otherwise("").alias("pending"), F.concat(a["out"], F.array(F.struct(F.when(x.rlike("^[RC]"), "A").otherwise(F.trim(F.substring(x, 1, 2))).alias("change"), F.substring(x, 4, 1 << 20).alias("path")))).alias("out"))),
        lambda a: a["out"],
    )
