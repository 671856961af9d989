"""Storage: inventories, budgets, running totals, idempotent writes, copies between backends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def inventory(objects: DataFrame) -> DataFrame:
    """Distinct objects and their bytes."""
    return objects.select("sha256", "bytes").distinct().agg(F.count("*").alias("objects"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def budget(run_objects: Column, run_bytes: Column, total: Column, max_objects: int, max_bytes: int, warn: int, block: int) -> Column:
    """``error`` above a run's limits or the block total, ``warning`` above the warn total; limits themselves are allowed."""
    return F.when((run_objects > max_objects) | (run_bytes > max_bytes) | (total > block), "error").when(total > warn, "warning").otherwise("ok")


def running_inventory(events: DataFrame, run: str, order: str, size: str) -> DataFrame:
    """Objects and bytes of a run up to and including each event; events of one place count together."""
    upto = Window.partitionBy(run).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return events.withColumns({"run_objects": F.count("*").over(upto), "run_bytes": F.sum(size).over(upto)})


def to_append(existing: DataFrame, arriving: DataFrame, key: str, payload: str) -> DataFrame:
    """What an immutable table does with arriving rows: append, no_op for the same payload, conflict for another.

    Arriving rows of equal key and payload are one row; different payloads of one key in a batch are all conflicts."""
    clash = arriving.groupBy(F.col(key).alias("_key")).agg((F.min(payload) != F.max(payload)).alias("_clash"))
    once = arriving.dropDuplicates([key, payload]).join(clash, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
    joined = once.alias("a").join(existing.alias("e"), F.col(f"a.{key}") == F.col(f"e.{key}"), "left")
    return joined.select(*[F.col(f"a.{c}") for c in arriving.columns], F.when(F.col("_clash"), "conflict").when(F.col(f"e.{key}").isNull(), "append").when(F.col(f"a.{payload}").eqNullSafe(F.col(f"e.{payload}")), "no_op").otherwise("conflict").alias("effect"))


def migration_plan(source: DataFrame, target: DataFrame, key: str, compare: list[str]) -> DataFrame:
    """copy, unchanged or conflict for each source row; rows that only the target has are left alone."""
    joined = source.alias("s").join(target.alias("t"), F.col(f"s.{key}") == F.col(f"t.{key}"), "left")
    same = F.lit(True)
    for c in compare:
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}"))
    return joined.select(F.col(f"s.{key}").alias(key), F.when(F.col(f"t.{key}").isNull(), "copy").when(same, "unchanged").otherwise("conflict").alias("action"))


def owner_of(references: DataFrame, documents: DataFrame, keys: list[str], path: str) -> DataFrame:
    """The owner of each reference: equal keys, a row of the same path before others; more than one is ambiguous.

    Documents are counted by keys, and by keys and path, before they are joined, so a reference meets one row of each."""
    placed = documents.where(F.col(path).isNotNull())
    every = placed.groupBy(*keys).agg(F.min("document").alias("_any"), F.count("*").alias("_n"))
    there = placed.groupBy(*keys, path).agg(F.min("document").alias("_same"), F.count("*").alias("_n_same"))
    joined = references.where(F.col(path).isNotNull()).join(every, keys).join(there, [*keys, path], "left")
    found = joined.groupBy("artifact").agg(F.min("_same").alias("same"), F.sum("_n_same").alias("n_same"), F.min("_any").alias("any"), F.sum("_n").alias("n"))
    best = F.col("n_same").isNotNull()
    return found.select("artifact", F.when(best, F.col("same")).otherwise(F.col("any")).alias("owner"), (F.when(best, F.col("n_same")).otherwise(F.col("n")) > 1).alias("ambiguous"))


def replace_partitions(current: DataFrame, rebuilt: DataFrame, keys: list[str]) -> DataFrame:
    """The table after its partitions that are in ``rebuilt`` are written anew; all others stay."""
    kept = current.join(rebuilt.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(rebuilt)


def path_classes(paths: DataFrame, rules: DataFrame) -> DataFrame:
    """denied, allowed or unlisted for each path; rules are (pattern, verdict) and a denial goes before a permission.

    The rules are a small configuration table (at most ``10_000`` patterns), broadcast for the pattern join."""
    if rules.limit(10_001).count() > 10_000:
        raise ValueError("more path rules than a configuration may have")
    met = paths.join(F.broadcast(rules), F.expr("path RLIKE pattern"), "left")
    worst = F.max(F.when(F.col("verdict") == "deny", 2).when(F.col("verdict") == "allow", 1).otherwise(0))
    return met.groupBy("path").agg(F.element_at(F.array(F.lit("unlisted"), F.lit("allowed"), F.lit("denied")), worst + 1).alias("class"))


def tree_hash(entries: DataFrame, group: str, part: str, path: str, row: Column) -> DataFrame:
    """Hash of a group's rows in path order, on two levels: ``part`` cuts the path order into bounded runs, whose hashes
    are hashed in their order.  So no task collects a whole group."""
    lines = F.transform(F.array_sort(F.collect_list(F.struct(F.col(path).alias("p"), row.alias("r")))), lambda x: F.concat(x["r"], F.lit("\n")))
    parts = entries.groupBy(group, part).agg(F.count("*").alias("n"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("h"))
    tops = F.transform(F.array_sort(F.collect_list(F.struct(part, "h"))), lambda x: F.concat(x["h"], F.lit("\n")))
    return parts.groupBy(group).agg(F.sum("n").alias("entries"), F.sha2(F.array_join(tops, "").cast("binary"), 256).alias("tree_sha256"))
