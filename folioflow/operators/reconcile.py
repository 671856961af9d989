"""Reconciliation of two snapshots, of storage, of rights and of published periods; findings and their counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drifted(columns: list[str], optional: list[str] = ()) -> Column:
    """Whether any column differs between l and r, nulls compared as values; optional ones only if r has a value."""
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    for c in optional:
        out = out | (F.col(f"r.{c}").isNotNull() & ~F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")))
    return out


def snapshot_diff(local: DataFrame, remote: DataFrame, group: str, key: str, compare: list[str], optional: list[str] = ()) -> DataFrame:
    """Findings (group, key, code) of a full outer comparison on (group, key).

    Matched rows that differ are ``changed``; equal ones give nothing.  A group with exactly one unmatched row on each
    side was replaced: one ``changed`` under the local key.  Other unmatched rows are ``new`` (remote only) and
    ``missing_remote`` (local only)."""
    both = local.alias("l").join(remote.alias("r"), (F.col(f"l.{group}") == F.col(f"r.{group}")) & (F.col(f"l.{key}") == F.col(f"r.{key}")), "full_outer")
    side = F.when(F.col(f"l.{key}").isNull(), "remote").when(F.col(f"r.{key}").isNull(), "local").otherwise("both")
    rows = both.select(F.coalesce(f"l.{group}", f"r.{group}").alias(group), F.col(f"l.{key}").alias("lk"), F.col(f"r.{key}").alias("rk"), side.alias("side"), drifted(compare, optional).alias("drift"))
    rows = rows.where("side <> 'both' OR drift")
    # only what differs is counted by group
    lone = rows.where("side <> 'both'").groupBy(group).agg(F.count_if(F.col("side") == "local").alias("n_local"), F.count_if(F.col("side") == "remote").alias("n_remote"))
    replaced = (F.col("n_local") == 1) & (F.col("n_remote") == 1)
    judged = rows.join(lone, group, "left").where(~((F.col("side") == "remote") & F.coalesce(replaced, F.lit(False))))
    code = F.when(F.col("side") == "both", "changed").when(replaced, "changed").when(F.col("side") == "remote", "new").otherwise("missing_remote")
    return judged.select(group, F.coalesce("lk", "rk").alias(key), code.alias("code"))


def storage_findings(references: DataFrame, inventory: DataFrame) -> DataFrame:
    """References (artifact, sha256, rights_ok) against stored objects (artifact, sha256): missing_local, changed,
    rights_changed; objects without a reference are orphans."""
    joined = references.alias("l").join(inventory.alias("r"), "artifact", "left")
    code = F.when(F.col("r.sha256").isNull(), "missing_local").when(F.col("l.sha256") != F.col("r.sha256"), "changed").when(~F.col("l.rights_ok"), "rights_changed")
    found = joined.select("artifact", code.alias("code")).where("code IS NOT NULL")
    orphans = inventory.join(references, "artifact", "left_anti").select("artifact", F.lit("orphan").alias("code"))
    return found.unionByName(orphans)


def rights_findings(subjects: DataFrame, decisions: DataFrame) -> DataFrame:
    """Subjects (subject, source, content, state, decision_hash) whose current decision differs: another hash, another
    state, or not approved; all subjects of the (source, content) share the flag."""
    joined = subjects.join(decisions.select("source", "content", F.col("state").alias("now"), F.col("decision_hash").alias("now_hash")), ["source", "content"], "left")
    now = F.coalesce("now", F.lit("metadata_only"))
    changed = ~F.col("decision_hash").eqNullSafe(F.col("now_hash")) | (F.col("state") != now) | (now != "approved")
    flags = joined.groupBy("source", "content").agg(F.bool_or(changed).alias("any_changed"))
    return joined.join(flags, ["source", "content"]).where("any_changed").select("subject", F.lit("rights_changed").alias("code"))


def membership_findings(expected: DataFrame, published: DataFrame, keys: list[str], member: str) -> DataFrame:
    """Groups whose sets of members differ, with what is missing and what is extra."""
    columns = [*keys, member]
    e, p = expected.select(*columns).distinct(), published.select(*columns).distinct()
    off = e.join(p, columns, "left_anti").withColumn("off", F.lit("missing")).unionByName(p.join(e, columns, "left_anti").withColumn("off", F.lit("extra")))
    return off.groupBy(*keys).agg(F.count_if(F.col("off") == "missing").alias("n_missing"), F.count_if(F.col("off") == "extra").alias("n_extra"))


def with_ok(findings: DataFrame, subjects: DataFrame, subject: str) -> DataFrame:
    """Findings, and an ``ok`` row for each subject without one."""
    ok = subjects.select(subject).distinct().join(findings, subject, "left_anti").select(subject, F.lit("ok").alias("code"))
    return findings.select(subject, "code").unionByName(ok)


def finding_counts(findings: DataFrame) -> DataFrame:
    """One row: counts by code (new counts as missing_local), unresolved, conclusion."""
    n = lambda *codes: F.count_if(F.col("code").isin(*codes)).alias(codes[0])
    return findings.agg(
        n("ok"), n("missing_local", "new"), n("missing_remote"), n("changed"), n("orphan"), n("rights_changed"),
        F.count_if(F.col("code") != "ok").alias("unresolved"), F.when(F.count_if(F.col("code") != "ok") == 0, "success").otherwise("blocked").alias("conclusion"),
    )


def scoped(frames: dict[str, DataFrame], root: str, year: Column, low: int, high: int, links: list[tuple[str, str, str]]) -> dict[str, DataFrame]:
    """Rows of the root in the years, and what hangs on it: links are (child, parent, key), in order."""
    out = {root: frames[root].where(year.between(low, high))}
    for child, parent, key in links:
        out[child] = frames[child].join(out[parent].select(key).distinct(), key, "left_semi")
    return out
