"""Queries on catalogs: integrity, snapshots, rights, storage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import identity as i
from ..functions import text as t
from ..operators import integrity, reconcile, rights, storage
from .registry import query, read

# Two snapshots of the documents: the remote one has other keys (every 17th and 19th row), another language (every 13th),
# and no hash (every 5th).
_LOCAL = "SELECT doc_id // 4 AS grp, doc_id AS key, lang, n_chars, md5(text) AS hash FROM documents"
_REMOTE = """SELECT doc_id // 4 AS grp, doc_id + CASE WHEN doc_id % 17 = 0 OR doc_id % 19 = 0 THEN 10000000 ELSE 0 END AS key,
  CASE WHEN doc_id % 13 = 0 THEN 'xx' ELSE lang END AS lang, n_chars,
  CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 23 = 0 THEN md5(text || '!') ELSE md5(text) END AS hash FROM documents"""
_DIFF = f"""
WITH l AS ({_LOCAL}), r AS ({_REMOTE}),
j AS (SELECT coalesce(l.grp, r.grp) AS grp, l.key AS lk, r.key AS rk,
        l.lang IS DISTINCT FROM r.lang OR l.n_chars IS DISTINCT FROM r.n_chars OR (r.hash IS NOT NULL AND l.hash IS DISTINCT FROM r.hash) AS drift
      FROM l FULL JOIN r ON l.grp = r.grp AND l.key = r.key),
n AS (SELECT *, count(*) FILTER (rk IS NULL) OVER (PARTITION BY grp) AS nl, count(*) FILTER (lk IS NULL) OVER (PARTITION BY grp) AS nr FROM j)
SELECT grp, coalesce(lk, rk) AS key,
  CASE WHEN lk IS NOT NULL AND rk IS NOT NULL THEN 'changed' WHEN nl = 1 AND nr = 1 THEN 'changed' WHEN lk IS NULL THEN 'new' ELSE 'missing_remote' END AS code
FROM n WHERE (lk IS NULL OR rk IS NULL OR drift) AND NOT (lk IS NULL AND nl = 1 AND nr = 1)"""


def snapshots(spark, d):
    docs = read(spark, d, "documents")
    local = docs.select((F.expr("doc_id div 4")).alias("grp"), F.col("doc_id").alias("key"), "lang", "n_chars", F.md5("text").alias("hash"))
    moved = (F.col("doc_id") % 17 == 0) | (F.col("doc_id") % 19 == 0)
    remote = docs.select(
        F.expr("doc_id div 4").alias("grp"), (F.col("doc_id") + F.when(moved, 10000000).otherwise(0)).alias("key"), F.when(F.col("doc_id") % 13 == 0, "xx").otherwise(F.col("lang")).alias("lang"), "n_chars",
        F.when(F.col("doc_id") % 5 == 0, F.lit(None)).when(F.col("doc_id") % 23 == 0, F.md5(F.concat("text", F.lit("!")))).otherwise(F.md5("text")).alias("hash"),
    )
    return local, remote


@query(_DIFF)
def snapshot_diff(spark, d):
    """Full outer comparison with replacements and optional hashes."""
    return reconcile.snapshot_diff(*snapshots(spark, d), "grp", "key", ["lang", "n_chars"], ["hash"])


@query(f"""
WITH f AS ({_DIFF}),
a AS (SELECT code FROM f UNION ALL SELECT 'ok' FROM documents WHERE doc_id NOT IN (SELECT key FROM f))
SELECT count(*) FILTER (code = 'ok') AS ok, count(*) FILTER (code IN ('missing_local', 'new')) AS missing_local, count(*) FILTER (code = 'missing_remote') AS missing_remote,
  count(*) FILTER (code = 'changed') AS changed, count(*) FILTER (code = 'orphan') AS orphan, count(*) FILTER (code = 'rights_changed') AS rights_changed,
  count(*) FILTER (code <> 'ok') AS unresolved, CASE WHEN count(*) FILTER (code <> 'ok') = 0 THEN 'success' ELSE 'blocked' END AS conclusion FROM a""")
def finding_counts(spark, d):
    """Findings, ok rows for subjects without one, counts and conclusion."""
    local, remote = snapshots(spark, d)
    found = reconcile.snapshot_diff(local, remote, "grp", "key", ["lang", "n_chars"], ["hash"])
    return reconcile.finding_counts(reconcile.with_ok(found.select("key", "code"), local, "key"))


@query(f"""
WITH l AS ({_LOCAL}), r AS ({_REMOTE})
SELECT coalesce(l.key, r.key) AS key, l.hash AS before, r.hash AS after FROM l FULL JOIN r ON l.key = r.key WHERE l.hash IS DISTINCT FROM r.hash""")
def changed_rows(spark, d):
    """Full outer comparison of two path-to-hash snapshots."""
    local, remote = snapshots(spark, d)
    both = local.alias("l").join(remote.alias("r"), F.col("l.key") == F.col("r.key"), "full_outer")
    return both.where(~F.col("l.hash").eqNullSafe(F.col("r.hash"))).select(F.coalesce("l.key", "r.key").alias("key"), F.col("l.hash").alias("before"), F.col("r.hash").alias("after"))


@query("""
SELECT doc_id, sha256(text) AS content_hash, min(doc_id) OVER (PARTITION BY sha256(text)) AS canonical,
  CASE WHEN doc_id = min(doc_id) OVER (PARTITION BY sha256(text)) THEN 0 ELSE 1 END AS n_aliases FROM documents""")
def content_aliases(spark, d):
    """Star of aliases around the smallest id of equal content."""
    out = integrity.content_aliases(read(spark, d, "documents").select("doc_id", "text"), i.sha256(F.col("text")), "doc_id")
    return out.select("doc_id", "content_hash", "canonical", F.size("same_content_as").alias("n_aliases"))


@query("""
SELECT doc_id, 'left' AS side FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'right' FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)""")
def reference_gaps(spark, d):
    """Keys that only one of two tables has."""
    return integrity.unmatched(read(spark, d, "documents"), read(spark, d, "labels"), ["doc_id"])


@query("SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_links(spark, d):
    """D3, H3, H9: keys that occur more than once."""
    return integrity.duplicate_keys(read(spark, d, "lineitem"), ["l_partkey", "l_suppkey"])


@query("SELECT l_orderkey, l_partkey, count(DISTINCT l_suppkey) AS n_values FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_suppkey) > 1")
def conflicting_owners(spark, d):
    """Equal repetitions collapse, different ones conflict."""
    return integrity.conflicting(read(spark, d, "lineitem"), ["l_orderkey", "l_partkey"], ["l_suppkey"])


def _versions(spark, d):
    c = read(spark, d, "conversations").select("conv_id", "turn")
    node = F.col("conv_id") * 1000 + F.col("turn")
    last = c.groupBy("conv_id").agg(F.max("turn").alias("last"))
    return c.join(last, "conv_id").select(
        node.alias("node"), F.when(F.col("turn") > 0, node - 1).alias("supersedes"), F.when((F.col("turn") < F.col("last")) & (F.col("conv_id") % 9 != 0), node + 1).alias("superseded_by")
    )


_VERSIONS = """SELECT conv_id * 1000 + turn AS node, CASE WHEN turn > 0 THEN conv_id * 1000 + turn - 1 END AS supersedes,
  CASE WHEN turn < max(turn) OVER (PARTITION BY conv_id) AND conv_id % 9 <> 0 THEN conv_id * 1000 + turn + 1 END AS superseded_by FROM conversations"""


@query(f"""
WITH v AS ({_VERSIONS})
SELECT a.node, a.supersedes, CASE WHEN b.node IS NULL THEN 'missing' ELSE 'not_returned' END AS problem
FROM v a LEFT JOIN v b ON b.node = a.supersedes WHERE a.supersedes IS NOT NULL AND b.superseded_by IS DISTINCT FROM a.node""")
def version_reciprocity(spark, d):
    """Version edges that the other end does not return."""
    return integrity.reciprocal_violations(_versions(spark, d))


@query("""
SELECT conv_id, turn, length(text) AS size, before, CASE WHEN before = length(text) THEN 'repeated' ELSE 'unsorted' END AS problem
FROM (SELECT *, lag(length(text)) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations) WHERE before >= length(text)""")
def unsorted_turns(spark, d):
    """Rows that break a strict order inside their group."""
    c = read(spark, d, "conversations").withColumn("size", F.length("text"))
    return integrity.order_violations(c, ["conv_id"], "turn", "size")


@query("""
WITH RECURSIVE e AS (SELECT doc_id AS node, CASE WHEN doc_id % 10 <> 0 THEN (doc_id * 7 + 3) % (SELECT count(*) FROM documents) END AS nxt FROM documents),
w AS (SELECT node AS start, nxt AS here FROM e WHERE nxt IS NOT NULL UNION SELECT w.start, e.nxt FROM w JOIN e ON e.node = w.here WHERE e.nxt IS NOT NULL),
loops AS (SELECT start FROM w WHERE start = here)
SELECT DISTINCT w.start AS node FROM w JOIN loops ON w.here = loops.start""")
def version_cycles(spark, d):
    """M1: nodes on a cycle, or leading into one."""
    docs = read(spark, d, "documents").select("doc_id")
    n = docs.count()
    return integrity.on_cycles(docs.select(F.col("doc_id").alias("node"), F.when(F.col("doc_id") % 10 != 0, (F.col("doc_id") * 7 + 3) % n).alias("next")))


@query("""
SELECT event_id AS line_no, CASE event_id % 50 WHEN 0 THEN 'blank' WHEN 1 THEN 'not_json' WHEN 2 THEN 'not_json' ELSE 'not_canonical' END AS problem FROM events WHERE event_id % 50 < 4""")
def strict_json_lines(spark, d):
    """Lines that are not strict canonical JSON; of every fifty, four are made so."""
    k = F.col("event_id") % 50
    value = F.when(k == 0, " ").when(k == 1, '{"a": 1,"a": 2}').when(k == 2, '{"a": NaN}').when(k == 3, '{"b": 1,"a": 2}').otherwise(F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit("}")))
    lines = read(spark, d, "events").select(F.col("event_id").alias("line_no"), value.alias("value"))
    return integrity.strict_lines(lines, i.canonical_json(F.col("value")))


def _descriptor(frame, name, key, line):
    """Count, bytes and a two-level hash of a table's lines: of each thousand in key order, then of those."""
    part = frame.select(F.expr(f"{key} div 1000").alias("part"), F.col(key).alias("key"), line.alias("line"))
    level = part.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.octet_length("line") + 1).alias("bytes"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("key", "line"))), lambda x: F.concat(x["line"], F.lit("\n"))), "").cast("binary"), 256).alias("hash"))
    return level.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "hash"))), lambda x: x["hash"]), "").cast("binary"), 256).alias("sha256")).select(F.lit(name).alias("kind"), "n", "bytes", "sha256")


_DESCRIPTOR = """SELECT '{name}' AS kind, CAST(sum(n) AS BIGINT) AS n, CAST(sum(bytes) AS BIGINT) AS bytes, sha256(string_agg(hash, '' ORDER BY part)) AS sha256 FROM (
  SELECT {key} // 1000 AS part, count(*) AS n, sum(octet_length(encode(line)) + 1) AS bytes, sha256(string_agg(line || chr(10), '' ORDER BY {key})) AS hash FROM (SELECT {key}, {line} AS line FROM {name}) GROUP BY 1)"""


@query(" UNION ALL ".join(_DESCRIPTOR.format(name=n, key=k, line=line) for n, k, line in (("labels", "doc_id", "doc_id || ':' || quality || ':' || toxic"), ("documents", "doc_id", "doc_id || ':' || sha256(text)"), ("customer", "c_custkey", "c_custkey || ':' || c_name || ':' || c_mktsegment"))))
def catalog_descriptor(spark, d):
    """Descriptor rows of a catalog's collections."""
    joined = lambda *c: F.concat_ws(":", *[x.cast("string") if not isinstance(x, str) else F.col(x).cast("string") for x in c])
    a = _descriptor(read(spark, d, "labels"), "labels", "doc_id", joined("doc_id", "quality", "toxic"))
    b = _descriptor(read(spark, d, "documents"), "documents", "doc_id", joined("doc_id", i.sha256(F.col("text"))))
    c = _descriptor(read(spark, d, "customer"), "customer", "c_custkey", joined("c_custkey", "c_name", "c_mktsegment"))
    return a.unionByName(b).unionByName(c)


@query("""
SELECT source, CAST(sum(n) AS BIGINT) AS entries, sha256(string_agg(hash || chr(10), '' ORDER BY part)) AS tree_sha256 FROM (
  SELECT source, doc_id // 1000 AS part, count(*) AS n, sha256(string_agg(sha256(text) || '  ' || lpad(CAST(doc_id AS VARCHAR), 12, '0') || chr(10), '' ORDER BY doc_id)) AS hash
  FROM documents GROUP BY ALL) GROUP BY source""")
def tree_hashes(spark, d):
    """Ordered tree hash of each source, of parts of a thousand first."""
    docs = read(spark, d, "documents").select("source", F.expr("doc_id div 1000").alias("part"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"), i.sha256(F.col("text")).alias("hash"))
    return storage.tree_hash(docs, "source", "part", "path", F.concat("hash", F.lit("  "), "path"))


# Rights: labels stand in for the register.
_REGISTER = """SELECT doc_id, CASE WHEN toxic = 1 THEN 'internal_only' WHEN quality = 1 THEN 'approved' ELSE 'unknown' END AS state,
  CASE WHEN quality = 1 THEN 'license' ELSE 'review' END AS basis, CASE WHEN quality = 1 OR toxic = 1 THEN 'r' || doc_id % 3 END AS reviewed_by,
  CASE WHEN quality = 1 THEN '2024-01-0' || (1 + doc_id % 9) END AS reviewed_at FROM labels"""
_HASHED = f"""SELECT *, sha256('{{' || chr(10) || '  "basis": ' || to_json(basis) || ',' || chr(10) || '  "policy_version": 1,' || chr(10)
  || '  "reviewed_at": ' || coalesce(to_json(reviewed_at), 'null') || ',' || chr(10) || '  "reviewed_by": ' || coalesce(to_json(reviewed_by), 'null') || ',' || chr(10)
  || '  "source_id": "document-' || doc_id || '",' || chr(10) || '  "source_sha256": "' || sha256(CAST(doc_id AS VARCHAR)) || '",' || chr(10)
  || '  "state": ' || to_json(state) || chr(10) || '}}' || chr(10)) AS decision_hash FROM ({_REGISTER})"""
_EVALUATED = f"""SELECT d.doc_id, d.source, CASE WHEN r.state IS NULL OR r.state = 'unknown' THEN 'metadata_only' ELSE r.state END AS state, coalesce(r.basis, 'rights_register_no_match') AS basis, r.decision_hash,
  CASE d.doc_id % 4 WHEN 0 THEN 'public' WHEN 1 THEN 'repository_authorized' WHEN 2 THEN 'internal' ELSE 'restricted' END AS visibility
  FROM documents d LEFT JOIN ({_HASHED}) r ON r.doc_id = d.doc_id"""


def _decision_hash():
    doc = F.col("doc_id").cast("string")
    return rights.decision_hash(1, F.concat(F.lit("document-"), doc), i.sha256(doc), *map(F.col, ("state", "basis", "reviewed_by", "reviewed_at")))


def register(spark, d):
    r = read(spark, d, "labels").select(
        "doc_id", F.when(F.col("toxic") == 1, "internal_only").when(F.col("quality") == 1, "approved").otherwise("unknown").alias("state"), F.when(F.col("quality") == 1, "license").otherwise("review").alias("basis"),
        F.when((F.col("quality") == 1) | (F.col("toxic") == 1), F.concat(F.lit("r"), (F.col("doc_id") % 3).cast("string"))).alias("reviewed_by"),
        F.when(F.col("quality") == 1, F.concat(F.lit("2024-01-0"), (1 + F.col("doc_id") % 9).cast("string"))).alias("reviewed_at"),
    )
    return r.withColumn("decision_hash", _decision_hash())


def evaluated(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "source")
    out = rights.evaluate(docs, register(spark, d), ["doc_id"])
    return out.withColumn("visibility", F.element_at(F.array(*map(F.lit, ("public", "repository_authorized", "internal", "restricted"))), (F.col("doc_id") % 4 + 1).cast("int")))


@query(f"SELECT doc_id, state, basis, decision_hash FROM ({_EVALUATED})")
def rights_evaluation(spark, d):
    """Exact decision, or the default."""
    return evaluated(spark, d).select("doc_id", "state", "basis", "decision_hash")


@query(f"""
SELECT doc_id, state, visibility, true AS metadata, true AS origin_link,
  (state = 'approved' OR (state = 'internal_only' AND visibility IN ('internal', 'restricted'))) AS content,
  (state = 'approved' AND visibility IN ('public', 'repository_authorized')) AS derived_text FROM ({_EVALUATED})""")
def rights_policy(spark, d):
    """State by visibility."""
    return evaluated(spark, d).withColumn("p", rights.policy(F.col("state"), F.col("visibility"))).select("doc_id", "state", "visibility", "p.*")


@query(f"""
SELECT e.source, count(*) AS authorized FROM ({_EVALUATED}) e JOIN ({_HASHED}) r ON r.doc_id = e.doc_id AND r.state = e.state AND r.decision_hash IS NOT DISTINCT FROM e.decision_hash
WHERE r.state = 'approved' OR (r.state = 'internal_only' AND e.visibility IN ('internal', 'restricted')) GROUP BY e.source""")
def rights_authorized(spark, d):
    """Current and allowed subjects, counted by source."""
    return rights.authorized(evaluated(spark, d), register(spark, d), ["doc_id"], F.col("visibility")).groupBy("source").agg(F.count("*").alias("authorized"))


@query(f"""
SELECT doc_id, CASE WHEN (reviewed_by IS NOT NULL) <> (reviewed_at IS NOT NULL) THEN 'half_review' WHEN state IN ('approved', 'internal_only') AND reviewed_by IS NULL THEN 'no_review' END AS problem
FROM ({_HASHED}) WHERE problem IS NOT NULL""")
def invalid_decisions(spark, d):
    """C14: decisions that contradict themselves."""
    r = register(spark, d)
    return rights.invalid_decisions(r, _decision_hash()).select("doc_id", "problem")


@query(f"""
WITH s AS (SELECT e.doc_id AS subject, e.source, e.doc_id % 50 AS content, e.state, CASE WHEN e.doc_id % 11 = 0 THEN 'old' ELSE 'h' || e.source || e.doc_id % 50 END AS h FROM ({_EVALUATED}) e),
n AS (SELECT DISTINCT source, content, CASE WHEN content % 7 = 0 THEN 'internal_only' ELSE 'approved' END AS state, 'h' || source || content AS h FROM s),
j AS (SELECT s.*, (s.h IS DISTINCT FROM n.h OR s.state <> n.state OR n.state <> 'approved') AS changed FROM s JOIN n USING (source, content))
SELECT subject, 'rights_changed' AS code FROM (SELECT *, bool_or(changed) OVER (PARTITION BY source, content) AS f FROM j) WHERE f""")
def rights_drift(spark, d):
    """Subjects whose current decision differs, shared by source and content."""
    s = evaluated(spark, d).withColumn("content", F.col("doc_id") % 50)
    named = F.concat(F.lit("h"), "source", F.col("content").cast("string"))
    subjects = s.select(F.col("doc_id").alias("subject"), "source", "content", "state", F.when(F.col("doc_id") % 11 == 0, "old").otherwise(named).alias("decision_hash"))
    decisions = s.select("source", "content").distinct().select("source", "content", F.when(F.col("content") % 7 == 0, "internal_only").otherwise("approved").alias("state"), named.alias("decision_hash"))
    return reconcile.rights_findings(subjects, decisions)


# Storage: documents stand in for stored artifacts.
@query("""
WITH l AS (SELECT doc_id AS artifact, sha256(text) AS h, doc_id % 29 <> 0 AS ok FROM documents),
r AS (SELECT CASE WHEN doc_id % 31 = 0 THEN doc_id + 10000000 ELSE doc_id END AS artifact, CASE WHEN doc_id % 37 = 0 THEN 'x' ELSE sha256(text) END AS h FROM documents)
SELECT artifact, CASE WHEN r.h IS NULL THEN 'missing_local' WHEN l.h <> r.h THEN 'changed' ELSE 'rights_changed' END AS code FROM l LEFT JOIN r USING (artifact) WHERE r.h IS NULL OR l.h <> r.h OR NOT ok
UNION ALL SELECT artifact, 'orphan' FROM r WHERE artifact NOT IN (SELECT artifact FROM l)""")
def storage_findings(spark, d):
    """References against the inventory."""
    docs = read(spark, d, "documents").select("doc_id", i.sha256(F.col("text")).alias("sha256"))
    refs = docs.select(F.col("doc_id").alias("artifact"), "sha256", (F.col("doc_id") % 29 != 0).alias("rights_ok"))
    have = docs.select(F.when(F.col("doc_id") % 31 == 0, F.col("doc_id") + 10000000).otherwise(F.col("doc_id")).alias("artifact"), F.when(F.col("doc_id") % 37 == 0, "x").otherwise(F.col("sha256")).alias("sha256"))
    return reconcile.storage_findings(refs, have)


@query("SELECT count(*) AS objects, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes FROM (SELECT DISTINCT sha256(text) AS h, octet_length(encode(text)) AS bytes FROM documents)")
def storage_inventory(spark, d):
    """Distinct objects and bytes."""
    return storage.inventory(read(spark, d, "documents").select(i.sha256(F.col("text")).alias("sha256"), F.octet_length("text").cast("long").alias("bytes")))


@query("""
SELECT source, n, bytes, CASE WHEN n > 60 OR bytes > 200000 OR bytes > 150000 THEN 'error' WHEN bytes > 110000 THEN 'warning' ELSE 'ok' END AS verdict
FROM (SELECT source, count(*) AS n, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes FROM documents GROUP BY source)""")
def storage_budget(spark, d):
    """Strict thresholds on sums."""
    sums = read(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    return sums.withColumn("verdict", storage.budget(F.col("n"), F.col("bytes"), F.col("bytes"), 60, 200000, 110000, 150000))


@query("""
SELECT l_orderkey, l_linenumber, count(*) OVER w AS run_objects, sum(l_quantity) OVER w AS run_bytes FROM lineitem
WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber RANGE UNBOUNDED PRECEDING)""")
def running_inventory(spark, d):
    """Running totals inside a run."""
    return storage.running_inventory(read(spark, d, "lineitem"), "l_orderkey", "l_linenumber", "l_quantity").select("l_orderkey", "l_linenumber", "run_objects", "run_bytes")


@query("""
WITH e AS (SELECT c_custkey AS k, c_mktsegment AS p FROM customer),
a AS (SELECT c_custkey + CASE WHEN c_custkey % 5 = 0 THEN 10000000 ELSE 0 END AS k, CASE WHEN c_custkey % 7 = 0 THEN 'other' ELSE c_mktsegment END AS p FROM customer)
SELECT a.k, CASE WHEN e.k IS NULL THEN 'append' WHEN a.p = e.p THEN 'no_op' ELSE 'conflict' END AS effect FROM a LEFT JOIN e USING (k)""")
def immutable_append(spark, d):
    """What an immutable table does with arriving rows."""
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("p"))
    arriving = c.select((F.col("k") + F.when(F.col("k") % 5 == 0, 10000000).otherwise(0)).alias("k"), F.when(F.col("k") % 7 == 0, "other").otherwise(F.col("p")).alias("p"))
    return storage.to_append(c, arriving, "k", "p").select("k", "effect")


@query("""
WITH t AS (SELECT p_partkey + CASE WHEN p_partkey % 11 = 0 THEN 10000000 ELSE 0 END AS k, p_name, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_size END AS p_size FROM part)
SELECT s.p_partkey, CASE WHEN t.k IS NULL THEN 'copy' WHEN s.p_name = t.p_name AND s.p_size IS NOT DISTINCT FROM t.p_size THEN 'unchanged' ELSE 'conflict' END AS action FROM part s LEFT JOIN t ON t.k = s.p_partkey""")
def migration_plan(spark, d):
    """Copy, unchanged, conflict."""
    p = read(spark, d, "part")
    target = p.select((F.col("p_partkey") + F.when(F.col("p_partkey") % 11 == 0, 10000000).otherwise(0)).alias("p_partkey"), "p_name", F.when(F.col("p_partkey") % 13 == 0, F.lit(None)).otherwise(F.col("p_size")).alias("p_size"))
    return storage.migration_plan(p, target, "p_partkey", ["p_name", "p_size"])


@query("""
WITH r AS (SELECT l_orderkey * 10 + l_linenumber AS artifact, l_partkey % 97 AS src, l_suppkey % 11 AS doc, 'p' || l_partkey % 7 AS path FROM lineitem),
o AS (SELECT p_partkey % 97 AS src, p_size % 11 AS doc, 'p' || p_partkey % 7 AS path, p_partkey AS document FROM part),
j AS (SELECT r.artifact, o.document, r.path = o.path AS hit, bool_or(r.path = o.path) OVER (PARTITION BY r.artifact) AS best FROM r JOIN o USING (src, doc))
SELECT artifact, min(document) AS owner, count(*) > 1 AS ambiguous FROM j WHERE hit = best GROUP BY artifact""")
def storage_owner(spark, d):
    """Owners by key, a path match first, ambiguity flagged."""
    refs = read(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("artifact"), (F.col("l_partkey") % 97).alias("src"), (F.col("l_suppkey") % 11).alias("doc"), F.concat(F.lit("p"), (F.col("l_partkey") % 7).cast("string")).alias("path"))
    docs = read(spark, d, "part").select((F.col("p_partkey") % 97).alias("src"), (F.col("p_size") % 11).cast("long").alias("doc"), F.concat(F.lit("p"), (F.col("p_partkey") % 7).cast("string")).alias("path"), F.col("p_partkey").alias("document"))
    return storage.owner_of(refs, docs, ["src", "doc"], "path")


@query("SELECT lower(p_name) AS key, count(DISTINCT p_name) AS n FROM part GROUP BY 1 HAVING count(DISTINCT p_name) > 1")
def path_collisions(spark, d):
    """H7, I8: different paths that fold to the same key."""
    named = read(spark, d, "part").select("p_name", t.collision_key(F.col("p_name")).alias("key"))
    return named.groupBy("key").agg(F.count_distinct("p_name").alias("n")).where("n > 1")


@query("""
SELECT 'orders' AS frame, count(*) AS n FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998
UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998)
UNION ALL SELECT 'customer', count(*) FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998)""")
def scoped_inputs(spark, d):
    """A year range carried along to all that hangs on it."""
    frames = {"orders": read(spark, d, "orders").withColumn("c_custkey", F.col("o_custkey")).withColumn("l_orderkey", F.col("o_orderkey")), "lineitem": read(spark, d, "lineitem"), "customer": read(spark, d, "customer")}
    out = reconcile.scoped(frames, "orders", F.year("o_orderdate"), 1996, 1998, [("lineitem", "orders", "l_orderkey"), ("customer", "orders", "c_custkey")])
    counts = [f.agg(F.count("*").alias("n")).select(F.lit(k).alias("frame"), "n") for k, f in out.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("""
SELECT count(*) AS n FROM (SELECT l_partkey AS k, l_quantity AS q FROM lineitem EXCEPT ALL SELECT l_partkey, CASE WHEN l_orderkey % 50 = 0 THEN l_quantity + 1 ELSE l_quantity END FROM lineitem)""")
def multiset_difference(spark, d):
    """Rows that one multiset has more often."""
    li = read(spark, d, "lineitem")
    a = li.select(F.col("l_partkey").alias("k"), F.col("l_quantity").alias("q"))
    b = li.select("l_partkey", F.when(F.col("l_orderkey") % 50 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    return a.exceptAll(b).agg(F.count("*").alias("n"))


_LINKS = """SELECT p_partkey AS node, p_partkey + 1 AS next FROM part WHERE p_partkey % 7 <> 0 UNION ALL SELECT p_partkey, p_partkey + 2 FROM part WHERE p_partkey % 7 BETWEEN 1 AND 4
  UNION ALL SELECT p_partkey, p_partkey - 3 FROM part WHERE p_partkey % 7 = 5 AND p_partkey % 3 = 0 UNION ALL SELECT p_partkey, -p_partkey FROM part WHERE p_partkey % 50 = 0"""


@query(f"""
WITH RECURSIVE e AS ({_LINKS}), reach AS (SELECT node, next FROM e UNION SELECT r.node, e.next FROM reach r JOIN e ON e.node = r.next)
SELECT DISTINCT a.node, 'cycle' AS problem, CAST(NULL AS BIGINT) AS target FROM reach a JOIN reach b ON a.next = b.node AND b.node = b.next
UNION ALL SELECT node, 'missing', next FROM e WHERE next NOT IN (SELECT p_partkey FROM part)""")
def graph_problems(spark, d):
    """A graph with forks and joins: nodes on or before a cycle, and links to what is not there."""
    parts = read(spark, d, "part").select(F.col("p_partkey").alias("node"))
    node = F.col("node")
    ways = F.array_compact(F.array(
        F.when(node % 7 != 0, node + 1), F.when((node % 7).between(1, 4), node + 2), F.when((node % 7 == 5) & (node % 3 == 0), node - 3), F.when(node % 50 == 0, -node),
    ))
    edges = parts.select("node", F.explode(ways).alias("next"))
    cycles = integrity.leading_into_cycles(edges).select("node", F.lit("cycle").alias("problem"), F.lit(None).cast("long").alias("target"))
    return cycles.unionByName(integrity.missing_targets(edges, parts).select("node", F.lit("missing").alias("problem"), F.col("next").alias("target")))
