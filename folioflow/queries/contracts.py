"""Queries on contracts: URL rules, schema steps, rendered headers, prepared objects."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as c
from ..functions import identity as i
from ..functions import text as t
from ..functions import urls as u
from ..plans import documents as plans
from ..plans import versions
from .registry import query, read


@query(r"""
SELECT page_id, regexp_matches(url, '^https://') AND NOT regexp_matches(url, '^https://[^/?#]*[@:]') AND regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) IN ('tionsh.example.net', 'therst.example.net') AS allowed,
  regexp_replace(url, '#.*$', '') AS plain FROM pages""")
def url_rules(spark, d):
    """Allowed URLs, fragments dropped."""
    return read(spark, d, "pages").select("page_id", u.allowed(F.col("url"), ["tionsh.example.net", "therst.example.net"]).alias("allowed"), u.without_fragment(F.col("url")).alias("plain"))


@query(r"""
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN bare ELSE bare || CASE WHEN contains(bare, '?') THEN '&' ELSE '?' END || 'offset=' || page_id END AS next
FROM (SELECT page_id, regexp_replace(url, '#.*$', '') AS bare FROM pages)""")
def offset_urls(spark, d):
    """The offset parameter of a listing."""
    return read(spark, d, "pages").select("page_id", u.with_offset(F.col("url"), F.when(F.col("page_id") % 3 == 0, 0).otherwise(F.col("page_id"))).alias("next"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%G-W%V') AS week, strftime(o_orderdate, '%Y-%m') AS month, year(o_orderdate) AS year, 'legacy' AS provenance_state, o_orderstatus AS status FROM orders""")
def migrated_documents(spark, d):
    """The document contract, one version on."""
    old = read(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("publication_date"), F.col("o_orderstatus").alias("status"))
    return versions.migrate("document", "1.0", old)[1].select("o_orderkey", "canonical_periods.*", "provenance_state", "status")


@query("""
SELECT c_custkey, '---' || chr(10) || 'name: "' || c_name || '"' || chr(10) || 'segment: ' || CASE WHEN c_custkey % 4 = 0 THEN 'null' ELSE '"' || c_mktsegment || '"' END || chr(10) || 'id: "' || c_custkey || '"' || chr(10) || '---' || chr(10) AS header FROM customer""")
def front_matter(spark, d):
    """Headers of JSON-quoted scalars."""
    segment = F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment"))
    return read(spark, d, "customer").select("c_custkey", plans.front_matter({"name": F.col("c_name"), "segment": segment, "id": F.col("c_custkey")}).alias("header"))


@query("""
SELECT doc_id, md5(string_agg('<!-- page: ' || k || ' -->' || chr(10) || page, chr(10) || chr(10) ORDER BY k) || chr(10)) AS marked
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS page, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents) GROUP BY doc_id""")
def page_markers(spark, d):
    """Pages with numbered markers."""
    return read(spark, d, "documents").select("doc_id", F.md5(t.page_markers(F.split("text", "\n"))).alias("marked"))


@query("""
SELECT p_partkey, CASE WHEN length(p_name || '+' || p_type || '+' || p_brand || '+' || p_name) > 40 THEN 'sha256:' || sha256(p_name || '+' || p_type || '+' || p_brand || '+' || p_name) ELSE p_name || '+' || p_type || '+' || p_brand || '+' || p_name END AS identity,
  CASE WHEN starts_with(p_brand, 'Brand#1') THEN p_brand ELSE 'Brand#1' || p_brand END AS key FROM part""")
def tool_identities(spark, d):
    """Joined identities, hashed where they are long; prefixes once."""
    name = F.array("p_name", "p_type", "p_brand", "p_name")
    return read(spark, d, "part").select("p_partkey", t.joined_identity(name, "+", 40).alias("identity"), i.storage_key("Brand#1", F.col("p_brand")).alias("key"))


@query("""
SELECT s.s_suppkey, s.s_nationkey = n.n_nationkey AND n.n_regionkey IS NOT DISTINCT FROM CASE WHEN s.s_suppkey % 6 = 0 THEN 99 ELSE n.n_regionkey END AS agrees FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey""")
def prepared_objects(spark, d):
    """Planned rows against prepared ones, all columns compared as values."""
    planned = read(spark, d, "supplier").select("s_suppkey", F.struct(F.col("s_nationkey").alias("nation")).alias("p"), F.col("s_nationkey").alias("n_nationkey"))
    prepared = read(spark, d, "nation")
    joined = planned.join(prepared, "n_nationkey")
    stated = F.struct("p.nation", F.when(F.col("s_suppkey") % 6 == 0, 99).otherwise(F.col("n_regionkey")).alias("region"))
    return joined.select("s_suppkey", stated.eqNullSafe(F.struct(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("region"))).alias("agrees"))


@query("""
WITH e AS (SELECT strftime(o_orderdate, '%Y-%m') AS value, o_orderkey AS doc FROM orders),
p AS (SELECT value, CASE WHEN doc % 211 = 0 THEN doc + 100000000 ELSE doc END AS doc FROM e),
off AS (SELECT value, 'missing' AS off FROM (SELECT * FROM e EXCEPT SELECT * FROM p) UNION ALL SELECT value, 'extra' FROM (SELECT * FROM p EXCEPT SELECT * FROM e))
SELECT value, count(*) FILTER (off = 'missing') AS n_missing, count(*) FILTER (off = 'extra') AS n_extra FROM off GROUP BY value""")
def period_membership(spark, d):
    """Documents of a period against what was published."""
    from ..operators.reconcile import membership_findings

    e = read(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("value"), F.col("o_orderkey").alias("doc"))
    p = e.withColumn("doc", F.when(F.col("doc") % 211 == 0, F.col("doc") + 100000000).otherwise(F.col("doc")))
    return membership_findings(e, p, ["value"], "doc")


@query("SELECT o_orderkey, strftime(make_timestamp(o_orderkey * 98765 * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS generated_at, o_orderkey % 3 <> 0 AND o_orderkey % 7 + 1987 >= 1990 AND o_orderkey % 5 < 4 AS valid FROM orders")
def run_clocks(spark, d):
    """Reproducible build times; times and years of a run."""
    key = F.col("o_orderkey")
    first = (key % 7 + 1987).cast("int")
    at = F.timestamp_micros(key * 1_000_000 + F.when(key % 3 == 0, 1).otherwise(0))
    valid = c.scope_valid(at, first, F.when(key % 5 < 4, first + 5).otherwise(first - 1))
    return read(spark, d, "orders").select("o_orderkey", c.generated_at(key * 98765).alias("generated_at"), valid.alias("valid"))


@query(r"""
SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN 'title' WHEN p_partkey % 11 = 0 THEN 'publication_date' WHEN NOT regexp_full_match(p_size || '/2024', '(0?[1-9]|[1-4][0-9]|5[0-3])/[0-9]{4}') THEN 'bulletin_number'
  WHEN p_partkey % 4 <> 0 AND NOT regexp_full_match('10.' || p_partkey || '/' || p_type, '10\.[0-9]{4,9}/\S+') THEN 'doi' END AS problem FROM part""")
def header_problems(spark, d):
    """Fields of a header that are not in their form."""
    key = F.col("p_partkey")
    title = F.when(key % 26 == 0, F.concat("p_name", F.lit("\x07"))).when(key % 13 == 0, F.lit("e\u0301")).otherwise(F.col("p_name"))
    doi = F.when(key % 4 != 0, F.concat(F.lit("10."), key.cast("string"), F.lit("/"), "p_type"))
    day = F.when(key % 11 == 0, F.lit("1989-12-31")).otherwise(F.lit("1990-01-01")).cast("date")
    return read(spark, d, "part").select("p_partkey", plans.header_problem(title, day, F.concat(F.col("p_size").cast("string"), F.lit("/2024")), doi).alias("problem"))
