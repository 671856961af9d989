"""Queries on publications of periods: plans, fingerprints, weekly references of months, manifests and their checks.

Documents are made from orders by rule.  The SQL writes the same JSON out by itself (:func:`_json`) and hashes it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import calendar as c
from ..functions import identity as i
from ..operators import chains, manifest_files, period_streams, periods, publications
from ..operators.integrity import kept, shared_folder
from ..sources import bundles, zip_members
from .registry import query, read


def _documents(spark, d, changed: str = "o_orderstatus = '?'"):
    """Orders as documents; those that fulfil ``changed`` have another version."""
    key, number = F.col("o_orderkey"), F.col("o_orderkey").cast("string")

    def payload(form: str, there):
        name = F.concat(F.lit("x/"), (key % 7).cast("string"), F.lit("/F"), F.lpad(number, 9, "0"), F.lit(f".{form}"))
        sha = i.sha256(F.concat(number, F.lit(form)))
        return F.when(there, F.struct(
            F.concat(F.lit(f"{form}-"), F.lpad(number, 9, "0")).alias("artifact_id"), name.alias("logical_key"), sha.alias("sha256"), (key % 1000).alias("bytes"), F.concat(F.lit("src:"), number).alias("source_id"),
            i.sha256(number).alias("source_sha256"), F.lit(None).cast("string").alias("decision_sha256"), F.lit("free").alias("rights_state"), F.when(key % 997 == 0, "internal").otherwise("public").alias("visibility"),
            F.concat(F.lit("doc-"), number).alias("document_id"), F.when(F.lit(form == "markdown"), F.concat(F.lit("c-"), number)).alias("conversion_id"),
        ))

    return read(spark, d, "orders").select(
        F.concat(F.lit("doc-"), number).alias("document_id"), F.concat(F.lit("bit-"), number).alias("bitstream_id"), (key % 3 + 1 + F.when(F.expr(changed), 5).otherwise(0)).alias("version"), F.concat(F.lit("src:"), number).alias("source_id"),
        F.col("o_orderdate").cast("date").alias("publication_date"), F.concat("o_orderpriority", F.lit(' "|\x1f\\u001F\n')).alias("title"), F.concat(F.lit("9/"), number).alias("handle"),
        F.when(key % 4 != 0, F.concat(F.lit("10.1234/"), number)).alias("doi"), F.when(key % 5 == 0, "review").otherwise("persisted").alias("conversion_state"), payload("pdf", key % 3 != 0).alias("pdf"), payload("markdown", key % 5 != 0).alias("markdown"),
    )


def _periods(spark, d, *kinds):
    return periods.affected(_documents(spark, d), "publication_date").where(F.col("kind").isin(*kinds))


def _facts(spark, d, asked):
    """Documents, and the facts of the asked periods (a row a period), which are asked for once."""
    docs = _documents(spark, d)
    return docs, kept(period_streams.period_facts(docs, asked))


def _json(value, level: int = 0) -> str:
    """SQL text of stable JSON: a dict of SQL texts, or (list, variable, record) for a list."""
    outer, inner = "  " * level, "  " * (level + 1)
    if isinstance(value, dict):
        return "concat('{', chr(10), " + ", ',', chr(10), ".join(f"'{inner}\"{k}\": ', {_json(value[k], level + 1)}" for k in sorted(value)) + f", chr(10), '{outer}}}')"
    if isinstance(value, tuple):
        rows, name, record = value
        return f"CASE WHEN len({rows}) > 0 THEN concat('[', chr(10), array_to_string(list_transform({rows}, lambda {name}: concat('{inner}', {_json(record, level + 1)})), ',' || chr(10)), chr(10), '{outer}]') ELSE '[]' END"
    shown = f"CAST(to_json({value}) AS VARCHAR)"
    if value.endswith(".title"):  # DuckDB writes this escape in upper case
        shown = f"replace(CAST(to_json(replace({value}, chr(31), '<1f>')) AS VARCHAR), '<1f>', '\\u001f')"
    return f"coalesce({shown}, 'null')"


def _payload_sql(form: str, there: str) -> str:
    conversion = "'c-' || o_orderkey" if form == "markdown" else "CAST(NULL AS VARCHAR)"
    return f"""CASE WHEN {there} THEN {{'artifact_id': '{form}-' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0'), 'logical_key': 'x/' || o_orderkey % 7 || '/F' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '.{form}', 'sha256': sha256(o_orderkey || '{form}'),
      'bytes': o_orderkey % 1000, 'source_id': 'src:' || o_orderkey, 'source_sha256': sha256(CAST(o_orderkey AS VARCHAR)), 'decision_sha256': CAST(NULL AS VARCHAR), 'rights_state': 'free', 'visibility': CASE WHEN o_orderkey % 997 = 0 THEN 'internal' ELSE 'public' END,
      'document_id': 'doc-' || o_orderkey, 'conversion_id': {conversion}}} END"""


def _entries_sql(form: str, folder: str) -> str:
    rows = f"list_filter(documents, lambda x: x.{form} IS NOT NULL)"
    entry = f"{{'path': '{folder}/' || string_split(x.{form}.logical_key, '/')[-1], 'p': x.{form}}}"
    return f"list_sort(list_transform({rows}, lambda x: {entry}))"


_PREPARED = ("artifact_id", "logical_key", "sha256", "bytes", "source_id", "source_sha256", "decision_sha256", "rights_state", "visibility", "document_id", "conversion_id")
_ARCHIVE_SQL = {
    "format_version": "'1'", "archive": {"archive_id": "a.archive_id", "period": "value", "kind": "a.kind"}, "zip_datetime": ("z", "y", "y"), "visibility": "a.visibility",
    "entries": ("a.entries", "w", {"path": "w.path", "bytes": "w.p.bytes", "sha256": "w.p.sha256"}),
}


def _plans_sql(kinds: str, asked: str = "", changed: str = "0") -> str:
    """Common tables up to ``plans`` (with archives) and ``flat`` (an archive a row, with the hash of its inputs)."""
    return f"""
WITH docs AS (SELECT 'doc-' || o_orderkey AS document_id, 'bit-' || o_orderkey AS bitstream_id, o_orderkey % 3 + 1 + {changed} AS version, 'src:' || o_orderkey AS source_id, CAST(o_orderdate AS DATE) AS day, o_orderpriority || ' "|' || chr(31) || chr(92) || 'u001F' || chr(10) AS title,
    '9/' || o_orderkey AS handle, CASE WHEN o_orderkey % 4 <> 0 THEN '10.1234/' || o_orderkey END AS doi, CASE WHEN o_orderkey % 5 = 0 THEN 'review' ELSE 'persisted' END AS conversion_state, {_payload_sql("pdf", "o_orderkey % 3 <> 0")} AS pdf, {_payload_sql("markdown", "o_orderkey % 5 <> 0")} AS markdown FROM orders),
fan AS (SELECT unnest(['week', 'month', 'year']) AS kind, unnest([strftime(day, '%G-W%V'), strftime(day, '%Y-%m'), strftime(day, '%Y')]) AS value, docs AS x FROM docs),
grouped AS (SELECT kind, value, list(x ORDER BY x.day, x.document_id, x.bitstream_id) AS documents FROM fan WHERE kind IN ({kinds}) GROUP BY kind, value),
spans AS (SELECT *, CASE kind WHEN 'week' THEN CAST(strptime(value || '-1', '%G-W%V-%u') AS DATE) WHEN 'month' THEN CAST(value || '-01' AS DATE) ELSE CAST(value || '-01-01' AS DATE) END AS s,
  CASE kind WHEN 'week' THEN CAST(strptime(value || '-7', '%G-W%V-%u') AS DATE) WHEN 'month' THEN last_day(CAST(value || '-01' AS DATE)) ELSE CAST(value || '-12-31' AS DATE) END AS e FROM grouped),
timed AS (SELECT *, CAST(epoch(CAST(e + 1 AS TIMESTAMP) AT TIME ZONE 'Europe/Berlin') AS BIGINT) AS epoch FROM spans {asked}),
placed AS (SELECT *, CASE kind WHEN 'year' THEN 'archive/years/' || value || '/ZIP/articles-' || value ELSE 'archive/months/' || strftime(s, '%Y/%m') || '/ZIP/' || CASE kind WHEN 'week' THEN 'weeks/articles-' || s || '_to_' || e ELSE 'articles-' || value END END AS bundle FROM timed),
plans AS (SELECT *, list_filter([
    {{'archive_id': 'archive-' || kind || '-' || lower(value) || '-markdown', 'kind': kind || '-markdown', 'relative_bundle': bundle || '-Markdown', 'visibility': list_filter(documents, lambda x: x.markdown IS NOT NULL)[1].markdown.visibility, 'entries': {_entries_sql("markdown", "Markdown")}}},
    {{'archive_id': 'archive-' || kind || '-' || lower(value) || '-pdf', 'kind': kind || '-pdf', 'relative_bundle': bundle || '-PDF', 'visibility': list_filter(documents, lambda x: x.pdf IS NOT NULL)[1].pdf.visibility, 'entries': {_entries_sql("pdf", "PDF")}}}
  ], lambda x: len(x.entries) > 0) AS archives FROM placed),
flat AS (SELECT kind, value, s, e, a, sha256({_json(_ARCHIVE_SQL)} || chr(10)) AS fingerprint FROM (
  SELECT *, unnest(archives) AS a, [year(make_timestamp(epoch * 1000000)), month(make_timestamp(epoch * 1000000)), day(make_timestamp(epoch * 1000000)), hour(make_timestamp(epoch * 1000000)), 0, 0] AS z FROM plans)),
problems AS (SELECT kind, value, CASE WHEN bool_or(len(list_distinct(list_transform(a.entries, lambda x: x.p.visibility))) > 1) THEN 'mixed_visibility' END AS problem FROM flat GROUP BY kind, value)"""


_PLAN_SQL = {
    "period": {"kind": "kind", "value": "value", "start": "CAST(s AS VARCHAR)", "end": "CAST(e AS VARCHAR)", "source_date_epoch": "epoch"},
    "documents": ("documents", "q", {x: f"q.{x}" for x in ("document_id", "bitstream_id", "version", "source_id", "title", "handle", "doi", "conversion_state")} | {"publication_date": "CAST(q.day AS VARCHAR)", "pdf": "q.pdf.artifact_id", "markdown": "q.markdown.artifact_id"}),
    "archives": ("archives", "r", {x: f"r.{x}" for x in ("relative_bundle", "archive_id", "kind", "visibility")} | {"entries": ("r.entries", "w", {"path": "w.path"} | {x: f"w.p.{x}" for x in _PREPARED})}),
    "index_path": "CASE WHEN kind = 'month' THEN 'archive/months/' || strftime(s, '%Y/%m') || '/Markdown/index.md' END", "manifest_path": "'archive/manifests/' || kind || '/' || value || '.json'",
}


@query(_plans_sql("'week', 'month'") + f"""
SELECT kind, value, len(documents) AS documents, len(archives) AS archives, problem, sha256({_json(_PLAN_SQL)} || chr(10)) AS plan_sha256 FROM plans LEFT JOIN problems USING (kind, value)""")
def period_plans(spark, d):
    """Documents and archives of each week and month, with the hash of the plan."""
    docs, facts = _facts(spark, d, _periods(spark, d, "week", "month"))
    hashed = period_streams.plan_digests(docs, facts)
    return facts.select("kind", "value", F.col("n").alias("documents"), F.size("archives").cast("long").alias("archives"), "problem").join(hashed, ["kind", "value"])


_RECENT = "QUALIFY row_number() OVER (PARTITION BY kind ORDER BY s DESC) <= CASE kind WHEN 'week' THEN 8 WHEN 'month' THEN 3 ELSE 1 END"


@query(_plans_sql("'week', 'month', 'year'", _RECENT) + f"""
SELECT count(*) AS periods, sha256(concat('[', chr(10), string_agg(concat('  ', {_json(_PLAN_SQL, 1)}), ',' || chr(10) ORDER BY CASE kind WHEN 'week' THEN 0 WHEN 'month' THEN 1 ELSE 2 END, s), chr(10), ']', chr(10))) AS input_fingerprint FROM plans""")
def plan_fingerprint(spark, d):
    """K6: the hash of a whole plan of bounded catch-up: the last eight weeks, three months and one year."""
    newest = Window.partitionBy("kind").orderBy(F.desc("value"))
    most = F.when(F.col("kind") == "week", 8).when(F.col("kind") == "month", 3).otherwise(1)
    asked = _periods(spark, d, "week", "month", "year").withColumn("n", F.row_number().over(newest)).where(F.col("n") <= most)
    return period_streams.plan_digest(*_facts(spark, d, asked))


_REFERENCE_SQL = {"period": "r.value", "archive_id": "r.a.archive_id", "kind": "r.a.kind", "relative_bundle": "r.a.relative_bundle", "input_fingerprint": "r.fingerprint", "output_sha256": "r.o", "bytes": "r.b"}


@query(_plans_sql("'week', 'month'") + f""",
refs AS (SELECT value, s, e, a, CASE WHEN value LIKE '%-W_3' THEN sha256(a.archive_id) ELSE fingerprint END AS fingerprint, CASE WHEN value LIKE '%-W_3' THEN sha256(value) END AS o, CASE WHEN value LIKE '%-W_3' THEN 77 END AS b FROM flat WHERE kind = 'week'),
months AS (SELECT m.value AS month, list({{'value': r.value, 'a': r.a, 'fingerprint': r.fingerprint, 'o': r.o, 'b': r.b}} ORDER BY r.s, r.a.kind <> 'week-pdf') AS refs FROM plans m JOIN refs r ON m.kind = 'month' AND r.s <= m.e AND r.e >= m.s GROUP BY m.value)
SELECT month, len(refs) AS n, sha256({_json(("refs", "r", _REFERENCE_SQL))} || chr(10)) AS input_fingerprint FROM months""")
def month_references(spark, d):
    """The weekly archives of each month, planned now or published before (every third week of ten)."""
    docs, facts = _facts(spark, d, _periods(spark, d, "week", "month"))
    whole = period_streams.archive_digests(docs, facts.where("kind = 'week'"))
    old = F.col("value").rlike("-W.3$")
    before = period_streams.weekly_references(whole.where(old)).withColumns({"input_fingerprint": i.sha256(F.col("archive_id")), "output_sha256": i.sha256(F.col("value")), "bytes": F.lit(77).cast("long")})
    references = period_streams.weekly_references(whole.where(~old)).unionByName(before)
    found = publications.month_references(facts.where("kind = 'month'").select("value"), references)
    return found.select("month", F.size("references").cast("long").alias("n"), "input_fingerprint")


_CELL = "replace(replace(replace({}, '|', '&#124;'), chr(92), '&#92;'), chr(10), ' ')"
_FILE = "CASE WHEN q.{0} IS NOT NULL THEN '[{1}](../../../../../' || q.{0}.logical_key || ')' ELSE '—' END"


@query(_plans_sql("'week', 'month'") + f""",
weeks AS (SELECT s, e, strftime(s, '%Y') AS yy, strftime(s, '%m') AS mm, a.kind <> 'week-pdf' AS k, CASE WHEN a.kind = 'week-pdf' THEN 'PDF' ELSE 'Markdown' END AS name, split_part(a.relative_bundle, '/ZIP/', 2) AS tail FROM flat WHERE kind = 'week'),
met AS (SELECT value, string_agg('[' || name || '](' || CASE WHEN yy || '-' || mm = value THEN '../ZIP/' WHEN yy = left(value, 4) THEN '../../' || mm || '/ZIP/' ELSE '../../../' || yy || '/' || mm || '/ZIP/' END || tail || '/archive.zip)', ' ' ORDER BY w.s, k) AS links
  FROM plans p JOIN weeks w ON p.kind = 'month' AND w.s <= p.e AND w.e >= p.s GROUP BY value),
m AS (SELECT value, s, documents, coalesce(links, '') AS links FROM plans LEFT JOIN met USING (value) WHERE kind = 'month')
SELECT value, 'archive/months/' || strftime(s, '%Y/%m') || '/Markdown/index.md' AS index_path, sha256(concat('# Articles ', value, chr(10), chr(10), 'Articles: ', len(documents), chr(10), chr(10),
  '| Date | Title | Handle | Bitstream | DOI | PDF | Markdown | Conversion | PDF SHA-256 | Markdown SHA-256 | Weekly archives |', chr(10), '|', repeat(' --- |', 11), chr(10),
  array_to_string(list_transform(documents, lambda q: concat('| ', q.day, ' | ', {_CELL.format("q.title")}, ' | ', q.handle, ' | ', q.bitstream_id, ' | ', coalesce(q.doi, '—'), ' | ', {_FILE.format("pdf", "PDF")}, ' | ', {_FILE.format("markdown", "Markdown")}, ' | ',
    q.conversion_state, ' | ', coalesce(q.pdf.sha256, '—'), ' | ', coalesce(q.markdown.sha256, '—'), ' | ', links, ' |')), chr(10)), chr(10), chr(10), '## Weekly archives', chr(10), chr(10), CASE WHEN links = '' THEN '—' ELSE links END, chr(10))) AS body_sha256 FROM m""")
def linked_month_indexes(spark, d):
    """The index of each month, with links to files and to the weekly archives that share a day with it."""
    docs, facts = _facts(spark, d, _periods(spark, d, "week", "month"))
    references = period_streams.weekly_references(period_streams.archive_digests(docs, facts.where("kind = 'week'")))
    return period_streams.month_index_digests(docs, facts, references)


def _builds(stated, spoilt=None):
    """Builds of all archives: the hash of what they would hold follows from the id."""
    fingerprint = F.col("input_fingerprint")
    if spoilt is not None:
        fingerprint = F.when(spoilt, i.sha256(F.col("value"))).otherwise(fingerprint)
    return stated.select("value", "a.archive_id", fingerprint.alias("input_fingerprint"), i.sha256(F.col("a.archive_id")).alias("output_sha256"), (F.col("a.n") * 11).alias("bytes"))


def _manifest_sql(fingerprint: str | None) -> dict:
    out = {
        "schema_version": "'1.0.0'", "kind": "kind", "period": "value", "timezone": "'Europe/Berlin'", "start_date": "CAST(s AS VARCHAR)", "end_date": "CAST(e AS VARCHAR)", "source_date_epoch": "epoch", "month_manifests": ("months", "k", "k"),
        "documents": ("documents", "q", {x: f"q.{x}" for x in ("document_id", "bitstream_id", "doi", "version", "source_id")} | {"publication_date": "CAST(q.day AS VARCHAR)"} | {f"{f}_{o}": f"q.{f}.{n}" for f in ("pdf", "markdown") for o, n in (("artifact_id", "artifact_id"), ("sha256", "sha256"))}),
        "archives": ("built", "r", {x: f"r.a.{x}" for x in ("archive_id", "kind", "relative_bundle")} | {"input_fingerprint": "r.fingerprint", "output_sha256": "sha256(r.a.archive_id)", "bytes": "len(r.a.entries) * 11", "storage_reference": "NULL"}),
    }
    return out if fingerprint is None else out | {"input_fingerprint": fingerprint}


def _bodies_sql(plans_sql: str) -> str:
    return plans_sql + f""",
built AS (SELECT kind, value, list({{'a': a, 'fingerprint': fingerprint}} ORDER BY a.archive_id) AS built FROM flat GROUP BY kind, value),
parts AS (SELECT *, CASE WHEN kind = 'year' THEN list_transform(list_sort(list_distinct(list_transform(documents, lambda x: strftime(x.day, '%Y-%m')))), lambda m: 'archive/manifests/month/' || m || '.json') ELSE CAST([] AS VARCHAR[]) END AS months FROM (SELECT * REPLACE (coalesce(built, []) AS built) FROM plans LEFT JOIN built USING (kind, value))),
hashed AS (SELECT *, sha256({_json(_manifest_sql(None))} || chr(10)) AS fp FROM parts),
bodies AS (SELECT kind, value, 'archive/manifests/' || kind || '/' || value || '.json' AS manifest_path, fp AS input_fingerprint, {_json(_manifest_sql("fp"))} || chr(10) AS body FROM hashed)"""


@query(_bodies_sql(_plans_sql("'week', 'month', 'year'")) + """
, found AS (SELECT kind, value, manifest_path, input_fingerprint, body, coalesce(problem, CASE WHEN value LIKE '%-07' THEN 'missing_build' WHEN value LIKE '%-11' THEN 'other_inputs' END) AS p FROM bodies LEFT JOIN problems USING (kind, value))
SELECT kind, value, manifest_path, CASE WHEN p IS NULL THEN input_fingerprint END AS input_fingerprint, CASE WHEN p IS NULL THEN sha256(body) END AS body_sha256, p AS problem FROM found""")
def period_manifests(spark, d):
    """The manifest of each period, its own hash and that of its inputs; builds that are missing or of other inputs."""
    docs, facts = _facts(spark, d, _periods(spark, d, "week", "month", "year"))
    stated = kept(period_streams.archive_digests(docs, facts))
    builds = _builds(stated, F.col("value").endswith("-11")).where(~(F.col("value").endswith("-07") & F.col("archive_id").endswith("-pdf")))
    out = period_streams.manifest_digests(docs, facts, stated, builds)
    valid = F.col("problem").isNull()
    return out.select("kind", "value", "manifest_path", F.when(valid, F.col("input_fingerprint")).alias("input_fingerprint"), F.when(valid, F.col("body_sha256")).alias("body_sha256"), "problem")


@query(_plans_sql("'month'") + """
SELECT value, CASE WHEN problem IS NULL THEN CASE right(value, 2) WHEN '01' THEN 'not_canonical' WHEN '02' THEN 'schema' WHEN '03' THEN 'period' WHEN '04' THEN 'not_json' WHEN '05' THEN 'duplicate_key' WHEN '06' THEN 'fingerprint' WHEN '07' THEN 'archive_name'
  WHEN '08' THEN CASE WHEN len(list_filter(documents, lambda x: x.doi IS NULL)) > 0 THEN 'schema' END WHEN '09' THEN 'month_manifests' WHEN '10' THEN 'schema' END ELSE 'not_json' END AS problem FROM plans LEFT JOIN problems USING (kind, value)""")
def manifest_findings(spark, d):
    """Manifests read back, each month of the year with another fault."""
    docs, facts = _facts(spark, d, _periods(spark, d, "month"))
    whole = facts.where("problem IS NULL")
    stated = kept(period_streams.archive_digests(docs, whole))
    valid, pieces, text = period_streams.manifest_bodies(docs, whole, stated, _builds(stated))

    def spoilt(body):
        month, begins, ends = F.substring("path", -7, 2), F.col("section") == 0, F.col("section") == 2
        swap = lambda a, b: F.replace(body, F.lit(a), F.lit(b))
        return (
            F.when(body == "{", body).when((month == "01") & ends, F.concat(body, F.lit(" "))).when(month == "02", swap('"timezone": "Europe/Berlin"', '"timezone": "UTC"')).when(month == "03", F.regexp_replace(body, '"end_date": "[0-9-]{8}', '"end_date": "1990-01-'))
            .when((month == "04") & begins, F.concat(F.lit("{"), body)).when(month == "05", swap('  "timezone"', '  "timezone": "x",\n  "timezone"')).when(month == "06", swap('"source_id": "src:', '"source_id": "s:'))
            .when(month == "07", swap('"relative_bundle": "archive/', '"relative_bundle": "elsewhere/')).when(month == "08", swap('"doi": null', '"doi": 5')).when(month == "09", swap('"month_manifests": []', '"month_manifests": ["x"]'))
            .when(month == "10", swap('"version": ', '"extra": 1,\n "version": ')).otherwise(body)
        )

    # a month without a manifest is written as what is no JSON
    missing = facts.join(valid, ["kind", "value"], "left_anti").select("kind", "value", F.lit(0).alias("section"), F.lit("{").alias("text"))
    pieces = pieces.unionByName(missing, allowMissingColumns=True).withColumn("path", F.concat("value", F.lit(".json")))
    root = f"{shared_folder(docs)}/manifests-{uuid.uuid4().hex}"
    chains.written(pieces, ["section", "k1", "k2", "k3"], text, root, spoilt).write.format("noop").mode("overwrite").save()
    files = spark.read.format("binaryFile").load(root).select(F.regexp_extract("path", "([^/]+)$", 1).alias("path"))
    return manifest_files.manifest_problems(files, root).select(F.regexp_extract("path", r"(.+)\.json$", 1).alias("value"), "problem")


@query("""
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, doc_id, text FROM documents JOIN orders ON o_orderkey = doc_id WHERE text <> ''),
n AS (SELECT 'month-' || month || '.zip' AS archive, month, 'Markdown/F' || lpad(CAST(doc_id AS VARCHAR), 9, '0') || '.md' AS member, strlen(text) AS bytes, sha256(text) AS sha256, row_number() OVER (PARTITION BY month ORDER BY doc_id) AS k FROM m)
SELECT DISTINCT archive, CASE WHEN month LIKE '%-05' THEN NULL ELSE member END AS member, CASE WHEN month LIKE '%-05' THEN NULL ELSE bytes END AS bytes, CASE WHEN month LIKE '%-05' OR month LIKE '%-06' AND k = 1 THEN NULL ELSE sha256 END AS sha256,
  CASE WHEN month LIKE '%-05' THEN 'not_zip' WHEN month LIKE '%-06' AND k = 1 THEN 'damaged' END AS problem FROM n""")
def archive_members(spark, d):
    """Archives of each month's texts, written as files and read back by ranges of members; some are damaged."""
    dates = read(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    texts = read(spark, d, "documents").where("text <> ''").join(dates, "doc_id")
    name = F.concat(F.lit("Markdown/F"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit(".md"))
    made = bundles.build(texts.select(F.concat(F.lit("month-"), "month").alias("archive_id"), F.lit(86400 * 365 * 20).alias("epoch"), name.alias("path"), F.col("text").cast("binary").alias("content")))
    content, key = F.col("content"), F.col("archive_id")
    spoilt = F.when(key.endswith("-05"), F.substring(content, F.lit(1), F.octet_length(content) - 30)).when(key.endswith("-06"), F.overlay(content, F.unhex(F.lit("FF")), 53)).otherwise(content)
    root = f"{shared_folder(made)}/archives-{uuid.uuid4().hex}"
    zip_members.write_files(made.select(F.concat("archive_id", F.lit(".zip")).alias("path"), spoilt.alias("content")), root).write.format("noop").mode("overwrite").save()
    zip_members.register(spark)
    found = spark.read.format("zip_members").option("split_bytes", 4096).load(root)
    return found.where("member IS NULL OR member LIKE 'Markdown/%'").select(F.regexp_extract("archive", r"([^/]+)$", 1).alias("archive"), "member", "bytes", "sha256", "problem")
