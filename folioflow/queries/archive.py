"""Queries on periods, paths, archives and texts of the archive."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as c
from ..functions import identity as i
from ..functions import text as t
from ..operators import periods, storage
from ..plans import documents as plans
from .registry import query, read

_AFFECTED = """SELECT DISTINCT kind, value FROM (
  SELECT 'week' AS kind, strftime(o_orderdate, '%G-W%V') AS value FROM orders UNION ALL SELECT 'month', strftime(o_orderdate, '%Y-%m') FROM orders UNION ALL SELECT 'year', strftime(o_orderdate, '%Y') FROM orders)"""
_DATED = """SELECT kind, value,
  CASE kind WHEN 'week' THEN CAST(strptime(value || '-1', '%G-W%V-%u') AS DATE) WHEN 'month' THEN CAST(value || '-01' AS DATE) ELSE CAST(value || '-01-01' AS DATE) END AS "start",
  CASE kind WHEN 'week' THEN CAST(strptime(value || '-7', '%G-W%V-%u') AS DATE) WHEN 'month' THEN last_day(CAST(value || '-01' AS DATE)) ELSE CAST(value || '-12-31' AS DATE) END AS "end" FROM ({})"""


def orders(spark, d):
    return read(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("date"))


@query(_AFFECTED)
def affected_periods(spark, d):
    """Distinct weeks, months and years of dated records."""
    return periods.affected(orders(spark, d), "day")


@query(f"""
WITH due AS (SELECT DISTINCT 'month' AS kind, strftime(l_shipdate, '%Y-%m') AS value FROM lineitem),
p AS (SELECT * FROM due UNION SELECT * FROM ({_AFFECTED}))
SELECT kind, value, CAST("start" AS VARCHAR) AS "start", CAST("end" AS VARCHAR) AS "end", CAST(epoch(CAST("end" + 1 AS TIMESTAMP) AT TIME ZONE 'Europe/Berlin') AS BIGINT) AS closes,
  epoch(CAST("end" + 1 AS TIMESTAMP) AT TIME ZONE 'Europe/Berlin') > epoch(TIMESTAMP '1999-06-15 12:00:00') AS open FROM ({_DATED.format("SELECT * FROM p")})""")
def selected_periods(spark, d):
    """Due and late periods with their closing instants."""
    due = read(spark, d, "lineitem").select(F.lit("month").alias("kind"), F.date_format("l_shipdate", "yyyy-MM").alias("value")).distinct()
    out = periods.select_periods(due, periods.affected(orders(spark, d), "day"), F.lit("1999-06-15 12:00:00").cast("timestamp"))
    return out.select("kind", "value", F.col("start").cast("string"), F.col("end").cast("string"), "closes", "open")


@query("""
WITH t AS (
  SELECT 'week' AS kind, strftime(w, '%G-W%V') AS value FROM (SELECT unnest(generate_series(DATE '2024-05-06', DATE '2024-07-08', INTERVAL 7 DAY)) AS w ORDER BY 1 LIMIT 8)
  UNION ALL SELECT 'month', strftime(m, '%Y-%m') FROM (SELECT unnest(generate_series(DATE '2024-04-01', DATE '2024-06-01', INTERVAL 1 MONTH)) AS m ORDER BY 1 LIMIT 3)
  UNION ALL SELECT 'year', '2023' UNION ALL SELECT 'reconciliation', '2024-07-17T09:00:00Z')
SELECT kind, value, kind || ':' || value AS task_id, CASE kind WHEN 'week' THEN 0 WHEN 'month' THEN 1 WHEN 'year' THEN 2 ELSE 3 END AS rank FROM t""")
def due_tasks(spark, d):
    """Bounded catch-up after watermarks, oldest first."""
    return periods.due_tasks(spark, "2024-07-17 09:00:00", "2024-04-29", "2024-03-01", "2022-01-01", "2024-04-01 00:00:00")


@query("SELECT 'year' AS kind, CAST(y AS VARCHAR) AS value FROM generate_series(1995, 2004) g(y)")
def backfill_tasks(spark, d):
    """An explicit bounded range of years."""
    return periods.backfill(spark, 1995, 2004)


@query(f"""
WITH p AS ({_DATED.format(_AFFECTED)})
SELECT w.value AS week, m.value AS month FROM p w JOIN p m ON w.kind = 'week' AND m.kind = 'month' AND w."start" <= m."end" AND w."end" >= m."start" """)
def week_month_overlap(spark, d):
    """Weeks and months that share a day, as an equi-join."""
    p = periods.affected(orders(spark, d), "day").withColumns({"start": c.period_start(F.col("kind"), F.col("value")), "end": c.period_end(F.col("kind"), F.col("value"))})
    return periods.overlapping(p.where("kind = 'week'").select("value", "start", "end"), p.where("kind = 'month'").select("value")).select(F.col("value").alias("week"), "month")


@query("""
WITH conv AS (SELECT l_orderkey, l_linenumber * 1000000 + l_suppkey AS conversion_id, CASE WHEN l_linestatus = 'F' THEN 'persisted' ELSE 'review' END AS state FROM lineitem),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY state <> 'persisted', conversion_id) AS k FROM conv) WHERE k = 1)
SELECT p.kind, p.value, count(*) AS documents, count(b.conversion_id) AS converted, count(*) FILTER (b.state = 'persisted') AS persisted
FROM orders o LEFT JOIN best b ON b.l_orderkey = o.o_orderkey,
  LATERAL (SELECT unnest(['week', 'month', 'year']) AS kind, unnest([strftime(o_orderdate, '%G-W%V'), strftime(o_orderdate, '%Y-%m'), strftime(o_orderdate, '%Y')]) AS value) p GROUP BY ALL""")
def period_documents(spark, d):
    """Documents of each period with their preferred conversion."""
    conv = read(spark, d, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 1000000 + F.col("l_suppkey")).alias("conversion_id"), F.when(F.col("l_linestatus") == "F", "persisted").otherwise("review").alias("state"))
    docs = orders(spark, d).select(F.col("o_orderkey").alias("l_orderkey"), "day")
    out = periods.period_documents(docs, "day", conv, "l_orderkey")
    return out.groupBy("kind", "value").agg(F.count("*").alias("documents"), F.count("conversion_id").alias("converted"), F.count_if(F.col("state") == "persisted").alias("persisted"))


@query("""
WITH m AS (SELECT 'month' AS kind, strftime(o_orderdate, '%Y-%m') AS value, CASE WHEN o_orderkey % 2 = 0 THEN 'pdf' ELSE 'markdown' END AS format, 'x/' || o_orderkey % 3 || '/' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') || '.f' AS path,
  'x' || o_orderkey AS base, sha256(CAST(o_orderkey AS VARCHAR)) AS h, o_orderkey % 1000 AS bytes, CASE WHEN o_orderkey % 501 = 0 THEN 'internal' ELSE 'public' END AS vis FROM orders)
SELECT kind, value, format, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes, sha256(array_to_string(['{', '  "archive": {', '    "archive_id": "archive-' || kind || '-' || lower(value) || '-' || format || '",', '    "kind": "' || kind || '-' || format || '",', '    "period": "' || value || '"', '  },', '  "entries": [',
    string_agg('    {' || chr(10) || '      "bytes": ' || bytes || ',' || chr(10) || '      "path": "' || path || '",' || chr(10) || '      "sha256": "' || h || '"' || chr(10) || '    }', ',' || chr(10) ORDER BY path), '  ],',
    '  "format_version": "1",', '  "visibility": "' || min(vis) || '",', '  "zip_datetime": [', '    ' || CAST(left(value, 4) AS INT) || ',', '    ' || CAST(right(value, 2) AS INT) || ',', '    1,', '    6,', '    7,', '    8', '  ]', '}', ''], chr(10))) AS fingerprint,
  count(DISTINCT vis) > 1 AS mixed, count(DISTINCT base) < count(*) AS collision, 'archive-' || kind || '-' || lower(value) || '-' || format AS archive_id FROM m GROUP BY kind, value, format""")
def planned_archives(spark, d):
    """Archives of each period and format."""
    o = orders(spark, d)
    key = F.col("o_orderkey")
    members = o.select(
        F.lit("month").alias("kind"), F.date_format("day", "yyyy-MM").alias("value"), F.when(key % 2 == 0, "pdf").otherwise("markdown").alias("format"),
        F.concat(F.lit("x/"), (key % 3).cast("string"), F.lit("/"), F.lpad(key.cast("string"), 9, "0"), F.lit(".f")).alias("path"), i.sha256(key.cast("string")).alias("sha256"),
        (key % 1000).alias("bytes"), F.when(key % 501 == 0, "internal").otherwise("public").alias("visibility"),
        (F.unix_date(F.trunc("day", "month")) * F.lit(86400).cast("long") + 6 * 3600 + 7 * 60 + 9).alias("epoch"),
    )
    return periods.planned_archives(members)


@query("""
SELECT strftime(o_orderdate, '%Y-%m') AS month, string_agg('| ' || o_orderkey || ' | ' || CAST(o_orderdate AS DATE) || ' | ' || replace(o_orderpriority, '|', '&#124;') || ' |', chr(10) ORDER BY o_orderkey) AS body, count(*) AS n FROM orders GROUP BY 1""")
def month_index(spark, d):
    """An ordered Markdown table for each month."""
    return plans.index_table(orders(spark, d), F.date_format("day", "yyyy-MM"), "o_orderkey", [F.col("o_orderkey").cast("string"), F.col("day").cast("string"), t.table_cell(F.col("o_orderpriority"))])


@query("""
WITH now AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1),
late AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders WHERE o_orderstatus = 'P')
SELECT month, n * CASE WHEN month IN (SELECT month FROM late) THEN 2 ELSE 1 END AS n FROM now""")
def rebuilt_periods(spark, d):
    """Late periods are rebuilt, all others stay."""
    o = orders(spark, d).withColumn("month", F.date_format("day", "yyyy-MM"))
    now = o.groupBy("month").agg(F.count("*").alias("n"))
    rebuilt = now.join(o.where("o_orderstatus = 'P'").select("month").distinct(), "month", "left_semi").withColumn("n", F.col("n") * 2)
    return storage.replace_partitions(now, rebuilt, ["month"])


@query("""
SELECT o_orderkey, 'years/' || CASE WHEN o_orderpriority LIKE '1%' THEN year(o_orderdate) || '' ELSE '' END AS x,
  CASE WHEN o_orderpriority LIKE '1%' THEN 'years/' || year(o_orderdate) ELSE 'articles/' || strftime(o_orderdate, '%Y/%m') END || '/PDF/' || CAST(o_orderdate AS DATE) || '_' ||
  CASE WHEN o_orderpriority LIKE '1%' THEN 'issue' ELSE 'article' END || '_doc-' || o_orderkey || '_bitstream-' || sha256(CAST(o_orderkey AS VARCHAR)) || '.pdf' AS pdf FROM orders""".replace("'years/' || CASE WHEN o_orderpriority LIKE '1%' THEN year(o_orderdate) || '' ELSE '' END AS x,\n ", ""))
def document_paths(spark, d):
    """Canonical paths."""
    kind = F.when(F.col("o_orderpriority").startswith("1"), "issue").otherwise("article")
    key = F.col("o_orderkey").cast("string")
    p = i.document_paths(F.concat(F.lit("doc-"), key), i.bitstream_id(key), kind, F.col("day"))
    return orders(spark, d).select("o_orderkey", p["pdf"].alias("pdf"))


@query(f"""
SELECT kind, value, CASE kind WHEN 'week' THEN 'archive/months/' || strftime("start", '%Y/%m') || '/ZIP/weeks/articles-' || "start" || '_to_' || "end" || '-PDF'
  WHEN 'month' THEN 'archive/months/' || strftime("start", '%Y/%m') || '/ZIP/articles-' || value || '-PDF' ELSE 'archive/years/' || value || '/ZIP/articles-' || value || '-PDF' END AS path FROM ({_DATED.format(_AFFECTED)})""")
def bundle_paths(spark, d):
    """I16: bundle paths by kind."""
    p = periods.affected(orders(spark, d), "day")
    kind, value = F.col("kind"), F.col("value")
    return p.select("kind", "value", i.bundle_path(kind, value, c.period_start(kind, value), c.period_end(kind, value), F.lit("pdf")).alias("path"))


@query("""
WITH p AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS pages FROM documents),
v AS (SELECT doc_id, pages, list_transform(pages, lambda x: length(regexp_replace(x, '\\s', '', 'g'))) AS vis FROM p)
SELECT doc_id, CAST(list_sum(vis) AS BIGINT) AS visible, len(list_filter(vis, lambda x: x = 0)) AS n_empty, 
  array_to_string(list_filter([CASE WHEN len(pages) <> 3 + doc_id % 4 THEN 'page_count_mismatch' END, CASE WHEN len(list_filter(vis, lambda x: x < 40)) > 0 THEN 'too_few_characters' END], lambda x: x IS NOT NULL), ',') AS reasons FROM v""")
def text_quality(spark, d):
    """Visible characters, empty pages, reasons in order."""
    pages = F.filter(F.split("text", "\n"), lambda x: x != "")
    q = read(spark, d, "documents").select("doc_id", t.quality(pages, F.lit(3) + (F.col("doc_id") % 4).cast("int")).alias("q"))
    return q.select("doc_id", F.col("q.visible"), F.size("q.empty_pages").cast("long").alias("n_empty"), F.array_join("q.reasons", ",").alias("reasons"))


@query(r"""
SELECT doc_id, md5(out) AS redacted, out <> src AS changed FROM (SELECT doc_id, text AS src,
 regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
  'https?://[^\s<>/?#]*@[^\s<>]*?([.,;)]*)([\s<>]|$)', '[REDACTED-URL]\1\2', 'g'), '(https?://[^\s<>?#]+)[?#][^\s<>]*?([.,;)]*)([\s<>]|$)', '\1\2\3', 'g'),
  '(?i)\b(?:github_pat_|gh[pousr]_)[A-Za-z0-9_]{12,}\b', '[REDACTED]', 'g'), '\bsk-[A-Za-z0-9_-]{12,}\b', '[REDACTED]', 'g'), '(?i)(authorization\s*:\s*bearer\s+)\S+', '\1[REDACTED]', 'g'),
  '(?i)\b(token|password|passwd|secret|api[_-]?key|access[_-]?key)\s*[:=]\s*([^\s,;]+)', '[REDACTED]', 'g'), '(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b', '[REDACTED]', 'g') AS out FROM documents)""")
def redacted_texts(spark, d):
    """Secrets, addresses and credential URLs, in order."""
    r = read(spark, d, "documents").select("doc_id", t.redact(F.col("text"), 1 << 29).alias("r"))
    return r.select("doc_id", F.md5("r.text").alias("redacted"), "r.changed")


@query("""
SELECT doc_id, md5(replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '&', '&amp;'), '\\', '&#92;'), '[', '&#91;'), ']', '&#93;'), '<', '&lt;'), '>', '&gt;'), '|', '&#124;'), chr(13), ' '), chr(10), ' ')) AS cell FROM documents""".replace("'\\\\'", "'\\'"))
def table_cells(spark, d):
    """Escaped Markdown cells."""
    return read(spark, d, "documents").select("doc_id", F.md5(t.table_cell(F.col("text"))).alias("cell"))


@query(r"""
SELECT page_id, CASE WHEN x = '' THEN 'datei' ELSE regexp_replace(left(x, 100), '[ ._]+$', '') END AS name FROM (
  SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(url_decode(url), '[\x00-\x1f\x7f]', '', 'g'), '[<>:"/\\|?*]+', '_', 'g'), '\s+', ' ', 'g'), '^[ ._]+|[ ._]+$', '', 'g') AS x FROM pages)""")
def safe_names(spark, d):
    """I4: portable display names."""
    return read(spark, d, "pages").select("page_id", t.safe_component(F.col("url")).alias("name"))


@query("SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://[^/]+')) || regexp_replace(url, '^[a-z]+://[^/]+', ''), '[?#].*$', '') AS canonical FROM pages")
def canonical_urls(spark, d):
    """Canonical bitstream URLs."""
    return read(spark, d, "pages").select("page_id", i.canonical_bitstream(F.col("url")).alias("canonical"))


@query("""
SELECT conv_id, turn, handle, CASE WHEN turn = 0 THEN 1 WHEN turn >= 2 THEN turn END AS version, CASE WHEN turn = 2 THEN CAST(conv_id AS VARCHAR) WHEN turn > 2 THEN conv_id || '.' || (turn - 1) END AS supersedes
FROM (SELECT conv_id, turn, CASE WHEN turn = 0 THEN CAST(conv_id AS VARCHAR) ELSE conv_id || '.' || turn END AS handle FROM conversations)""")
def handle_versions(spark, d):
    """Versions and predecessors from handles."""
    v = read(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("turn") == 0, F.col("conv_id").cast("string")).otherwise(F.concat_ws(".", F.col("conv_id").cast("string"), F.col("turn").cast("string"))).alias("handle"))
    return v.select("conv_id", "turn", "handle", i.handle_version(F.col("handle")).alias("version"), i.supersedes(F.col("handle")).alias("supersedes"))


@query("""
SELECT p_partkey, sha256(array_to_string(['{', '  "converter": ' || to_json(p_brand) || ',', '  "converter_version": "1",', '  "options_sha256": "' || sha256(concat('{', chr(10), '  "layout": "keep",', chr(10), '  "limits": {', chr(10), '    "pages": ', p_size, chr(10), '  }', chr(10), '}', chr(10))) || '",', '  "runtime": {', '    "fonts": [],',
  '    "libc": "c",', '    "platform": "p",', '    "shared_libraries": [', '      {', '        "name": "z",', '        "sha256": "' || sha256(p_brand) || '"', '      }', '    ]', '  },',
  '  "source_sha256": "' || sha256(p_name) || '",', '  "toolchain": [', '    {', '      "argv": [', '        "-layout",', '        ' || to_json(p_type), '      ],', '      "environment": [],',
  '      "executable_sha256": "' || sha256(p_type) || '",', '      "name": "t",', '      "ocr_settings": ' || CASE WHEN p_partkey % 2 = 0 THEN 'null,' ELSE concat_ws(chr(10), '{', '        "color_mode": "gray",', '        "dpi": ' || (300 + p_size) || ',', '        "languages": [', '          "deu",', '          "eng"', '        ],', '        "oem": 1,', '        "psm": 3,',
    '        "tessdata": [', '          {', '            "name": "deu",', '            "sha256": "' || sha256(p_name) || '"', '          },', '          {', '            "name": "eng",', '            "sha256": "' || sha256(p_brand) || '"', '          }', '        ]', '      },') END, '      "version_output": "' || p_size || '"', '    }', '  ]', '}', ''], chr(10))) AS fingerprint FROM part""")
def conversion_fingerprints(spark, d):
    """Hash of the stable JSON of source, converter, options, tools and runtime."""
    h = {c: i.sha256(F.col(c)) for c in ("p_name", "p_brand", "p_type")}
    named = "array<struct<name:string,sha256:string>>"
    data = F.array(*[F.struct(F.lit(n).alias("name"), h[c].alias("sha256")) for n, c in (("deu", "p_name"), ("eng", "p_brand"))])
    ocr = F.struct(
        (F.col("p_size") + 300).alias("dpi"), F.lit("gray").alias("color_mode"), F.lit(3).alias("psm"), F.lit(1).alias("oem"), F.array(F.lit("deu"), F.lit("eng")).alias("languages"), data.alias("tessdata"),
    )
    options = i.stable_hash({"layout": "keep", "limits": {"pages": F.col("p_size")}})
    tool = F.struct(
        F.lit("t").alias("name"), F.col("p_size").cast("string").alias("version_output"), h["p_type"].alias("executable_sha256"), F.array(F.lit("-layout"), "p_type").alias("argv"),
        F.array().cast("array<struct<name:string,value:string>>").alias("environment"), F.when(F.col("p_partkey") % 2 != 0, ocr).alias("ocr_settings"),
    )
    runtime = F.struct(
        F.lit("p").alias("platform"), F.lit("c").alias("libc"), F.array(F.struct(F.lit("z").alias("name"), h["p_brand"].alias("sha256"))).alias("shared_libraries"), F.array().cast(named).alias("fonts"),
    )
    found = i.conversion_fingerprint(h["p_name"], F.col("p_brand"), F.lit("1"), options, F.array(tool), runtime)
    return read(spark, d, "part").select("p_partkey", found.alias("fingerprint"))


@query("""
SELECT doc_id, sha256(text) AS oid, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE octet_length(encode(text)) END AS size FROM documents""".replace("sha256(text) AS oid", "CASE WHEN doc_id % 7 = 0 THEN NULL ELSE sha256(text) END AS oid"))
def pointers(spark, d):
    """Pointer texts; every seventh lacks its final newline and is none."""
    docs = read(spark, d, "documents")
    body = F.concat(F.lit("version https://git-lfs.github.com/spec/v1\noid sha256:"), i.sha256(F.col("text")), F.lit("\nsize "), F.octet_length("text").cast("string"), F.when(F.col("doc_id") % 7 == 0, "").otherwise("\n"))
    return docs.select("doc_id", i.pointer(body).alias("p")).select("doc_id", F.col("p.oid"), F.col("p.size"))


@query("""
SELECT event_id, CASE WHEN s <= e AND e < n THEN s END AS first_byte, CASE WHEN s <= e AND e < n THEN n END AS total, t IN ('view', 'click') OR t = 'purchase' AS media_ok
FROM (SELECT event_id, event_type AS t, event_id % 1000 AS s, event_id % 1000 + 10 * (user_id % 40) - 20 AS e, 1000 AS n FROM events)""".replace("s <= e AND e < n", "s <= e AND e >= 0 AND e < n"))
def transfer_checks(spark, d):
    """Stated byte ranges and media types."""
    e = read(spark, d, "events")
    s = F.col("event_id") % 1000
    value = F.concat(F.lit("bytes "), s.cast("string"), F.lit("-"), (s + 10 * (F.col("user_id") % 40) - 20).cast("string"), F.lit("/1000"))
    header = F.when(F.col("event_type") == "view", "Application/PDF; charset=x").when(F.col("event_type") == "click", "application/octet-stream").when(F.col("event_type") == "purchase", F.lit(None)).otherwise("text/html")
    r = i.content_range_start(value)
    return e.select("event_id", r["start"].alias("first_byte"), r["total"].alias("total"), i.media_type_ok(header).alias("media_ok"))


@query("""
SELECT o_orderkey, CAST(x - x % 2 AS BIGINT) AS member_time FROM (SELECT o_orderkey, least(greatest(epoch(o_orderdate) - 500000000 + o_orderkey, 315532800), 4354819198) AS x FROM orders)""")
def member_times(spark, d):
    """Clamped even seconds."""
    at = F.unix_timestamp(F.col("o_orderdate").cast("timestamp")) - 500000000 + F.col("o_orderkey")
    return orders(spark, d).select("o_orderkey", c.archive_time(at).alias("member_time"))


@query("SELECT o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS k FROM orders) WHERE k <= 500 AND year(o_orderdate) = 1997")
def limited_then_filtered(spark, d):
    """A top-k report whose limit counts before the year filter."""
    return read(spark, d, "orders").orderBy("o_orderkey").limit(500).where(F.year("o_orderdate") == 1997).select("o_orderkey", "o_orderdate")


@query("""
SELECT source, part, repeat('0', 40) AS expected_base_sha, tree_sha256, entries, 'chore(archive): apply ' || len(tasks) || ' scheduled task(s)' AS subject,
  array_to_string(['Tasks:'] || tasks || ['', 'Dispatch-Plan-SHA256: ' || sha256(CAST(part AS VARCHAR))], chr(10)) AS body
FROM (SELECT source, doc_id // 1000 AS part, count(*) AS entries, list_sort(list_distinct(list('- ' || lang))) AS tasks,
  sha256(string_agg('100644' || chr(0) || 'documents/' || lpad(CAST(doc_id AS VARCHAR), 12, '0') || '.md' || chr(0) || sha256(text) || chr(10), '' ORDER BY doc_id)) AS tree_sha256
  FROM documents GROUP BY ALL)""")
def commit_plans(spark, d):
    """Base, unique entries in order, their tree hash, subject and body, for each thousand documents of a source."""
    docs = read(spark, d, "documents").select(
        "source", F.expr("doc_id div 1000").alias("part"), F.format_string("documents/%012d.md", "doc_id").alias("path"), F.lit("100644").alias("mode"), i.sha256(F.col("text")).alias("sha256"), F.col("lang").alias("task"),
    )
    return plans.commit_plan(docs, ["source", "part"], F.repeat(F.lit("0"), F.lit(40)), i.sha256(F.col("part").cast("string")))
