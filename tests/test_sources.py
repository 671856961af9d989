import datetime as dt

import pytest
from pyspark.sql import functions as F

from folioflow.functions import payload, urls
from folioflow.plans import transaction, versions
from folioflow.sources import bundles, catalog_files, listing_source

PAGES = {
    "p0": "<a href='/1'>one</a><a href='p1' rel='next'>more</a>",
    "p1": "<a href='/2'>two</a><a href='/3'>three</a>",
    "q0": "<a href='q0' class='next'>again</a>",
}


def fetch(url):
    return PAGES[url]


def value(spark, column, **inputs):
    return spark.createDataFrame([tuple(inputs.values())], list(inputs)).select(column.alias("v")).first()["v"]


def test_listing_source(spark):
    spark.dataSource.register(listing_source.ListingSource)
    rows = spark.read.format("listing").options(starts="p0,q0,missing", transport="tests.test_sources:fetch", delay_seconds="0").load().collect()
    assert sorted((r["start"], r["page"], r["href"]) for r in rows if not r["problem"]) == [("p0", 0, "/1"), ("p0", 1, "/2"), ("p0", 1, "/3")]
    assert {(r["start"], r["problem"]) for r in rows if r["problem"]} == {("q0", "loop"), ("missing", "fetch: KeyError")}


def test_urls(spark):
    check = lambda u: value(spark, urls.allowed(F.col("u"), ["x.org"]), u=u)
    assert [check(u) for u in ("https://x.org/a", "https://X.org:443/", "http://x.org/", "https://u@x.org/", "https://x.org:8/", "::")] == [True, True, False, False, False, False]
    assert value(spark, urls.handle_path(F.col("u"), "x.org"), u="https://x.org/handle/12/3.2/") == "12/3.2"
    offset = lambda u, n: value(spark, urls.with_offset(F.col("u"), F.lit(n)), u=u)
    assert [offset("https://x/a?b=1&offset=20", 40), offset("https://x/a?offset=20&b=1", 0), offset("https://x/a", 5)] == ["https://x/a?b=1&offset=40", "https://x/a?b=1", "https://x/a?offset=5"]
    assert value(spark, urls.relative_link(F.col("a"), F.col("b")), a="x/y/i.md", b="x/z/a b.pdf") == "../z/a%20b.pdf"
    assert value(spark, urls.relative_link(F.col("a"), F.col("b")), a="i.md", b="z/a.pdf") == "z/a.pdf"


def test_payloads(spark):
    pdf = b"%PDF-1.4\n" + b"x" * 2000 + b"\n%%EOF\n"
    problem = lambda c, m=None: spark.createDataFrame([(c, m)], "c binary, m string").select(payload.pdf_problem(F.col("c"), F.col("m")).alias("v")).first()["v"]
    assert [problem(pdf), problem(b""), problem(b"PDF"), problem(pdf[:-8]), problem(pdf, "0" * 32)] == [None, "empty", "no_magic", "no_end", "checksum"]
    assert tuple(value(spark, payload.pdfinfo(F.col("t")), t="Title: x\nPages:  7\nEncrypted: no\n")) == (7, False)
    assert value(spark, payload.pdfinfo(F.col("t")), t="Pages: 7\nPages: 8\nEncrypted: no") is None
    assert tuple(value(spark, payload.pgm_size(F.col("t")), t=bytearray(b"P5\n2 3\n255\n" + b"\xff" * 6))) == (2, 3)
    assert value(spark, payload.pgm_size(F.col("t")), t=bytearray(b"P5\n2 3\n255\nabc")) is None


def test_bundles(spark):
    rows = [("a", 0, "b.md", b"two"), ("a", 0, "a.md", b"one"), ("c", 1 << 33, "x", b"")]
    members = spark.createDataFrame(rows, "archive_id string, epoch long, path string, content binary")
    built = bundles.build(members).collect()
    again = {r["archive_id"]: r["output_sha256"] for r in bundles.build(members.orderBy(F.desc("path"))).collect()}
    assert {r["archive_id"]: r["output_sha256"] for r in built} == again
    got = spark.createDataFrame([(bytes(r["content"]),) for r in built] + [(bytes(built[0]["content"])[:-3],), (b"",)], "c binary").select(payload.zip_problem(F.col("c")).alias("v")).collect()
    assert [r["v"] for r in got] == [None, None, "broken", "broken"]


def test_catalog_round_trip(spark, tmp_path):
    frame = spark.createDataFrame([(2, None), (1, "x")], "id long, v string")
    path = str(tmp_path / "c")
    d = catalog_files.write_collection(frame, path, "id").first().asDict()
    assert d["n"] == 2 and sorted(map(tuple, catalog_files.load_collection(spark, path, frame.schema, d).collect())) == [(1, "x"), (2, None)]
    with pytest.raises(ValueError):
        catalog_files.load_collection(spark, path, frame.schema, d | {"n": 3})
    snap = str(tmp_path / "s")
    assert [catalog_files.write_if_changed(f, snap, "id", ["id", "v"]) for f in (frame, frame, frame.limit(1))] == [True, False, True]
    report = str(tmp_path / "r")
    assert [catalog_files.write_report_once(frame, report) for _ in (0, 1)] == ["written", "no_op"]
    with pytest.raises(ValueError):
        catalog_files.write_report_once(frame.limit(1), report)
    catalog_files.export(frame, str(tmp_path / "e"), ["id"], ["id"])
    assert spark.read.option("header", True).csv(str(tmp_path / "e/csv")).columns == ["id"]


def test_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = lambda *r: spark.createDataFrame(r, "kind string, value string, n int")
    catalog_files.overwrite_periods(rows(("month", "2024-01", 1), ("month", "2024-02", 2)), path)
    catalog_files.overwrite_periods(rows(("month", "2024-02", 3)), path)
    assert sorted((r["value"], r["n"]) for r in spark.read.parquet(path).collect()) == [("2024-01", 1), ("2024-02", 3)]


def test_versions(spark):
    doc = spark.createDataFrame([("d", dt.date(2024, 12, 30))], "document_id string, publication_date date")
    then, out = versions.migrate("document", "1.0", doc)
    r = out.first()
    assert then == "1.1" and tuple(r["canonical_periods"]) == ("2025-W01", "2024-12", 2024) and r["provenance_state"] == "legacy" and r["bitstream_version"] is None
    with pytest.raises(KeyError):
        versions.migrate("document", "0.9", doc)
    old = spark.createDataFrame([(5, "2024-W01", None, 2023, None, None, None)], "documents int, last_week string, last_month string, last_year int, state string, failures int, last_reset timestamp")
    assert versions.migrate("status", "2", old)[1].first()["runtime"]["state"] == "operational"
    for name in ("source", "conversion", "storage_reference"):
        assert versions.migrate(name, "1.0", spark.createDataFrame([(1,)], "id int"))[1].first()["provenance_state"] == "legacy"


def test_transaction(spark):
    frame = lambda *r: spark.createDataFrame(r, "path string, payload string")
    done = []
    run = lambda tasks, checks=(), base="a": transaction.execute([transaction.Task(str(k), lambda f=f: f) for k, f in enumerate(tasks)], "a", base, dict(checks), lambda f: done.append(f.count()))
    assert run([frame(("x", "1")), frame(("x", "1"), ("y", "2"))]).changed == 2 and done == [2]
    assert run([frame(("x", "1")), frame(("x", "2"))]).problems == ["conflicting effects"]
    assert run([frame(("x", "1"))], {"no x": lambda f: f.where("path = 'x'")}).status == "failed" and done == [2]
    assert run([frame(("x", "1"))], base="b").status == "blocked" and run([]).status == "no_op"


def test_page_rules(spark):
    """Literal expected values of the rules on item pages."""
    from folioflow.sources import html_pages as h

    metas = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(c).alias("content")) for n, c in (("dc.rights", " CC "), ("license", "by"), ("citation_open_access", "1"), ("citation_doi", "doi:10.1234/55.2 x"), ("dc.date.issued", "2020-02-30"))])
    long = F.concat(F.repeat(F.lit("x "), 1000), F.lit("1999 2001-01-01"))
    row = spark.range(1).select(
        h.rights(metas).alias("rights"), h.doi(h.first_meta(metas, h.DOI_METAS), F.lit("10.9999/1")).alias("meta_doi"), h.doi(F.lit(None).cast("string"), F.lit("see DOI 10.9999/1.")).alias("text_doi"), h.doi(F.lit(""), F.lit("none")).alias("no_doi"),
        h.publication_date(h.first_meta(metas, h.DATE_METAS), F.lit("of 2021-03-04"), F.lit("")).cast("string").alias("day"), h.publication_year(F.lit(None).cast("date"), long, F.lit("Year 1987"), F.lit(7)).alias("year"),
        h.open_access(F.lit("0")).alias("closed"), h.open_access(F.lit("Restricted_Access")).alias("restricted"), h.open_access(F.lit("ask")).alias("unsaid"),
    ).first()
    assert tuple(row["rights"]) == ("CC", "by", None, True)
    assert (row["meta_doi"], row["text_doi"], row["no_doi"], row["day"], row["year"]) == ("10.1234/55.2", "10.9999/1", None, "2021-03-04", 1987)
    assert (row["closed"], row["restricted"], row["unsaid"]) == (False, False, None)
    anchors = [(1, 0, "/a", "nächste", ""), (1, 1, "/b", "x", "pager-next"), (1, 2, "/c", "›", ""), (2, 0, "/d", "›", ""), (3, 0, "/e", "next page", "")]
    found = h.next_page(spark.createDataFrame(anchors, "page_id int, pos int, href string, text string, rel string")).collect()
    assert {r["page_id"]: r["next"] for r in found} == {1: "/b", 2: "/d"}
