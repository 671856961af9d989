"""Operators on small literal frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from folioflow.functions import calendar as c
from folioflow.functions import identity as i
from folioflow.functions import text as t
from folioflow.operators import integrity, lifecycle, listing, periods, reconcile, rights, storage
from folioflow.plans import documents as plans
from folioflow.sources import html_pages as h


def value(spark, column, **inputs):
    row = spark.createDataFrame([tuple(inputs.values())], list(inputs)) if inputs else spark.range(1)
    return row.select(column.alias("v")).first()["v"]


def test_calendar(spark):
    day = lambda s: F.lit(s).cast("date")
    assert value(spark, c.week_label(day("2024-12-30"))) == "2025-W01"
    assert value(spark, c.week_label(day("2021-01-03"))) == "2020-W53"
    assert value(spark, c.week_start(F.lit("2020-W53"))) == dt.date(2020, 12, 28)
    assert value(spark, c.week_start(F.lit("2021-W53"))) is None
    assert value(spark, c.strict_date(F.lit("2024-2-3"))) is None
    assert value(spark, c.parse_utc(F.lit("2024-01-02T03:04:05Z"))) == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert value(spark, c.parse_utc(F.lit("2024-01-02T03:04:05+00:00"))) is None
    assert value(spark, c.close_epoch(day("2024-03-31"))) == 1711922400  # the day that summer time begins
    assert value(spark, c.archive_time(F.lit(0))) == 315532800
    assert value(spark, c.valid_period(F.lit("month"), F.lit("2024-13"))) is False
    assert value(spark, c.duration_seconds(F.lit("2024-01-01 00:00:01").cast("timestamp"), F.lit("2024-01-01").cast("timestamp"))) == 0.0


def test_due_tasks_bounds(spark):
    tasks = lambda **k: [(r["kind"], r["value"]) for r in periods.due_tasks(spark, "2024-07-17 09:00:00", **k).collect()]
    got = tasks(week=None, month=None, year=None, reconciled=None)
    assert got == [("week", "2024-W28"), ("month", "2024-06"), ("year", "2023"), ("reconciliation", "2024-07-17T09:00:00Z")]
    assert tasks(week="2024-07-08", month="2024-06-01", year="2023-01-01", reconciled="2024-07-01 00:00:00") == []
    with pytest.raises(Exception, match="future"):
        tasks(week="2024-07-15", month=None, year=None, reconciled=None)
    with pytest.raises(ValueError):
        periods.backfill(spark, 2000, 1999)


def test_redaction_and_names(spark):
    r = value(spark, t.redact(F.lit("see https://u:p@x.org/a. and https://x.org/a?q=1, token=abc mail a@b.org \x00")))
    assert r["text"] == "see [REDACTED-URL]. and https://x.org/a, [REDACTED] mail [REDACTED] " and r["changed"]
    assert value(spark, t.redact(F.lit(None).cast("string")))["text"] == ""
    assert value(spark, t.safe_component(F.lit("a%2Fb: c  d. "))) == "a_b_ c d"
    assert value(spark, t.table_cell(F.lit("a|b&[c]\n<d>"))) == "a&#124;b&amp;&#91;c&#93; &lt;d&gt;"
    assert value(spark, t.pages(F.lit("a\fb\f"))) == ["a", "b"] and value(spark, t.pages(F.lit("a"))) is None
    assert value(spark, t.page_markers(F.array(F.lit("a\n\n"), F.lit("b")))) == "<!-- page: 1 -->\na\n\n<!-- page: 2 -->\nb\n"
    assert value(spark, t.collision_key(F.col("x")), x="StraßE") == "strasse"


def test_quality_reasons_in_order(spark):
    q = value(spark, t.quality(F.array(F.lit("\xa0 "), F.lit("�" * 50)), F.lit(3)))
    assert q["reasons"] == ["page_count_mismatch", "too_few_characters", "replacement_ratio", "empty_pages"]
    assert q["empty_pages"] == [1] and q["verdict"] == "needs_review"
    assert value(spark, t.quality(F.array(F.lit("x" * 40)), F.lit(1)))["verdict"] == "good"


def test_identity(spark):
    assert value(spark, i.canonical_bitstream(F.col("x")), x="HTTPS://Ex.org/a b/ü.pdf?sequence=2&x=1#f") == "https://ex.org/a%20b/%C3%BC.pdf?sequence=2"
    assert value(spark, i.canonical_json(F.col("x")), x='{"b":1,"a":[1,2]}') == '{"a": [1,2],"b": 1}\n'
    assert value(spark, i.canonical_json(F.col("x")), x='{"a":1,"a":2}') is None
    assert value(spark, i.relative_posix(F.lit("a/../b"))) is False and value(spark, i.relative_posix(F.lit("a/b"))) is True
    assert value(spark, i.portable_component(F.lit("con.txt"))) is False
    assert [value(spark, i.handle_version(F.lit(x))) for x in ("7", "7.2", "7.1")] == [1, 2, None]
    assert value(spark, i.pointer(F.lit("version https://git-lfs.github.com/spec/v1\noid sha256:" + "a" * 64 + "\nsize 3\n")))["size"] == 3
    long = value(spark, i.document_paths(F.lit("d" * 300), F.lit("b"), F.lit("article"), F.lit("2024-05-06").cast("date")))["pdf"]
    assert "_d-" in long and len(long.split("/")[-1]) <= 240


def test_snapshot_diff_replacement(spark):
    local = spark.createDataFrame([("a", 1, "x", None), ("b", 2, "x", "h"), ("c", 3, "x", "h"), ("c", 4, "x", "h")], "g string, k int, v string, h string")
    remote = spark.createDataFrame([("a", 9, "x", None), ("b", 2, "x", None), ("c", 5, "x", "h"), ("d", 6, "x", "h")], "g string, k int, v string, h string")
    got = {tuple(r) for r in reconcile.snapshot_diff(local, remote, "g", "k", ["v"], ["h"]).collect()}
    assert got == {("a", 1, "changed"), ("c", 3, "missing_remote"), ("c", 4, "missing_remote"), ("c", 5, "new"), ("d", 6, "new")}
    assert reconcile.snapshot_diff(local.limit(0), remote.limit(0), "g", "k", ["v"]).count() == 0


def test_integrity(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1), (5, 6), (6, None)], "node int, next int")
    assert sorted(r["node"] for r in integrity.on_cycles(edges).collect()) == [1, 2, 3, 4]
    v = spark.createDataFrame([(1, None, 2), (2, 1, None), (3, 2, None), (9, 8, None)], "node int, supersedes int, superseded_by int")
    assert {tuple(r) for r in integrity.reciprocal_violations(v).collect()} == {(3, 2, "not_returned"), (9, 8, "missing")}
    docs = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y")], "id long, t string")
    assert {(r["id"], tuple(r["same_content_as"])) for r in integrity.content_aliases(docs, F.col("t"), "id").collect()} == {(1, ()), (3, (1,)), (2, ())}


def test_rights(spark):
    register = spark.createDataFrame([(1, "approved", "b", "h1"), (2, "unknown", "b", "h2")], "id int, state string, basis string, decision_hash string")
    got = {r["id"]: (r["state"], r["basis"]) for r in rights.evaluate(spark.createDataFrame([(1,), (2,), (3,)], "id int"), register, ["id"]).collect()}
    assert got == {1: ("approved", "b"), 2: ("metadata_only", "b"), 3: ("metadata_only", "rights_register_no_match")}
    assert value(spark, rights.allowed(F.lit("internal_only"), F.lit("public"))) is False


def test_lifecycle(spark):
    e = spark.createDataFrame([("r", 1, "created"), ("r", 2, "running"), ("r", 3, "created"), ("r", 5, "success")], "run string, rev int, s string")
    assert {tuple(r) for r in lifecycle.transition_violations(e, "run", "rev", "s").collect()} == {("r", 3, "running", "created", "status"), ("r", 5, "created", "success", "revision")}
    h_ = spark.createDataFrame([("g", k, x) for k, x in enumerate(["success", "failure", "timed_out", "failure"])], "g string, n int, c string")
    assert lifecycle.trailing_failures(h_, "g", "n", "c", threshold=10).first()["failures"] == 3
    assert lifecycle.trailing_failures(h_, "g", "n", "c", threshold=3).first()["failures"] == 2
    assert value(spark, lifecycle.incident_action(F.lit(3), 2, F.lit(None).cast("string"), F.lit("degraded"))) == "create"
    assert value(spark, lifecycle.outcome(F.lit(False), F.lit(1), F.lit(0))) == "failed"


def test_storage(spark):
    s = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    target = spark.createDataFrame([(2, "x"), (3, None), (4, "z")], "k int, v string")
    assert {tuple(r) for r in storage.migration_plan(s, target, "k", ["v"]).collect()} == {(1, "copy"), (2, "conflict"), (3, "unchanged")}
    assert [value(spark, storage.budget(F.lit(5), F.lit(5), F.lit(x), 5, 5, 8, 10)) for x in (8, 9, 11)] == ["ok", "warning", "error"]
    paths = spark.createDataFrame([("a/b.py",), ("a/c.md",), ("z",)], "path string")
    rules = spark.createDataFrame([("*.py", "deny"), ("a/**", "allow")], "glob string, verdict string").select(i.glob_pattern(F.col("glob")).alias("pattern"), "verdict")
    assert {tuple(r) for r in storage.path_classes(paths, rules).collect()} == {("a/b.py", "denied"), ("a/c.md", "allowed"), ("z", "unlisted")}


def test_html(spark):
    page = "<meta name=DC.title content=''><meta name=dc.title content=' T '><h1>A <b>b</b></h1><script>x</script><a href='/1'>2021</a><a href='/2' rel=next>n</a><a>no</a>"
    p = value(spark, h.parse(F.col("x")), x=page)
    assert p["heading"] == "A b" and [a["href"] for a in p["anchors"]] == ["/1", "/2"] and "x" not in p["text"].split()
    assert spark.createDataFrame([(page,)], "x string").select(h.first_meta(h.parse(F.col("x"))["metas"], ["DC.title"]).alias("v")).first()["v"] == "T"
    assert value(spark, h.listing_bounds(F.lit("Now showing items 1-20 of 1,234")))["total"] == 1234
    assert value(spark, h.listing_bounds(F.lit("Now showing items 9-2 of 20"))) is None
    assert value(spark, h.parse(F.col("x")), x=None if False else "")["anchors"] == []


def test_listing(spark):
    ops = value(spark, listing.staged_operations(F.lit(" M a b\x00R  new\x00old\x00?? x\x00")))
    assert [tuple(x) for x in ops] == [("M", "a b"), ("A", "new"), ("D", "old"), ("??", "x")]
    chain = spark.createDataFrame([(1, 2), (2, 3), (3, None), (4, 4)], "src int, dst int")
    assert {tuple(r) for r in listing.follow(chain, 3).collect()} == {(1, 3, 2, "ok"), (2, 3, 1, "ok"), (3, 3, 0, "ok"), (4, None, 4, "too_many")}


def test_front_matter(spark):
    assert value(spark, plans.front_matter({"a": F.lit('x"y'), "b": F.lit(None).cast("string")})) == '---\na: "x\\"y"\nb: null\n---\n'


def test_fixed_codes(spark):
    """Values that must match, told literally."""
    from pyspark.sql import functions as F

    from folioflow.functions import text as t

    q = spark.range(1).select(t.quality(F.array(F.lit("ab\ufffd"), F.lit(" ")), F.lit(3)).alias("bad"), t.quality(F.array(F.lit("x" * 40)), F.lit(1)).alias("good"), t.safe_component(F.lit(" ._")).alias("name")).first()
    assert q["bad"]["reasons"] == ["page_count_mismatch", "too_few_characters", "replacement_ratio", "empty_pages"] and q["bad"]["verdict"] == "needs_review"
    assert q["good"]["reasons"] == [] and q["good"]["verdict"] == "good" and q["name"] == "datei"
    urls = ["https://a.b/c?d#e", "ftp://a.b/c", "/relative", "http://u:p@a.b/", "http:///x", "HTTP://a.b"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(t.sanitize_url(F.col("u"))).collect()]
    assert got == ["https://a.b/c", "[REDACTED-URL]", "[REDACTED-URL]", "[REDACTED-URL]", "[REDACTED-URL]", "HTTP://a.b"]
