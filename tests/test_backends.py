from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from folioflow.functions import identity
from folioflow.sources import backends


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.pdf").write_bytes(b"one")
    (tmp_path / "in/b.txt").write_bytes(b"two")
    b = backends.backend("files", spark, str(tmp_path))
    found = b.inventory().collect()
    assert [(r["sha256"], r["bytes"]) for r in found] == [(sha256(b"one").hexdigest(), 3)]
    refs = spark.createDataFrame([(found[0]["path"], found[0]["sha256"]), (found[0]["path"], "x"), ("gone", "x")], "path string, sha256 string")
    assert sorted(r["ok"] for r in b.verify(refs).collect()) == [False, False, True]


def test_table(spark, tmp_path):
    b = backends.backend("table", spark, str(tmp_path / "t"))
    rows = lambda *r: spark.createDataFrame(r, "key string, content binary")
    assert b.put(rows(("a", b"1"))).count() == 1
    assert b.put(rows(("objects/a", b"1"), ("b", b"2"))).count() == 2
    with pytest.raises(ValueError):
        b.put(rows(("a", b"other")))
    text = "version https://git-lfs.github.com/spec/v1\noid sha256:%s\nsize %d\n"
    pointers = spark.createDataFrame([("p", text % (sha256(b"2").hexdigest(), 1)), ("q", text % (sha256(b"2").hexdigest(), 5)), ("r", "x")], "path string, text string")
    assert {r["path"]: r["ok"] for r in backends.resolve_pointers(pointers, b.read()).collect()} == {"p": True, "q": False, "r": False}
    with pytest.raises(KeyError):
        backends.backend("tape")


def test_identities(spark):
    rows = spark.createDataFrame([("straße",), ("doc-1",), ("Doc",), ("é",), ("con",), ("a.",), (None,)], "v string")
    assert [r["ok"] for r in rows.select(identity.portable_identity(F.col("v")).alias("ok")).collect()] == [False, True, False, False, False, False, False]
    pairs = spark.createDataFrame([("source-12.2", "document-12.2"), ("source-12", "document-12.2"), ("x", "y")], "s string, d string")
    assert [r["ok"] for r in pairs.select(identity.same_provenance(F.col("s"), F.col("d")).alias("ok")).collect()] == [True, False, False]


def test_one_batch_may_not_contradict_itself(spark, tmp_path):
    b = backends.backend("table", spark, str(tmp_path / "t"))
    rows = lambda *r: spark.createDataFrame(r, "key string, content binary")
    with pytest.raises(ValueError):
        b.put(rows(("a", b"1"), ("a", b"2")))
    assert b.put(rows(("a", b"1"), ("objects/a", b"1"), ("b", b"2"))).count() == 2


def test_hashes_of_named_fields(spark):
    """Hashes are those of indented JSON with sorted keys and a final newline."""
    import json

    from folioflow.operators import rights
    from folioflow.plans import documents

    digest = lambda value: sha256((json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True, separators=(",", ": ")) + "\n").encode()).hexdigest()
    decision = {"policy_version": 1, "source_id": "s\"ä\\\n", "source_sha256": "0" * 64, "state": "approved", "basis": "b", "reviewed_by": "r", "reviewed_at": None}
    tool = {"name": "t", "version_output": "1", "executable_sha256": "e", "argv": ["-a", "-b"], "environment": [{"name": "n", "value": "v"}], "ocr_settings": None}
    settings = {"dpi": 300, "color_mode": "gray", "psm": 3, "oem": 1, "languages": ["deu"], "tessdata": [{"name": "deu", "sha256": "d"}]}
    scan = tool | {"name": "scan", "ocr_settings": settings}
    runtime = {"platform": "p", "libc": "c", "shared_libraries": [{"name": "l", "sha256": "h"}, {"name": "m", "sha256": "i"}], "fonts": []}
    named, types = "array<struct<name:string,sha256:string>>", "name string, version_output string, executable_sha256 string, argv array<string>, environment array<struct<name:string,value:string>>"
    ocr = f"ocr_settings:struct<dpi:int,color_mode:string,psm:int,oem:int,languages:array<string>,tessdata:{named}>"
    tools = f"array<struct<{types.replace(' string', ':string').replace(' array', ':array')},{ocr}>>"
    row_of = lambda t, o: (*[t[k] if k != "environment" else [("n", "v")] for k in ("name", "version_output", "executable_sha256", "argv", "environment")], o)
    row = spark.createDataFrame(
        [(decision, [row_of(tool, None), row_of(scan, (300, "gray", 3, 1, ["deu"], [("deu", "d")]))], ("p", "c", [("l", "h"), ("m", "i")], []))],
        f"d struct<source_id:string,source_sha256:string,state:string,basis:string,reviewed_by:string,reviewed_at:string>, t {tools}, r struct<platform:string,libc:string,shared_libraries:{named},fonts:{named}>",
    )
    got = row.select(
        rights.decision_hash(1, *[F.col(f"d.{c}") for c in ("source_id", "source_sha256", "state", "basis", "reviewed_by", "reviewed_at")]).alias("decision"),
        identity.conversion_fingerprint(F.lit("s"), F.lit("c"), F.lit("1"), F.lit("o"), F.col("t"), F.col("r")).alias("conversion"),
    ).first()
    assert got["decision"] == digest(decision)
    assert got["conversion"] == digest({"source_sha256": "s", "converter": "c", "converter_version": "1", "options_sha256": "o", "toolchain": [tool, scan], "runtime": runtime})
    entries = spark.createDataFrame([(1, "b", "100644", "y", "t2"), (1, "a", "100755", "x", "t1"), (1, "a", "100755", "x", "t1")], "g int, path string, mode string, sha256 string, task string")
    plan = documents.commit_plan(entries, ["g"], F.lit("base"), F.lit("plan")).first()
    assert plan["tree_sha256"] == sha256(b"100755\0a\0x\n100644\0b\0y\n").hexdigest() and plan["entries"] == 2
    assert plan["subject"] == "chore(archive): apply 2 scheduled task(s)" and plan["body"] == "Tasks:\n- t1\n- t2\n\nDispatch-Plan-SHA256: plan"


def test_archive_inputs_and_headers(spark):
    """The hash of an archive's inputs, build times in UTC, and header fields, with literal values."""
    import json

    from folioflow.functions import calendar
    from folioflow.operators import periods
    from folioflow.plans import documents

    payload = {
        "format_version": "1", "archive": {"archive_id": "archive-week-2024-w05-pdf", "period": "2024-W05", "kind": "week-pdf"}, "zip_datetime": [2024, 2, 4, 23, 59, 58],
        "visibility": "public", "entries": [{"path": "PDF/a.pdf", "bytes": 3, "sha256": "x"}, {"path": "PDF/b.pdf", "bytes": 4, "sha256": "y"}],
    }
    want = sha256((json.dumps(payload, indent=2, sort_keys=True, separators=(",", ": ")) + "\n").encode()).hexdigest()
    members = spark.createDataFrame([("week", "2024-W05", "pdf", p, n, h, "public", 1707091199) for p, n, h in (("PDF/b.pdf", 4, "y"), ("PDF/a.pdf", 3, "x"))], "kind string, value string, format string, path string, bytes long, sha256 string, visibility string, epoch long")
    assert periods.planned_archives(members).first()["fingerprint"] == want
    times = spark.createDataFrame([(0,), (1707091199,), (-1,)], "e long").select(calendar.generated_at(F.col("e")).alias("t"))
    assert [r["t"] for r in times.collect()] == ["1970-01-01T00:00:00Z", "2024-02-04T23:59:59Z", None]
    heads = [("t", "1990-01-01", "53/2024", "10.1234/x"), ("", "1990-01-01", None, None), ("t", "1989-12-31", None, None), ("t", "1990-01-01", "54/2024", None), ("t", "1990-01-01", None, "10.1/x"), ("t", "1990-01-01", None, "10.1234/a b"), (None, None, None, None)]
    got = spark.createDataFrame(heads, "t string, d string, b string, o string").select(documents.header_problem(F.col("t"), F.col("d").cast("date"), F.col("b"), F.col("o")).alias("p")).collect()
    assert [r["p"] for r in got] == [None, "title", "publication_date", "bulletin_number", "doi", "doi", "title"]
