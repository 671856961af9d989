"""Plans, manifests and archives of periods, written and read back."""

import io
import json
import stat
import zipfile
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from folioflow.functions import identity
from folioflow.operators import publications
from folioflow.sources import bundles, zip_members

DOC = f"document_id string, bitstream_id string, version long, source_id string, publication_date date, title string, handle string, doi string, conversion_state string, pdf {publications.PAYLOAD}, markdown {publications.PAYLOAD}"


def payload(n, form, visibility="public", name=None):
    return (f"{form}-00{n}", name or f"a/F{n}.{form}", sha256(f"{n}{form}".encode()).hexdigest(), n, f"src:{n}", "0" * 64, None, "free", visibility, f"doc-{n}", None)


def documents(spark, *rows):
    import datetime

    full = [(f"doc-{n}", f"bit-{n}", 1, f"src:{n}", datetime.date.fromisoformat(day), "t", f"9/{n}", None, "persisted", pdf, md) for n, day, pdf, md in rows]
    return spark.createDataFrame(full, DOC)


@pytest.fixture(scope="module")
def corpus(spark):
    return documents(spark, (1, "2024-01-30", payload(1, "pdf"), payload(1, "md")), (2, "2024-02-01", payload(2, "pdf"), None), (3, "2024-02-20", None, None))


def asked(spark, *pairs):
    return spark.createDataFrame(list(pairs), "kind string, value string")


def builds(plans):
    flat = plans.select("value", "epoch", F.explode("archives").alias("a"))
    return flat.select("a.archive_id", publications.archive_fingerprint(F.col("a"), F.col("value"), F.col("epoch")).alias("input_fingerprint"), identity.sha256(F.col("a.archive_id")).alias("output_sha256"), F.lit(5).cast("long").alias("bytes"))


def test_plans_and_fingerprints(spark, corpus):
    plans = publications.plan_archives(corpus, asked(spark, ("week", "2024-W05"), ("month", "2024-02"), ("month", "2024-03"), ("year", "2024"))).cache()
    got = {r["value"]: r for r in plans.collect()}
    assert [d["document_id"] for d in got["2024"]["documents"]] == ["doc-1", "doc-2", "doc-3"] and got["2024-03"]["documents"] == [] and got["2024-03"]["archives"] == []
    assert [a["archive_id"] for a in got["2024-W05"]["archives"]] == ["archive-week-2024-w05-markdown", "archive-week-2024-w05-pdf"]
    assert [e["path"] for e in got["2024-W05"]["archives"][1]["entries"]] == ["PDF/F1.pdf", "PDF/F2.pdf"]
    one = {
        "period": {"kind": "month", "value": "2024-03", "start": "2024-03-01", "end": "2024-03-31", "source_date_epoch": 1711922400}, "documents": [], "archives": [],
        "index_path": "archive/months/2024/03/Markdown/index.md", "manifest_path": "archive/manifests/month/2024-03.json",
    }
    text = lambda x: json.dumps(x, indent=2, sort_keys=True, ensure_ascii=False) + "\n"
    hashes = {r["value"]: r["plan_sha256"] for r in publications.plan_fingerprints(plans).collect()}
    assert hashes["2024-03"] == sha256(text(one).encode()).hexdigest()
    whole = publications.plan_fingerprint(plans.where("value = '2024-03'")).first()
    assert whole["periods"] == 1 and whole["input_fingerprint"] == sha256(text([one]).encode()).hexdigest()
    assert publications.plan_fingerprint(plans.limit(0)).first()["input_fingerprint"] == sha256(b"[]\n").hexdigest()


def test_plan_problems_and_bounds(spark, corpus):
    mixed = documents(spark, (1, "2024-02-01", payload(1, "pdf"), None), (2, "2024-02-02", payload(2, "pdf", "internal"), None))
    same = documents(spark, (1, "2024-02-01", payload(1, "pdf", name="a/X.pdf"), None), (2, "2024-02-02", payload(2, "pdf", name="b/x.pdf"), None))
    month = asked(spark, ("month", "2024-02"))
    assert publications.plan_archives(mixed, month).first()["problem"] == "mixed_visibility"
    assert publications.plan_archives(same, month).first()["problem"] == "colliding_names"
    with pytest.raises(ValueError, match="too many documents in a period"):
        publications.plan_archives(mixed, month, most=1)


def test_references_of_months(spark, corpus):
    plans = publications.plan_archives(corpus, asked(spark, ("week", "2024-W05"), ("month", "2024-01"), ("month", "2024-02")))
    old = spark.createDataFrame([
        ("2024-W08", "archive-week-2024-w08-pdf", "week-pdf", "archive/months/2024/02/ZIP/weeks/articles-2024-02-19_to_2024-02-25-PDF", "a" * 64, "b" * 64, 9),
        ("2024-W05", "archive-week-2024-w05-pdf", "week-pdf", "x", "a" * 64, "b" * 64, 9),
    ], "value string, archive_id string, kind string, relative_bundle string, input_fingerprint string, output_sha256 string, bytes long")
    references = publications.weekly_references(plans, old)
    assert publications.reference_problems(references).count() == 0
    got = {r["month"]: [x["archive_id"] for x in r["references"]] for r in publications.month_references(plans.where("kind = 'month'").select("value"), references).collect()}
    w5 = ["archive-week-2024-w05-pdf", "archive-week-2024-w05-markdown"]
    assert got == {"2024-01": w5, "2024-02": [*w5, "archive-week-2024-w08-pdf"]}
    index = {r["value"]: r for r in publications.month_index(plans, references).collect()}
    weekly = "[PDF](../ZIP/weeks/articles-2024-01-29_to_2024-02-04-PDF/archive.zip) [Markdown](../ZIP/weeks/articles-2024-01-29_to_2024-02-04-Markdown/archive.zip)"
    files = f"[PDF](../../../../../a/F1.pdf) | [Markdown](../../../../../a/F1.md) | persisted | {payload(1, 'pdf')[2]} | {payload(1, 'md')[2]}"
    assert index["2024-01"]["index_path"] == "archive/months/2024/01/Markdown/index.md"
    assert index["2024-01"]["body"].split("\n") == [
        "# Articles 2024-01", "", "Articles: 1", "", "| Date | Title | Handle | Bitstream | DOI | PDF | Markdown | Conversion | PDF SHA-256 | Markdown SHA-256 | Weekly archives |", "| " + " | ".join(["---"] * 11) + " |",
        f"| 2024-01-30 | t | 9/1 | bit-1 | — | {files} | {weekly} |", "", "## Weekly archives", "", weekly, "",
    ]
    spoilt = references.withColumn("relative_bundle", F.when(F.col("value") == "2024-W08", "elsewhere").otherwise(F.col("relative_bundle")))
    assert [tuple(r) for r in publications.reference_problems(spoilt).collect()] == [("2024-W08", "archive-week-2024-w08-pdf", "relative_bundle")]
    assert {r["problem"] for r in publications.reference_problems(references.union(references)).collect()} == {"repeated"}


def test_publications_read_back(spark, corpus, tmp_path):
    plans = publications.plan_archives(corpus, asked(spark, ("week", "2024-W05"), ("month", "2024-02"), ("year", "2024"), ("month", "2024-03"))).cache()
    made = publications.render_manifests(plans, builds(plans)).cache()
    bodies = {(r["kind"], r["value"]): r for r in made.collect()}
    year = json.loads(bodies["year", "2024"]["body"])
    assert year["month_manifests"] == ["archive/manifests/month/2024-01.json", "archive/manifests/month/2024-02.json"]
    hashed = {k: v for k, v in year.items() if k != "input_fingerprint"}
    assert year["input_fingerprint"] == sha256((json.dumps(hashed, indent=2, sort_keys=True) + "\n").encode()).hexdigest()
    zip_members.write_files(made.select(F.col("manifest_path").alias("path"), F.col("body").cast("binary").alias("content")), str(tmp_path)).collect()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path)).select(F.regexp_extract("path", "(archive/manifests/.*)$", 1).alias("path"), F.col("content").alias("raw"))
    known = plans.select("value", "epoch", F.explode("archives").alias("a")).select("a.relative_bundle", "a.archive_id").join(builds(plans), "archive_id").withColumn("problem", F.lit(None).cast("string")).cache()
    ask = asked(spark, ("week", "2024-W05"), ("month", "2024-02"), ("year", "2024"), ("year", "2023"))

    def found(archives):
        return {r["value"]: (r["manifest_sha256"], r["archives"], r["problem"]) for r in publications.inspect_publications(ask, files, archives).collect()}

    digest = lambda *k: sha256(bodies[k]["body"].encode()).hexdigest()
    assert found(known) == {"2024-W05": (digest("week", "2024-W05"), 2, None), "2024-02": (digest("month", "2024-02"), 1, None), "2024": (digest("year", "2024"), 2, None), "2023": (None, 0, "missing_manifest")}
    is_week = F.col("archive_id").startswith("archive-week")
    worse = known.where(~F.col("archive_id").startswith("archive-month")).withColumn("problem", F.when(is_week, "damaged")).withColumn("bytes", F.col("bytes") + 1)
    assert {k: v[2] for k, v in found(worse).items()} == {"2024-W05": "damaged", "2024-02": "missing_archive", "2024": "other_archive", "2023": "missing_manifest"}
    problems = {r["value"]: r["problem"] for r in publications.render_manifests(plans, builds(plans).where(~is_week).union(builds(plans).where(F.col("archive_id").startswith("archive-year")))).collect()}
    assert problems == {"2024-W05": "missing_build", "2024-02": None, "2024": "repeated_build", "2024-03": None}


def test_manifest_faults(spark, corpus):
    plans = publications.plan_archives(corpus, asked(spark, ("year", "2024")))
    body = json.loads(publications.render_manifests(plans, builds(plans)).first()["body"])

    def manifest(**changed):
        value = body | changed
        hashed = {k: v for k, v in value.items() if k != "input_fingerprint"}
        value["input_fingerprint"] = changed.get("input_fingerprint") or sha256((json.dumps(hashed, indent=2, sort_keys=True) + "\n").encode()).hexdigest()
        return json.dumps(value, indent=2, sort_keys=True) + "\n"

    docs, archives = body["documents"], body["archives"]
    cases = {
        None: manifest(), "period": manifest(end_date="2024-12-30"), "schema": manifest(kind="day"), "documents_unsorted": manifest(documents=docs[::-1]), "document_repeated": manifest(documents=[docs[0], docs[0], *docs[1:]]),
        "archives_unsorted": manifest(archives=archives[::-1]), "archive_name": manifest(archives=[archives[0] | {"kind": "month-pdf"}]), "archive_repeated": manifest(archives=[archives[0], archives[0]]),
        "month_manifests": manifest(month_manifests=[]), "fingerprint": manifest(input_fingerprint="0" * 64), "not_canonical": json.dumps(json.loads(manifest()), sort_keys=True), "not_json": "{", "not_object": "[]",
    }
    frame = spark.createDataFrame([(str(k), v) for k, v in cases.items()], "want string, raw string")
    assert {r["want"]: str(r["problem"]) for r in publications.validate_manifests(frame).collect()} == {str(k): str(k) for k in cases}


def archive(*members, method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, body in members:
            z.writestr(name, body)
    return out.getvalue()


def test_zip_members(spark, tmp_path):
    long = b"abc" * 900_000
    link = zipfile.ZipInfo("link")
    link.external_attr = (stat.S_IFLNK | 0o777) << 16
    files = {
        "a.zip": archive(("x/1", b"one"), ("x/2", b""), ("x/ü", b"two")), "b.zip": archive(("long", long), ("tail", b"t"), method=zipfile.ZIP_DEFLATED), "c.zip": b"no archive", "d.zip": archive(("../up", b"x"), ("ok", b"y"), ("OK", b"z"), (link, b"ok")),
        "e.zip": archive(("bz", b"1" * 99), method=zipfile.ZIP_BZIP2), "f.zip": archive(("p", b"payload")).replace(b"payload", b"paYload"), "g.zip": archive(), "other.txt": b"x",
    }
    for name, raw in files.items():
        (tmp_path / name).write_bytes(raw)
    zip_members.register(spark)
    for split in (1, 1 << 20):
        rows = spark.read.format("zip_members").option("split_bytes", split).load(f"file:{tmp_path}").collect()
        got = sorted(((r["archive"][-5], r["member"], r["bytes"], r["sha256"], r["problem"]) for r in rows), key=repr)
        digest = lambda b: sha256(b).hexdigest()
        want = [
            ("a", "x/1", 3, digest(b"one"), None), ("a", "x/2", 0, digest(b""), None), ("a", "x/ü", 3, digest(b"two"), None), ("b", "long", len(long), digest(long), None), ("b", "tail", 1, digest(b"t"), None), ("c", None, None, None, "not_zip"),
            ("d", "../up", 1, None, "unsafe_name"), ("d", "OK", 1, None, "repeated_name"), ("d", "link", 2, None, "link"), ("d", "ok", 1, digest(b"y"), None), ("e", "bz", 99, None, "method"), ("f", "p", 7, None, "damaged"),
        ]
        assert got == sorted(want, key=repr)
    facts = {r["archive"][-5]: (r["members"], r["problem"]) for r in zip_members.archive_facts(spark.read.format("zip_members").load(str(tmp_path))).collect()}
    assert facts == {"a": (3, None), "b": (2, None), "c": (0, "not_zip"), "d": (4, "link"), "e": (1, "method"), "f": (1, "damaged")}
    assert [r["problem"] for r in spark.read.format("zip_members").option("max_members", 2).load(str(tmp_path / "a.zip")).collect()] == ["too_many"]


def test_limits_of_an_archive_are_asked_first(spark, monkeypatch):
    monkeypatch.setattr(bundles, "MAX_MEMBERS", 1)
    members = spark.createDataFrame([("a", 1, "x", b"1"), ("a", 1, "y", b"2")], "archive_id string, epoch long, path string, content binary")
    with pytest.raises(ValueError, match="over the limits"):
        bundles.build(members)


def test_control_characters_in_stable_json(spark):
    rows = ["\x0b\x1f\x01", "\\u001F", "\\\x1f", "plain", '"\n\t\x7f']
    got = spark.createDataFrame([(r,) for r in rows], "t string").select("t", identity.stable_json(F.col("t")).alias("j")).collect()
    assert {r["t"]: r["j"] for r in got} == {r: json.dumps(r, ensure_ascii=False) for r in rows}
