"""Manifests larger than any bound of one row, read back from files."""

import io
import json
import random
from hashlib import sha256

import pytest

from folioflow.functions.strict_json import _problem
from folioflow.operators import manifest_files, publications
from folioflow.queries import publications as queries
from folioflow.queries import registry
from folioflow.sources import json_lists

from .test_publications import asked, builds, corpus  # noqa: F401
from .test_queries import DATA, duck, rows  # noqa: F401


def test_manifests_have_no_largest_size(spark, duck, monkeypatch):  # noqa: F811
    monkeypatch.setattr(queries, "MOST", 1, raising=False)
    monkeypatch.setattr(publications, "MAX_MANIFEST_BYTES", 100)
    got = registry.QUERIES["manifest_findings"](spark, str(DATA)).toPandas()
    assert rows(got) == rows(duck.execute(registry.ORACLE_SQL["manifest_findings"]).df())


@pytest.fixture
def cases(spark, corpus):  # noqa: F811
    plans = publications.plan_archives(corpus, asked(spark, ("year", "2024")))
    body = json.loads(publications.render_manifests(plans, builds(plans)).first()["body"])
    docs, archives, months = body["documents"], body["archives"], body["month_manifests"]

    def manifest(hashed=None, **changed):
        value = body | changed
        hashed = {k: v for k, v in (value | (hashed or {})).items() if k != "input_fingerprint"}
        value["input_fingerprint"] = changed.get("input_fingerprint") or sha256((json.dumps(hashed, indent=2, sort_keys=True) + "\n").encode()).hexdigest()
        return json.dumps(value, indent=2, sort_keys=True) + "\n"

    stored = [a | {"storage_reference": "store-1"} for a in archives]
    good = manifest()
    return {
        "good": good, "period": manifest(end_date="2024-12-30"), "schema": manifest(kind="day"), "unsorted": manifest(documents=docs[::-1]), "repeated": manifest(documents=[docs[0], docs[0], *docs[1:]]),
        "archives_unsorted": manifest(archives=archives[::-1]), "archive_name": manifest(archives=[archives[0] | {"kind": "month-pdf"}]), "archive_repeated": manifest(archives=[archives[0], archives[0]]),
        "no_months": manifest(month_manifests=[]), "other_months": manifest(month_manifests=months[::-1]), "months_twice": manifest(month_manifests=[*months, months[0]]), "more_months": manifest(month_manifests=[*months, *map(str, range(20))]),
        "outside": manifest(documents=[*docs, docs[-1] | {"publication_date": "2025-01-01", "document_id": "z"}]), "fingerprint": manifest(input_fingerprint="0" * 64), "not_canonical": json.dumps(json.loads(good), sort_keys=True),
        "not_json": "{", "not_object": "[]", "empty": "", "stored": manifest({"archives": archives}, archives=stored), "stored_hashed": manifest(archives=stored), "stored_badly": manifest({"archives": archives}, archives=stored).replace('"store-1"', '"store-1" ', 1),
        "no_documents": manifest(documents=[], archives=[], month_manifests=[]), "no_list": manifest(documents={}), "no_object": manifest(documents=[1]), "no_text": manifest(month_manifests=[1]), "member": manifest(documents=[docs[0] | {"x": 1}]),
        "missing": json.dumps({k: v for k, v in body.items() if k != "archives"}), "twice": good.replace('"kind"', '"kind": 1, "kind"', 1), "list_twice": good.replace('"archives"', '"documents": [], "archives"', 1), "late": good + "x", "space": good + " ",
        "unpaired": good.replace('"timezone"', '"x": "\\ud800", "timezone"'), "infinite": good.replace('"version": ', '"version": 1e999, "x": ', 1), "long": good.replace('"version": ', '"version": ' + "9" * 400 + ', "x": ', 1),
        "deep": manifest(documents=[json.loads("[" * 990 + "]" * 990)]), "deepest": manifest(documents=[json.loads("[" * 1200 + "]" * 1200)]), "whole": good.replace('"version": ', '"version": 1.0, "x": ', 1), "bytes": good.encode().replace(b'"timezone"', b'"\xff"', 1),
    }


def test_files_agree_with_rows(spark, cases, tmp_path):
    raw = {k: v if isinstance(v, bytes) else v.encode() for k, v in cases.items()}
    for name, text in raw.items():
        (tmp_path / name).write_bytes(text)
    want = {r["path"]: r["problem"] for r in publications.validate_manifests(spark.createDataFrame([*raw.items()], "path string, raw binary")).select("path", "problem").collect()}
    got = {r["path"]: r["problem"] for r in manifest_files.manifest_problems(spark.createDataFrame([(x,) for x in raw], "path string"), str(tmp_path)).collect()}
    assert got == want
    assert got["good"] is None and got["stored"] is None and got["stored_hashed"] == "fingerprint"


def test_objects_are_read_in_any_chunks():
    """Faults of random texts are those of the text as a whole, and the items are the lists'."""
    made = random.Random(4)
    texts = [
        '{ "a" : [ "é€😀" , true,false , -0 ] , "c":[{"k":"v\\\\","k2":[1,[2,{"q":"]}"}]]}], "b":"\\ud83d\\ude00", "n":-1.5e3,"z":null }\n', "[1,2,{}]", '"x"', "{}", '{"a":[1,],"b":2}', '{"a":[{"b":1,"b":2}], ]', '{"a":[NaN]}', '{"a":[1e999, 5]}',
        '{"a":[' + "9" * 400 + "]}", '{"a":["\\ud800"]}', '{"a":1}}', '{"a":1,"a":[]}', '{"a":"x\ny"}', "12",
    ]
    for _ in range(6_000):
        raw = bytearray(made.choice(texts).encode())
        for _ in range(made.choice([0, 1, 2])):
            at = made.randrange(len(raw) + 1)
            raw[at : at + made.choice([0, 1])] = bytes([made.choice(b'{}[]",:0e.-\\ \nu\xc3')])
        *items, (_, _, whole, digest, problem) = json_lists._told(json_lists._Text(io.BytesIO(raw), made.choice([1, 2, 3, 7, 50])), ("a", "c"))
        try:
            want = _problem(raw.decode())
        except UnicodeDecodeError:
            want = "not_utf8"
        assert (problem, digest) == (want, None if want else sha256(raw).hexdigest()), bytes(raw)
        if problem is None:
            value = json.loads(whole)
            for name, at, text, *_ in items:
                assert len(value[name]) == at
                value[name].append(json.loads(text))
            assert value == json.loads(raw)
