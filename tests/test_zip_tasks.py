"""Tasks of a reading of archives stay bounded, and every member is read."""

from folioflow.sources import zip_members

from .test_publications import archive


def test_ranges_share_tasks(spark, tmp_path, monkeypatch):
    for n in range(5):
        (tmp_path / f"{n}.zip").write_bytes(archive(*[(f"m/{k}", b"x" * k) for k in range(1, 201)]))
    (tmp_path / "bad.zip").write_bytes(b"none")
    zip_members.register(spark)
    frame = spark.read.format("zip_members").option("split_bytes", 1).load(str(tmp_path))
    assert frame.rdd.getNumPartitions() <= zip_members.MAX_TASKS
    rows = frame.collect()
    assert sorted((r["archive"][-5], r["bytes"]) for r in rows if r["member"]) == sorted((str(n), k) for n in range(5) for k in range(1, 201))
    assert [r["problem"] for r in rows if r["problem"]] == ["not_zip"]
