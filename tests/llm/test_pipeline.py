"""The pipeline's stages, each on its own input."""

import collections

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.01"


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts, ids = docs.columns, [docs.count()], []
    for k, (_, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(pipeline.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        counts.append(docs.count())
        ids.append([r["doc_id"] for r in docs.select("doc_id").collect()])
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] < counts[2] and counts[4] == counts[5]
    assert len(set(ids[1])) == len(ids[1]) and max(collections.Counter(ids[3]).values()) <= 3 and sorted(ids[3]) == sorted(ids[4])
    by = collections.Counter(r["shard"] for r in docs.collect())
    assert max(by.values()) - min(by.values()) <= 1


def test_run(spark):
    out = pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns[-2:] == ["shard", "slot"] and out.count() > 0
