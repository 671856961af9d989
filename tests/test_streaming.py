import datetime as dt

from pyspark.sql import functions as F

from folioflow.streaming import tables


def drain(frame, name, mode):
    q = frame.writeStream.format("memory").queryName(name).outputMode(mode).start()
    q.processAllAvailable()
    q.stop()


def test_windows_equal_batch(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 1 + k % 3, k % 24), "a" if k % 2 else "b", float(k)) for k in range(40)]
    events = spark.createDataFrame(rows, "ts timestamp, event_type string, value double")
    events.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    drain(tables.tumbling(stream, "1 day", "10 days"), "windows", "update")
    assert sorted(map(tuple, spark.table("windows").collect())) == sorted(map(tuple, tables.tumbling(events, "1 day").collect()))


def test_run_states(spark, tmp_path):
    schema = "run string, revision long, status string"
    for k, rows in enumerate(([("a", 1, "created"), ("a", 2, "running"), ("b", 1, "created")], [("a", 3, "success"), ("a", 4, "failed"), ("b", 3, "running")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"u{k}"))
    for k in (0, 1):
        (tmp_path / "in").mkdir(exist_ok=True)
        for f in (tmp_path / f"u{k}").glob("part-*"):
            f.rename(tmp_path / "in" / f"{k}-{f.name}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    drain(tables.run_states(stream), "states", "update")
    last = spark.table("states").groupBy("run").agg(F.max("accepted").alias("accepted"), F.max("rejected").alias("rejected")).collect()
    assert {(r["run"], r["accepted"], r["rejected"]) for r in last} == {("a", 3, 1), ("b", 1, 1)}


def test_late_records_rebuild_their_periods(spark, tmp_path):
    spark.createDataFrame([(dt.date(2024, 12, 30),), (dt.date(2024, 12, 31),)], "day date").write.parquet(str(tmp_path / "late"))
    seen = []
    q = tables.rebuild_late(spark.readStream.schema("day date").parquet(str(tmp_path / "late")), "day", lambda s, p: seen.append(p), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert {x for p in seen for x in p} == {("month", "2024-12"), ("week", "2025-W01"), ("year", "2024")}
