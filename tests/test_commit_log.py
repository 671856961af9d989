"""Writes that commit as a whole: rivals, conflicts, failed tasks."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioflow.sources import commit_log

SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("sha256", T.StringType())])


def objects(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture
def log(spark, tmp_path):
    return commit_log.CommitLog(spark, str(tmp_path / "objects"), SCHEMA, "key", "sha256")


def batches_on_disk(log):
    return sorted(x for x in os.listdir(log.root) if x.startswith("batch-")) if os.path.isdir(log.root) else []


def test_appends_no_ops_and_conflicts(spark, log):
    assert log.read().count() == 0
    assert log.put(objects(spark, ("a", "1"), ("b", "2"))) == 2
    assert log.put(objects(spark, ("a", "1"), ("c", "3"), ("c", "3"))) == 1
    assert log.put(objects(spark, ("a", "1"))) == 0
    for bad in (objects(spark, ("d", "4"), ("a", "other")), objects(spark, ("e", "1"), ("e", "2"))):
        with pytest.raises(commit_log.Conflict):
            log.put(bad)
    assert sorted(map(tuple, log.read().collect())) == [("a", "1"), ("b", "2"), ("c", "3")]
    assert len(batches_on_disk(log)) == len(log.batches()) == 2


def test_a_failed_task_leaves_nothing(spark, log):
    log.put(objects(spark, ("a", "1")))
    broken = objects(spark, ("b", "2"), ("c", "3")).withColumn("sha256", F.when(F.col("key") == "c", F.raise_error(F.lit("lost"))).otherwise(F.col("sha256")))
    with pytest.raises(Exception, match="lost"):
        log.put(broken)
    assert [tuple(r) for r in log.read().collect()] == [("a", "1")] and len(batches_on_disk(log)) == 1


class Overtaken(commit_log.CommitLog):
    """Lets a rival commit between the check and the claim."""

    def _claim(self, number, batch):
        if self.rivals:
            commit_log.CommitLog(self.spark, self.root, self.schema, self.key, self.payload).put(self.rivals.pop())
        return super()._claim(number, batch)


def test_rival_writers(spark, log):
    slow = Overtaken(spark, log.root, SCHEMA, "key", "sha256")
    object.__setattr__(slow, "rivals", [objects(spark, ("x", "1"))])
    assert slow.put(objects(spark, ("y", "2"))) == 1
    assert sorted(map(tuple, log.read().collect())) == [("x", "1"), ("y", "2")]
    object.__setattr__(slow, "rivals", [objects(spark, ("z", "first"))])
    with pytest.raises(commit_log.Conflict):
        slow.put(objects(spark, ("z", "second")))
    object.__setattr__(slow, "rivals", [objects(spark, (f"r{k}", "1")) for k in range(3)])
    with pytest.raises(commit_log.RivalWrite):
        slow.put(objects(spark, ("w", "1")), attempts=2)
    assert {r["key"] for r in log.read().collect()} == {"x", "y", "z", "r2", "r1"} and len(batches_on_disk(log)) == len(log.batches()) == 5
