"""Periods larger than any bound of one row."""

import pytest
from pyspark.sql import functions as F

from folioflow.operators import period_streams, periods, publications
from folioflow.queries import publications as queries
from folioflow.queries import registry

from .test_publications import asked, builds, corpus  # noqa: F401
from .test_queries import DATA, duck, rows  # noqa: F401


@pytest.mark.parametrize("name", ["period_plans", "plan_fingerprint", "month_references", "linked_month_indexes", "period_manifests"])
def test_periods_have_no_largest_size(spark, duck, monkeypatch, name):  # noqa: F811
    monkeypatch.setattr(queries, "MOST", 1, raising=False)
    got = registry.QUERIES[name](spark, str(DATA)).toPandas()
    assert rows(got) == rows(duck.execute(registry.ORACLE_SQL[name]).df())


def test_streams_agree_with_rows(spark, corpus):  # noqa: F811
    ask = asked(spark, ("week", "2024-W05"), ("month", "2024-02"), ("month", "2024-03"), ("year", "2024"))
    facts = period_streams.period_facts(corpus, ask).cache()
    plans = publications.plan_archives(corpus, ask).cache()
    pairs = lambda frame: sorted(map(tuple, frame.collect()))
    assert pairs(period_streams.plan_digests(corpus, facts)) == pairs(publications.plan_fingerprints(plans))
    assert period_streams.plan_digest(corpus, facts).first() == publications.plan_fingerprint(plans).first()
    stated = period_streams.archive_digests(corpus, facts)
    assert pairs(stated.select("a.archive_id", "input_fingerprint")) == pairs(builds(plans).select("archive_id", "input_fingerprint"))
    want = publications.render_manifests(plans, builds(plans)).select("kind", "value", "input_fingerprint", F.sha2(F.col("body").cast("binary"), 256))
    assert pairs(period_streams.manifest_digests(corpus, facts, stated, builds(plans)).select("kind", "value", "input_fingerprint", "body_sha256")) == pairs(want)


def test_an_archive_may_have_any_number_of_members(spark):
    n = F.col("id").cast("string")
    members = spark.range(10_001).select(F.lit("month").alias("kind"), F.lit("2024-01").alias("value"), F.lit("pdf").alias("format"), F.concat(F.lit("x/"), n).alias("path"), n.alias("sha256"), "id", F.lit("public").alias("visibility"), F.lit(0).cast("long").alias("epoch"))
    got = periods.planned_archives(members.withColumnRenamed("id", "bytes")).first()
    assert (got["n"], got["mixed"], got["collision"]) == (10_001, False, False)
