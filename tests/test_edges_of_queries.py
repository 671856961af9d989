"""Inputs at which queries once differed from their SQL, or plans grew with the table."""

import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from folioflow.operators import integrity, storage
from folioflow.queries import registry

from .test_queries import rows

EDGES = {
    "bounded_json": ("documents", "doc_id long, text string", [(10_000, "x" * 3989), (10_001, "x" * 3988), (10_002, "x" * 3990), (13, "x"), (12, None)]),
    "item_titles": ("pages", "page_id long, url string, html string", [(1, "https://a/1", "<h1>a &amp;&amp; &quot;b\t c&amp</h1><meta x>"), (2, "https://a/x", "<h2>b</h2>")]),
    "run_clocks": ("orders", "o_orderkey long, o_orderdate timestamp", [(k, datetime.datetime(1995, 1, 1)) for k in (0, 2_500_000, 2_600_000, 8_999_999, 54_000_000)]),
}


@pytest.mark.parametrize("name", EDGES)
def test_edges_equal_sql(spark, tmp_path, name):
    table, schema, data = EDGES[name]
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{table}.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    got = registry.QUERIES[name](spark, str(tmp_path)).toPandas()
    assert rows(got) == rows(con.execute(registry.ORACLE_SQL[name]).df())


def test_owners_do_not_join_references_with_documents(spark):
    references = spark.createDataFrame([(1, 1, "p"), (1, 1, "q"), (2, 1, "z"), (3, 1, None), (4, 2, "p"), (5, 3, "p")], "artifact int, src int, path string")
    documents = spark.createDataFrame([(1, "p", 7), (1, "p", 8), (1, "q", 3), (1, None, 1), (2, "y", 5)], "src int, path string, document int")
    out = storage.owner_of(references, documents, ["src"], "path")
    assert sorted(map(tuple, out.collect())) == [(1, 3, True), (2, 3, True), (4, 5, False)]
    many = spark.range(1000).select(F.lit(1).alias("src"), F.lit("p").alias("path"), F.col("id").alias("document"))
    plan = storage.owner_of(references, many, ["src"], "path")._jdf.queryExecution().optimizedPlan().toString()
    joined = [line for line in plan.split("\n") if "Join" in line]
    assert len(joined) == 2 and plan.count("Aggregate") == 3


def test_cycles_are_not_broadcast(spark):
    edges = spark.range(10).select(F.col("id").alias("node"), ((F.col("id") + 1) % 10).alias("next"))
    plan = integrity.on_cycles(edges, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
