"""Every registered query against its SQL over the smallest tables."""

import numbers
import os
from pathlib import Path

import pandas as pd
import pytest

from folioflow.queries import registry

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = DATA / f"{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path / '*.parquet' if path.is_dir() else path}')")
    return con


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, numbers.Number) and not isinstance(value, bool):
        return str(round(float(value), 6))
    if hasattr(value, "isoformat"):
        return str(pd.Timestamp(value))
    return str(value)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted((tuple(plain(v) for v in r) for r in frame.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, str(DATA)).toPandas()
    assert name in registry.ORACLE_SQL
    assert rows(got) == rows(duck.execute(registry.ORACLE_SQL[name]).df())


def test_entry_works(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
