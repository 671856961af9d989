"""All registered queries over the driver's tables, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "snapshot_diff"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from . import archive, catalog, contracts, pages, publications, runs, schemas  # noqa: E402,F401  they register their queries
