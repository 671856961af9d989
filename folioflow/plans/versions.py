"""Schema versions: one step at a time, by (name, version); every step is a projection."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as c


def _null(frame: DataFrame, **columns: str) -> DataFrame:
    return frame.withColumns({k: F.lit(None).cast(t) for k, t in columns.items() if k not in frame.columns})


def source_1_0(frame: DataFrame) -> DataFrame:
    return _null(frame, bitstream_url="string", bitstream_version="int", doi="string", decision_sha256="string").withColumn("provenance_state", F.lit("legacy"))


def source_1_1(frame: DataFrame) -> DataFrame:
    return _null(frame, doi="string")


def document_1_0(frame: DataFrame) -> DataFrame:
    day = F.col("publication_date")
    periods = F.struct(c.week_label(day).alias("week"), c.month_label(day).alias("month"), F.year(day).alias("year"))
    return _null(frame, bitstream_version="int").withColumns({"canonical_periods": periods, "provenance_state": F.lit("legacy")})


def conversion_1_0(frame: DataFrame) -> DataFrame:
    return _null(frame, bitstream_id="string", output_sha256="string", fingerprint_sha256="string", storage_reference="string").withColumn("provenance_state", F.lit("legacy"))


def storage_1_0(frame: DataFrame) -> DataFrame:
    return _null(frame, source_id="string", source_sha256="string", document_id="string", conversion_id="string", decision_sha256="string", public_reference="string").withColumn("provenance_state", F.lit("legacy"))


def status_2(frame: DataFrame) -> DataFrame:
    """Flat second version to nested third: clocks and watermarks move into structs, with defaults for what is new."""
    return frame.select(
        F.lit("3.0.0").alias("version"), F.struct(F.col("documents").alias("documents")).alias("corpus"),
        F.struct(F.col("last_week").alias("last_completed_week"), F.col("last_month").alias("last_completed_month"), F.col("last_year").alias("last_completed_year")).alias("periods"),
        F.struct(F.coalesce("state", F.lit("operational")).alias("state"), F.coalesce("failures", F.lit(0)).alias("consecutive_failures")).alias("runtime"),
        F.struct(F.col("last_reset").alias("last_reset"), F.lit(None).cast("timestamp").alias("last_bark")).alias("watchdog"),
    )


STEPS: dict[tuple[str, str], tuple[str, Callable[[DataFrame], DataFrame]]] = {
    ("source", "1.0"): ("1.2", source_1_0),
    ("source", "1.1"): ("1.2", source_1_1),
    ("document", "1.0"): ("1.1", document_1_0),
    ("conversion", "1.0"): ("1.1", conversion_1_0),
    ("storage_reference", "1.0"): ("1.1", storage_1_0),
    ("status", "2"): ("3", status_2),
}


def migrate(name: str, version: str, frame: DataFrame) -> tuple[str, DataFrame]:
    """The frame in the current version of its contract; an unknown predecessor is an error."""
    if (name, version) not in STEPS:
        raise KeyError(f"no step from {name} {version}")
    then, step = STEPS[name, version]
    return then, step(frame)
