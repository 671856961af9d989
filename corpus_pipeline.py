"""The corpus pipeline: quality rules, near-dedup, benchmark decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result as Parquet in the
shared folder and reads it again as the next one's input.  All stages but the last return the columns of
documents; the last adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioflow.llm._common import Workspace, table
from folioflow.llm.decontamination import decontaminate
from folioflow.llm.mixing import mixed_corpus
from folioflow.llm.near_dedup import near_dedup
from folioflow.llm.quality_rules import quality_filter
from folioflow.llm.sharding import sharded


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep."""
    return quality_filter(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more)."""
    return near_dedup(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_corpus(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and slot."""
    return sharded(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("near-dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: Learned rules and sketches have no SQL form; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = work.save(stage(spark, docs, sf_dir), f"stage{k}", codec="snappy")
        if k:
            work.drop(f"stage{k - 1}")
    return docs
