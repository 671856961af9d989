"""Rights: exact decisions or the default, the state-by-visibility matrix, authorization, decision hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identity import stable_hash

# Which visibilities a state allows.
ALLOWED = {"approved": ("public", "repository_authorized", "internal", "restricted"), "internal_only": ("internal", "restricted")}
DEFAULT_STATE, DEFAULT_BASIS = "metadata_only", "rights_register_no_match"


def evaluate(subjects: DataFrame, register: DataFrame, keys: list[str]) -> DataFrame:
    """The exact decision for each subject; an unknown or absent one is the default, without a hash."""
    d = register.select(*keys, F.col("state").alias("s"), F.col("basis").alias("b"), F.col("decision_hash").alias("h"))
    joined = subjects.join(d, keys, "left")
    state = F.when(F.col("s").isNull() | (F.col("s") == "unknown"), DEFAULT_STATE).otherwise(F.col("s"))
    return joined.withColumns({"state": state, "basis": F.coalesce("b", F.lit(DEFAULT_BASIS)), "decision_hash": F.col("h")}).drop("s", "b", "h")


def decision_hash(version: int, source_id: Column, source_sha256: Column, state: Column, basis: Column, reviewed_by: Column, reviewed_at: Column) -> Column:
    """Hash of the stable JSON of the decision's named fields."""
    return stable_hash({
        "policy_version": version, "source_id": source_id, "source_sha256": source_sha256, "state": state, "basis": basis,
        "reviewed_by": reviewed_by, "reviewed_at": reviewed_at,
    })


def allowed(state: Column, visibility: Column) -> Column:
    out = F.lit(False)
    for s, ways in ALLOWED.items():
        out = out | ((state == s) & visibility.isin(*ways))
    return out


def policy(state: Column, visibility: Column) -> Column:
    """What may be published: metadata and the link to the origin always, content and derived text by the matrix."""
    may = allowed(state, visibility)
    return F.struct(F.lit(True).alias("metadata"), F.lit(True).alias("origin_link"), may.alias("content"), (may & visibility.isin("public", "repository_authorized")).alias("derived_text"))


def authorized(subjects: DataFrame, register: DataFrame, keys: list[str], visibility: Column) -> DataFrame:
    """Subjects whose decision is current (equal hash and state) and whose state allows the visibility."""
    d = register.select(*keys, F.col("state").alias("s"), F.col("decision_hash").alias("h"))
    return subjects.join(d, keys).where((F.col("state") == F.col("s")) & F.col("decision_hash").eqNullSafe(F.col("h")) & allowed(F.col("s"), visibility)).drop("s", "h")


def invalid_decisions(register: DataFrame, recomputed: Column) -> DataFrame:
    """Decisions whose review fields are not set together, whose sensitive state lacks a review, whose basis is the
    reserved one, or whose stored hash does not recompute."""
    reviewed, dated = F.col("reviewed_by").isNotNull(), F.col("reviewed_at").isNotNull()
    problem = (
        F.when(reviewed != dated, "half_review")
        .when(F.col("state").isin("approved", "internal_only") & ~reviewed, "no_review")
        .when(F.col("basis") == DEFAULT_BASIS, "reserved_basis")
        .when(F.col("decision_hash") != recomputed, "hash_mismatch")
    )
    return register.withColumn("problem", problem).where("problem IS NOT NULL")
