"""All-or-nothing runs: plan, materialise, validate, apply, with declared effects."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Task:
    """One kind of work: ``materialise`` makes frames of (path, payload), ``apply`` writes one."""

    name: str
    materialise: Callable[[], DataFrame]


@dataclass
class Outcome:
    status: str
    phase: str
    changed: int = 0
    problems: list[str] = field(default_factory=list)


def coalesce_effects(frames: list[DataFrame]) -> DataFrame:
    """The union of all effects; equal repetitions collapse, different payloads of one path are marked as conflicts."""
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f)
    rows = union.distinct()
    many = rows.groupBy("path").agg(F.count("*").alias("n"))
    return rows.join(many, "path").withColumn("conflict", F.col("n") > 1).drop("n")


def execute(tasks: list[Task], expected: str, current: str, validators: dict[str, Callable[[DataFrame], DataFrame]], apply: Callable[[DataFrame], None], max_operations: int = 10_000) -> Outcome:
    """Runs all tasks in order; nothing is applied unless the base is the expected one and no validator finds a row."""
    if expected != current:
        return Outcome("blocked", "plan", problems=["the base has moved"])
    if not tasks:
        return Outcome("no_op", "plan")
    effects = coalesce_effects([t.materialise() for t in tasks])
    n = effects.count()
    if n > max_operations:
        return Outcome("failed", "validate", problems=["too many operations"])
    problems = ["conflicting effects"] if effects.where("conflict").limit(1).count() else []
    problems += [name for name, check in validators.items() if check(effects).limit(1).count()]
    if problems:
        return Outcome("failed", "validate", problems=problems)
    if n:
        apply(effects.drop("conflict"))
    return Outcome("success" if n else "no_op", "apply", changed=n)
