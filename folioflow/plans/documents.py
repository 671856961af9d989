"""Plans and documents that are rendered as text: commit plans, month indexes, front matter, markers."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries of one commit or index; a larger group is split by its caller.
MAX_ENTRIES = 10_000
# Forms of a header's fields.
BULLETIN = r"^(?:0?[1-9]|[1-4][0-9]|5[0-3])/[0-9]{4}$"
DOI = r"^10\.[0-9]{4,9}/\S+$"
CONTROL = r"[\x00-\x1f\x7f]"
MAX_TITLE, MAX_DOI, FIRST_YEAR = 1000, 300, 1990


def commit_plan(entries: DataFrame, group: list[str], base: Column, dispatch: Column, scope: str = "archive") -> DataFrame:
    """The commit of each group of entries (path, mode, sha256, task): base, unique entries in path order as a tree hash,
    subject and body with the distinct tasks.  A group of more than ``MAX_ENTRIES`` entries stops the query."""
    row = lambda x: F.concat(x["mode"], F.lit("\x00"), x["path"], F.lit("\x00"), x["sha256"], F.lit("\n"))
    found = F.array_sort(F.collect_set(F.struct("path", "mode", "sha256")))
    plans = entries.groupBy(*group).agg(F.count("*").alias("n"), found.alias("tree"), F.array_sort(F.collect_set("task")).alias("tasks"))
    fits = F.when(F.col("n") <= MAX_ENTRIES, F.size("tree").cast("long")).otherwise(F.raise_error(F.lit("a commit has too many entries")).cast("long"))
    lines = F.concat(F.array(F.lit("Tasks:")), F.transform("tasks", lambda x: F.concat(F.lit("- "), x)), F.array(F.lit(""), F.concat(F.lit("Dispatch-Plan-SHA256: "), dispatch)))
    return plans.select(
        *group, base.alias("expected_base_sha"), F.sha2(F.array_join(F.transform("tree", row), "").cast("binary"), 256).alias("tree_sha256"), fits.alias("entries"),
        F.concat(F.lit(f"chore({scope}): apply "), F.size("tasks").cast("string"), F.lit(" scheduled task(s)")).alias("subject"), F.array_join(lines, "\n").alias("body"),
    )


def index_table(rows: DataFrame, month: Column, order: str, cells: list[Column]) -> DataFrame:
    """A Markdown table body for each month, in order."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), line.alias("line")))), lambda x: x["line"])
    return rows.groupBy(month.alias("month")).agg(F.array_join(listed, "\n").alias("body"), F.count("*").alias("n"))


def front_matter(fields: dict[str, Column]) -> Column:
    """A YAML header of JSON-quoted scalars; nulls are written as null."""
    quoted = lambda c: F.when(c.isNull(), "null").otherwise(F.regexp_extract(F.to_json(F.struct(c.cast("string").alias("v"))), r'^\{"v":(.*)\}$', 1))
    lines = [F.concat(F.lit(f"{name}: "), quoted(c)) for name, c in fields.items()]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n"))


def header_problem(title: Column, day: Column, bulletin: Column, doi: Column) -> Column:
    """The first field of a header that is not in its form (title, publication_date, bulletin_number, doi), else null; bulletin
    and DOI may be null.  The composed form of the title is an Arrow batch function."""

    def composed(batch):
        return pa.array([v is not None and unicodedata.is_normalized("NFC", v) for v in batch.to_pylist()], pa.bool_())

    fits = F.coalesce((title != "") & (F.length(title) <= MAX_TITLE) & ~title.rlike(CONTROL), F.lit(False)) & F.arrow_udf(composed, "boolean")(title)
    return (
        F.when(~fits, "title")
        .when(day.isNull() | (F.year(day) < FIRST_YEAR), "publication_date")
        .when(bulletin.isNotNull() & ~bulletin.rlike(BULLETIN), "bulletin_number")
        .when(doi.isNotNull() & ((F.length(doi) > MAX_DOI) | doi.rlike(CONTROL) | ~doi.rlike(DOI)), "doi")
    )
