"""Manifests of periods of any size, read back from files and checked: :func:`publications.validate_manifests` without a manifest in one row.

A file's lists become rows (:mod:`..sources.json_lists`); each row is checked by its part of the contract, order and repetition by windows and
groups, and what the manifest would be as it stands is hashed as in :mod:`period_streams`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as c
from ..functions.strict_json import strict_value
from ..plans.contracts import violations
from ..sources.json_lists import read_lists
from .chains import digests
from .integrity import kept, shared_folder
from .period_streams import FINGERPRINT, _manifest_frame, _manifest_text, _whole, with_fingerprint
from .publications import _TYPED_ARCHIVE, _TYPED_DOCUMENT, _TYPED_FRAME, FORMATS, MANIFEST, Layout

LISTS = ("documents", "archives", "month_manifests")
_STATED = MANIFEST.schema["properties"]
_FRAME = MANIFEST.schema | {"properties": _STATED | {x: {"type": "array"} for x in LISTS}}
_MONTHS = 12


def manifest_rows(files: DataFrame, root: str) -> DataFrame:
    """The manifests' lists as rows, and a row for each frame (``list`` is null), with what is wrong with each and its typed value."""
    read = read_lists(files, root, LISTS).repartition("path", F.floor(F.col("position") / 1000))
    inside = F.try_variant_get(strict_value(F.concat(F.lit('{"x":['), "text", F.lit("]}"))), "$.x[0]", "variant")  # as deep as it was in its list
    read = read.withColumn("_value", F.when(F.col("list").isNull(), strict_value(F.col("text"))).otherwise(inside))
    value, of = F.col("_value"), F.col("list")
    found, typed = F.when(of.isNull(), violations(_FRAME, value)), {"frame": (of.isNull(), f"struct<{_TYPED_FRAME}>")}
    for name, kind, column in (("documents", _TYPED_DOCUMENT, "d"), ("archives", _TYPED_ARCHIVE, "a"), ("month_manifests", "string", "m")):
        found, typed[column] = found.when(of == name, violations(_STATED[name]["items"], value)), (of == name, kind)
    read = read.withColumn("problem", F.coalesce("problem", F.when(value.isNull(), "beyond_limits"), F.when(F.size(found) > 0, "schema")))
    read = read.withColumns({x: F.when(F.col("problem").isNull() & there, F.try_variant_get(value, "$", kind)) for x, (there, kind) in typed.items()})
    lost = F.lit(True)
    for x in typed:
        lost = lost & F.col(x).isNull()
    return read.withColumn("problem", F.coalesce("problem", F.when(lost, "beyond_limits"))).select("path", "list", "position", "sha256", "problem", *typed)


def _fits(rows: DataFrame) -> DataFrame:
    """A row a file: its frame, the first archives and months, what its documents' dates are, and what is wrong with its JSON or by the contract."""
    of, wrong, day = F.col("list"), F.col("problem"), F.col("d")["publication_date"]
    some = lambda x: F.coalesce(F.max(x), F.lit(False))
    first = lambda name, column, most: F.array_sort(F.collect_list(F.when((of == name) & (F.col("position") <= most), F.struct("position", F.col(column).alias("x")))))
    out = rows.groupBy("path").agg(
        F.max("sha256").alias("sha256"), F.first("frame", True).alias("frame"), F.count(F.when(of == "documents", 1)).alias("n"), F.count(F.when(of == "month_manifests", 1)).alias("n_months"),
        first("archives", "a", len(FORMATS)).alias("built"), first("month_manifests", "m", _MONTHS).alias("months"), F.collect_set(F.substring(day, 1, 7)).alias("dated"), F.min(F.substring(day, 1, 4)).alias("from"),
        F.max(F.substring(day, 1, 4)).alias("to"), F.max(F.when(of.isNull() & ~wrong.isin("schema", "beyond_limits"), wrong)).alias("unread"), some(wrong == "beyond_limits").alias("beyond"), some(wrong == "schema").alias("schema"),
    )
    out = out.withColumns({x: F.transform(x, lambda r: r["x"]) for x in ("built", "months")})
    return out.withColumn("problem", F.coalesce("unread", F.when(F.col("beyond"), "beyond_limits"), F.when(F.col("schema"), "schema"))).drop("unread", "beyond", "schema")


def _lists(rows: DataFrame, name: str) -> DataFrame:
    """The path of each of ``rows`` (path, list) with the names of its lists, each once."""
    return rows.groupBy("path").agg(F.collect_set("list").alias(name))


def manifest_problems(files: DataFrame, root: str, layout: Layout = Layout()) -> DataFrame:
    """path and the first ``problem`` (null: valid) of each manifest among ``files`` (path, below ``root``), as :func:`publications.validate_manifests`
    finds it; no manifest is too_large."""
    made = manifest_rows(files, root)
    place = f"{shared_folder(files)}/manifest-rows-{uuid.uuid4().hex}"
    made.write.parquet(place)
    rows = files.sparkSession.read.schema(made.schema).parquet(place)
    fits = kept(_fits(rows))
    sound = rows.where("list IS NOT NULL").join(fits.where("problem IS NULL").select("path"), "path", "left_semi")
    known = kept(_ordered(fits, sound, layout))
    told = _hashes(known.where("problem IS NULL"), sound)
    wrong = F.when(F.col("frame")["input_fingerprint"] != F.col("fingerprint"), "fingerprint").when(F.col("sha256") != F.col("body"), "not_canonical")
    return known.join(told, "path", "left").select("path", F.coalesce("problem", wrong).alias("problem"))


def _ordered(fits: DataFrame, sound: DataFrame, layout: Layout) -> DataFrame:
    """``fits`` with the first problem of the period, of order, names and months."""
    d, a, kind, value = F.col("d"), F.col("a"), F.col("frame")["kind"], F.col("frame")["period"]
    start, end = c.period_start(kind, value), c.period_end(kind, value)
    none = F.lit("")
    key = F.when(d.isNotNull(), F.struct(d["document_id"].alias("x"), d["bitstream_id"].alias("y"))).when(a.isNotNull(), F.struct(a["archive_id"].alias("x"), none.alias("y"))).otherwise(F.struct(F.col("m").alias("x"), none.alias("y")))
    repeated = sound.groupBy("path", "list", key.alias("key")).count().where("count > 1")
    place = F.struct(F.coalesce(d["publication_date"], none).alias("day"), key.alias("key"))
    before = F.lag("place").over(Window.partitionBy("path", "list").orderBy("position"))
    unsorted = sound.where("list <> 'month_manifests'").select("path", "list", "position", place.alias("place")).withColumn("before", before).where("before > place")
    form = F.substring_index(a["kind"], "-", -1)
    named = (F.substring_index(a["kind"], "-", 1) == kind) & (a["archive_id"] == layout.archive_id(kind, value, form)) & (a["relative_bundle"] == layout.bundle(kind, value, start, end, form))
    misnamed = sound.where("list = 'archives'").select("path", "list", "a").join(fits.select("path", "frame"), "path").where(~F.coalesce(named, F.lit(False)))
    out = fits
    for frame, name in ((repeated, "repeated"), (unsorted, "unsorted"), (misnamed, "misnamed")):
        out = out.join(_lists(frame, name), "path", "left")
    has = lambda name, of: F.coalesce(F.array_contains(name, of), F.lit(False))
    frame = F.col("frame")
    canonical = c.valid_period(kind, value) & (frame["start_date"] == start.cast("string")) & (frame["end_date"] == end.cast("string")) & (frame["source_date_epoch"] == c.close_epoch(end))
    outside = F.coalesce((kind == "year") & ((F.col("from") != value) | (F.col("to") != value)), F.lit(False))
    due = F.when(kind == "year", F.transform(F.array_sort("dated"), lambda m: layout.manifest(F.lit("month"), m))).otherwise(F.array().cast("array<string>"))
    months = outside | (F.col("n_months") != F.size(due)) | (F.col("months") != due)  # a year has twelve at most
    problem = (
        F.when(has("repeated", "month_manifests"), "schema").when(~F.coalesce(canonical, F.lit(False)), "period").when(has("unsorted", "documents"), "documents_unsorted").when(has("repeated", "documents"), "document_repeated")
        .when(has("unsorted", "archives"), "archives_unsorted").when(has("misnamed", "archives"), "archive_name").when(has("repeated", "archives"), "archive_repeated").when(months, "month_manifests")
    )
    return out.select("path", "sha256", "frame", "n", "built", "months", F.coalesce("problem", problem).alias("problem"))


def _hashes(manifests: DataFrame, rows: DataFrame) -> DataFrame:
    """path, the ``fingerprint`` of the inputs, and the hash of the canonical ``body``.

    Storage references are no inputs, so a manifest with such is passed a second time for its body.  Archives have one of each form by now, so they stand in the frame."""
    frame, key = F.col("frame"), ["path", "form"]
    period = {x: frame[x] for x in ("kind", "period", "timezone", "start_date", "end_date", "source_date_epoch")}
    stored = F.exists("built", lambda a: a["storage_reference"].isNotNull())

    def frames(of: DataFrame, form: str, reference) -> DataFrame:
        return of.select("path", F.lit(form).alias("form"), frame["input_fingerprint"].alias("stated"), F.explode(_manifest_frame(period, reference)).alias("_f")).select(*key, "stated", "_f.*")

    inputs = frames(manifests, "inputs", lambda a: F.lit(None).cast("string")).drop("stated")
    bodies = frames(manifests.where(stored), "body", lambda a: a["storage_reference"])
    bodies = bodies.withColumns({"text": with_fingerprint(F.col("text"), F.col("stated"), F.col("late")), "late": F.lit(None).cast("string")}).drop("stated")
    forms = manifests.select("path", F.explode(F.when(stored, F.array(F.lit("inputs"), F.lit("body"))).otherwise(F.array(F.lit("inputs")))).alias("form"))
    documents = rows.where("list = 'documents'").join(F.broadcast(forms), "path").select(*key, F.lit(1).alias("section"), "position", "d")
    found = digests(_whole(inputs.unionByName(bodies), documents), key, ["section", "position"], _manifest_text(F.col("d")), insert=FINGERPRINT)
    at = lambda form, x: F.max(F.when(F.col("form") == form, F.col(x)))
    return found.groupBy("path").agg(at("inputs", "inner").alias("fingerprint"), F.coalesce(at("body", "sha256"), at("inputs", "sha256")).alias("body"))
