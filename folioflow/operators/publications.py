"""Publications of closed periods: plans with their archives, fingerprints, weekly references of months, manifests and their checks.

All lists inside a plan or a manifest are arrays of one group (a period), sorted inside the group.  How large the groups are is
asked in an aggregation before anything is collected (:func:`bounded`); larger ones stop the query, because a
manifest is one document.  Hashes are those of the stable JSON of each record.

A :class:`Layout` states where products lie and how they are named.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar as c
from ..functions.identity import bundle_path, sha256, stable_hash, stable_json
from ..functions.strict_json import read_objects
from ..functions.text import table_cell
from ..functions.urls import relative_link
from ..plans.contracts import Contract, violations
from .integrity import shared_folder
from .periods import ARCHIVE_FORMAT_VERSION

MAX_DOCUMENTS = 10_000
MAX_PERIODS = 1_000
#: Bytes of one manifest, and of the JSON of one whole plan.
MAX_MANIFEST_BYTES, MAX_PLAN_BYTES = 4 << 20, 256 << 20
ZONE = "Europe/Berlin"
VERSION = "1.0.0"
FORMATS = ("markdown", "pdf")
PAYLOAD = "struct<artifact_id:string,logical_key:string,sha256:string,bytes:bigint,source_id:string,source_sha256:string,decision_sha256:string,rights_state:string,visibility:string,document_id:string,conversion_id:string>"
_DOCUMENT = ("document_id", "bitstream_id", "version", "source_id", "publication_date", "title", "handle", "doi", "conversion_state")
_SHA = "^[0-9a-f]{64}$"


@dataclass(frozen=True)
class Layout:
    """Names and places of products."""

    prefix: str = "archive"
    bundles: str = "archive"
    indexes: str = "archive/months"
    manifests: str = "archive/manifests"

    def archive_id(self, kind: Column, value: Column, form: Column) -> Column:
        return F.concat_ws("-", F.lit(self.prefix), kind, F.lower(value), form)

    def manifest(self, kind: Column, value: Column) -> Column:
        return F.concat(F.lit(f"{self.manifests}/"), kind, F.lit("/"), value, F.lit(".json"))

    def index(self, kind: Column, start: Column) -> Column:
        return F.when(kind == "month", F.concat(F.lit(f"{self.indexes}/"), F.date_format(start, "yyyy/MM"), F.lit("/Markdown/index.md")))

    def bundle(self, kind: Column, value: Column, start: Column, end: Column, form: Column) -> Column:
        return bundle_path(kind, value, start, end, form, self.bundles)


def dated(periods: DataFrame) -> DataFrame:
    """(kind, value) with start, end and the instant at which the period closed."""
    kind, value = F.col("kind"), F.col("value")
    out = periods.select("kind", "value").distinct().withColumns({"start": c.period_start(kind, value), "end": c.period_end(kind, value)})
    return out.withColumn("epoch", c.close_epoch(F.col("end")))


def bounded(frame: DataFrame, group: list[str], most: int, what: str) -> DataFrame:
    """The frame, if no group has more than ``most`` rows: counted before anything is collected."""
    over = frame.groupBy(*group).count().where(F.col("count") > most).limit(1).collect()
    if over:
        raise ValueError(f"too many {what}: {over[0].asDict()}")
    return frame


def plan_archives(documents: DataFrame, periods: DataFrame, layout: Layout = Layout(), most: int = MAX_DOCUMENTS) -> DataFrame:
    """One row for each period (kind, value) that was asked for: its documents and archives, sorted, their paths, and what is wrong.

    ``documents`` has the columns of a document, ``publication_date`` as a date, and the payloads ``pdf`` and ``markdown`` (struct or
    null).  ``problem`` is mixed_visibility or colliding_names of one of the archives, else null."""
    wanted = dated(periods)
    fan = documents.withColumn("p", F.explode(c.periods_of(F.col("publication_date")))).select("p.kind", "p.value", *documents.columns)
    members = bounded(fan.join(wanted.select("kind", "value"), ["kind", "value"], "left_semi"), ["kind", "value"], most, "documents in a period")
    row = F.struct(F.col("publication_date").cast("string").alias("publication_date"), "document_id", "bitstream_id", *[x for x in _DOCUMENT if x not in ("publication_date", "document_id", "bitstream_id")], "pdf", "markdown")
    plans = wanted.join(members.groupBy("kind", "value").agg(F.array_sort(F.collect_list(row)).alias("documents")), ["kind", "value"], "left")
    plans = plans.withColumn("documents", F.coalesce("documents", F.array().cast(plans.schema["documents"].dataType)))
    made = [_archive(form, layout) for form in FORMATS]
    plans = plans.withColumn("archives", F.filter(F.array(*made), lambda a: F.size(a["entries"]) > 0))
    problem = F.when(F.exists("archives", lambda a: a["collision"]), "colliding_names").when(F.exists("archives", lambda a: a["mixed"]), "mixed_visibility")
    return plans.select("kind", "value", "start", "end", "epoch", "documents", "archives", layout.index(F.col("kind"), F.col("start")).alias("index_path"), layout.manifest(F.col("kind"), F.col("value")).alias("manifest_path"), problem.alias("problem"))


def _archive(form: str, layout: Layout) -> Column:
    kind, value, start, end = (F.col(x) for x in ("kind", "value", "start", "end"))
    payloads = F.filter(F.transform("documents", lambda d: d[form]), lambda p: p.isNotNull())
    folder = "PDF" if form == "pdf" else "Markdown"
    entry = lambda p: F.struct(F.concat(F.lit(f"{folder}/"), F.regexp_extract(p["logical_key"], r"([^/]+)$", 1)).alias("path"), p.alias("prepared"))
    entries = F.array_sort(F.transform(payloads, entry), lambda a, b: F.when(a["path"] < b["path"], -1).when(a["path"] > b["path"], 1).otherwise(0))
    distinct = lambda f: F.size(F.array_distinct(F.transform(payloads, f)))
    return F.struct(
        layout.archive_id(kind, value, F.lit(form)).alias("archive_id"), F.concat(kind, F.lit(f"-{form}")).alias("kind"), layout.bundle(kind, value, start, end, F.lit(form)).alias("relative_bundle"),
        F.get(payloads, F.lit(0))["visibility"].alias("visibility"), entries.alias("entries"), (distinct(lambda p: p["visibility"]) > 1).alias("mixed"),
        (distinct(lambda p: F.lower(F.regexp_extract(p["logical_key"], r"([^/]+)$", 1))) < F.size(payloads)).alias("collision"),
    )


def archive_fingerprint(archive: Column, value: Column, epoch: Column) -> Column:
    """The hash of an archive's inputs."""
    return stable_hash({
        "format_version": ARCHIVE_FORMAT_VERSION, "archive": {"archive_id": archive["archive_id"], "period": value, "kind": archive["kind"]},
        "zip_datetime": (c.archive_datetime(epoch), lambda x: x), "visibility": archive["visibility"],
        "entries": (archive["entries"], lambda x: {"path": x["path"], "bytes": x["prepared"]["bytes"], "sha256": x["prepared"]["sha256"]}),
    })


def _plan_json() -> dict:
    """The record of a period's plan, as it stands inside a list."""
    prepared = ("artifact_id", "logical_key", "sha256", "bytes", "source_id", "source_sha256", "decision_sha256", "rights_state", "visibility", "document_id", "conversion_id")
    day = lambda x: F.col(x).cast("string")
    return {
        "period": {"kind": F.col("kind"), "value": F.col("value"), "start": day("start"), "end": day("end"), "source_date_epoch": F.col("epoch")},
        "documents": (F.col("documents"), lambda d: {x: d[x] for x in _DOCUMENT} | {"pdf": d["pdf"]["artifact_id"], "markdown": d["markdown"]["artifact_id"]}),
        "archives": (F.col("archives"), lambda a: {x: a[x] for x in ("relative_bundle", "archive_id", "kind", "visibility")} | {"entries": (a["entries"], lambda e: {"path": e["path"]} | {x: e["prepared"][x] for x in prepared})}),
        "index_path": F.col("index_path"), "manifest_path": F.col("manifest_path"),
    }


def plan_fingerprints(plans: DataFrame) -> DataFrame:
    """kind, value and the hash of each period's plan alone."""
    return plans.select("kind", "value", stable_hash(_plan_json()).alias("plan_sha256"))


def plan_fingerprint(plans: DataFrame) -> DataFrame:
    """One row: the hash of the whole plan, periods by kind and start.

    A plan is one JSON document, so its size is asked first: ``MAX_PERIODS`` periods and ``MAX_PLAN_BYTES`` at most."""
    texts = plans.select(F.struct(c.kind_rank(F.col("kind")).alias("rank"), "start", F.concat(F.lit("  "), stable_json(_plan_json(), 1)).alias("text")).alias("p"))
    n, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("p.text")), F.lit(0))).first()
    if n > MAX_PERIODS or size > MAX_PLAN_BYTES:
        raise ValueError(f"a plan of {n} periods and {size} bytes is no single document")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["text"]), ",\n")
    whole = F.when(F.count("*") > 0, F.concat(F.lit("[\n"), joined, F.lit("\n]\n"))).otherwise("[]\n")
    return texts.agg(F.count("*").alias("periods"), sha256(whole).alias("input_fingerprint"))


def weekly_references(plans: DataFrame, published: DataFrame | None = None) -> DataFrame:
    """Archives of weeks: those that are planned, and those published ones whose week is not planned again.

    ``published`` has value, archive_id, kind, relative_bundle, input_fingerprint, output_sha256 and bytes."""
    planned = plans.where("kind = 'week'").select("value", "start", "end", "epoch", F.explode("archives").alias("a")).select(
        "value", "start", "end", "a.archive_id", "a.kind", "a.relative_bundle", archive_fingerprint(F.col("a"), F.col("value"), F.col("epoch")).alias("input_fingerprint"),
        F.lit(None).cast("string").alias("output_sha256"), F.lit(None).cast("long").alias("bytes"),
    )
    if published is None:
        return planned
    week = F.lit("week")
    old = published.join(plans.where("kind = 'week'").select("value"), "value", "left_anti").withColumns({"start": c.period_start(week, F.col("value")), "end": c.period_end(week, F.col("value"))})
    return planned.unionByName(old.select(*planned.columns))


def reference_problems(references: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """References that are not canonical or not unique: value, archive_id, problem."""
    form = F.regexp_extract("kind", "^week-(pdf|markdown)$", 1)
    week = F.lit("week")
    twice = references.groupBy("value", "kind").count().where("count > 1").select("value", "kind", F.lit(True).alias("twice"))
    problem = (
        F.when(F.col("start").isNull() | (form == ""), "kind").when(F.col("archive_id") != layout.archive_id(week, F.col("value"), form), "archive_id")
        .when(F.col("relative_bundle") != layout.bundle(week, F.col("value"), F.col("start"), F.col("end"), form), "relative_bundle").when(F.col("twice"), "repeated")
    )
    return references.join(twice, ["value", "kind"], "left").select("value", "archive_id", problem.alias("problem")).where("problem IS NOT NULL")


def month_references(months: DataFrame, references: DataFrame) -> DataFrame:
    """For each month (value) the references of the weeks that share a day with it, in order, and the hash of their list.

    A week names the months of its first and last day, so this is an equi-join."""
    named = references.withColumn("month", F.explode(F.array_distinct(F.array(c.month_label(F.col("start")), c.month_label(F.col("end"))))))
    row = F.struct("start", F.when(F.col("kind") == "week-pdf", 0).otherwise(1).alias("form"), *[x for x in references.columns if x != "start"])
    listed = bounded(named, ["month"], MAX_DOCUMENTS, "archives of a month").groupBy("month").agg(F.array_sort(F.collect_list(row)).alias("references"))
    out = months.select(F.col("value").alias("month")).join(listed, "month", "left")
    out = out.withColumn("references", F.coalesce("references", F.array().cast(out.schema["references"].dataType)))
    of = lambda r: {"period": r["value"]} | {x: r[x] for x in ("archive_id", "kind", "relative_bundle", "input_fingerprint", "output_sha256", "bytes")}
    return out.withColumn("input_fingerprint", stable_hash((F.col("references"), of)))


@dataclass(frozen=True)
class Labels:
    """Words of a month's index."""

    title: str = "Articles"
    count: str = "Articles"
    columns: tuple[str, ...] = ("Date", "Title", "Handle", "Bitstream", "DOI", "PDF", "Markdown", "Conversion", "PDF SHA-256", "Markdown SHA-256", "Weekly archives")
    weekly: str = "Weekly archives"
    none: str = "—"


def month_index(plans: DataFrame, references: DataFrame, labels: Labels = Labels()) -> DataFrame:
    """value, index_path and body (Markdown) of each month: its documents in order, with links to their files and to the weekly archives
    that share a day with the month."""
    months = plans.where("kind = 'month'")
    linked = months.join(month_references(months.select("value"), references).select(F.col("month").alias("value"), "references"), "value")
    link = lambda name, target: F.concat(F.lit("["), name, F.lit("]("), relative_link(F.col("index_path"), target), F.lit(")"))
    weekly = F.transform("references", lambda r: link(F.when(r["kind"] == "week-pdf", "PDF").otherwise("Markdown"), F.concat(r["relative_bundle"], F.lit("/archive.zip"))))
    linked = linked.withColumn("links", F.array_join(weekly, " "))
    none = F.lit(labels.none)
    file = lambda d, form, name: F.when(d[form].isNotNull(), link(F.lit(name), d[form]["logical_key"])).otherwise(none)

    def line(d: Column) -> Column:
        cells = [
            table_cell(d["publication_date"]), table_cell(d["title"]), table_cell(d["handle"]), table_cell(d["bitstream_id"]), F.coalesce(table_cell(d["doi"]), none), file(d, "pdf", "PDF"), file(d, "markdown", "Markdown"),
            table_cell(d["conversion_state"]), F.coalesce(d["pdf"]["sha256"], none), F.coalesce(d["markdown"]["sha256"], none), F.col("links"),
        ]
        return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))

    row = lambda cells: f"| {' | '.join(cells)} |"
    head = F.array(F.concat(F.lit(f"# {labels.title} "), "value"), F.lit(""), F.concat(F.lit(f"{labels.count}: "), F.size("documents").cast("string")), F.lit(""), F.lit(row(labels.columns)), F.lit(row("---" for _ in labels.columns)))
    foot = F.array(F.lit(""), F.lit(f"## {labels.weekly}"), F.lit(""), F.when(F.col("links") == "", none).otherwise(F.col("links")))
    body = F.concat(F.array_join(F.concat(head, F.transform("documents", line), foot), "\n"), F.lit("\n"))
    return linked.select("value", "index_path", body.alias("body"))


def month_manifests(kind: Column, documents: Column, layout: Layout) -> Column:
    """The manifests of the months of a year's documents; of another period none."""
    months = F.array_sort(F.array_distinct(F.transform(documents, lambda d: F.substring(d["publication_date"], 1, 7))))
    return F.when(kind == "year", F.transform(months, lambda m: layout.manifest(F.lit("month"), m))).otherwise(F.array().cast("array<string>"))


def _manifest_json(period: dict, documents: Column, archives: Column, months: Column, fingerprint: Column | None) -> dict:
    """A manifest's record; without a fingerprint as it is hashed: archives then have no storage reference."""
    kept = ("document_id", "bitstream_id", "doi", "version", "source_id", "publication_date", "pdf_artifact_id", "pdf_sha256", "markdown_artifact_id", "markdown_sha256")
    archive = ("archive_id", "kind", "relative_bundle", "input_fingerprint", "output_sha256", "bytes")
    none = F.lit(None).cast("string")
    out = {
        "schema_version": F.lit(VERSION), "kind": period["kind"], "period": period["period"], "timezone": period["timezone"], "start_date": period["start_date"], "end_date": period["end_date"],
        "source_date_epoch": period["source_date_epoch"], "documents": (documents, lambda d: {x: d[x] for x in kept}), "month_manifests": (months, lambda m: m),
        "archives": (archives, lambda a: {x: a[x] for x in archive} | {"storage_reference": none if fingerprint is None else a["storage_reference"]}),
    }
    return out if fingerprint is None else out | {"input_fingerprint": fingerprint}


def render_manifests(plans: DataFrame, builds: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """kind, value, manifest_path, body, input_fingerprint of each period, and ``problem`` where the builds don't fit the plan.

    ``builds`` has archive_id, input_fingerprint, output_sha256 and bytes; each archive of a plan needs just one, of its own
    inputs (problem missing_build, repeated_build, other_inputs).  A body is null where there is a problem."""
    flat = plans.select("kind", "value", "epoch", F.explode("archives").alias("a"))
    stated = flat.select("kind", "value", "a.archive_id", F.col("a.kind").alias("archive_kind"), "a.relative_bundle", archive_fingerprint(F.col("a"), F.col("value"), F.col("epoch")).alias("expected"))
    made = builds.groupBy("archive_id").agg(F.count("*").alias("n"), *[F.min(x).alias(x) for x in ("input_fingerprint", "output_sha256", "bytes")])
    problem = F.when(F.col("n").isNull(), "missing_build").when(F.col("n") > 1, "repeated_build").when(F.col("input_fingerprint") != F.col("expected"), "other_inputs")
    row = F.struct("archive_id", F.col("archive_kind").alias("kind"), "relative_bundle", "input_fingerprint", "output_sha256", "bytes", F.lit(None).cast("string").alias("storage_reference"))
    rows = stated.join(made, "archive_id", "left").groupBy("kind", "value").agg(F.array_sort(F.collect_list(row)).alias("built"), F.min(problem).alias("wrong"))
    out = plans.join(rows, ["kind", "value"], "left")
    out = out.withColumn("built", F.coalesce("built", F.array().cast(out.schema["built"].dataType)))
    payload = lambda d, form: [d[form]["artifact_id"].alias(f"{form}_artifact_id"), d[form]["sha256"].alias(f"{form}_sha256")]
    listed = F.transform("documents", lambda d: F.struct(*[d[x].alias(x) for x in ("document_id", "bitstream_id", "doi", "version", "source_id", "publication_date")], *payload(d, "pdf"), *payload(d, "markdown")))
    out = out.withColumns({"listed": listed, "months": month_manifests(F.col("kind"), F.col("documents"), layout)})
    period = {"kind": F.col("kind"), "period": F.col("value"), "timezone": F.lit(ZONE), "start_date": F.col("start").cast("string"), "end_date": F.col("end").cast("string"), "source_date_epoch": F.col("epoch")}
    parts = (F.col("listed"), F.col("built"), F.col("months"))
    out = out.withColumn("input_fingerprint", stable_hash(_manifest_json(period, *parts, None)))
    body = F.concat(stable_json(_manifest_json(period, *parts, F.col("input_fingerprint"))), F.lit("\n"))
    wrong = F.coalesce("problem", "wrong")
    return out.select("kind", "value", "manifest_path", F.when(wrong.isNull(), body).alias("body"), "input_fingerprint", wrong.alias("problem"))


def _nullable(schema: dict) -> dict:
    return {"oneOf": [{"type": "null"}, schema]}


def _both_or_none(form: str) -> dict:
    """A payload's name and hash are both there or both null."""
    either = lambda kind: {"properties": {f"{form}_artifact_id": {"type": kind}, f"{form}_sha256": {"type": kind}}}
    return {"oneOf": [either("null"), either("string")]}


def _fields(**properties) -> dict:
    return {"type": "object", "additionalProperties": False, "required": sorted(properties), "properties": properties}


_TEXT, _NAME, _HASH = {"type": "string", "minLength": 1}, {"type": "string", "pattern": "^[a-z0-9][a-z0-9._-]{2,200}$"}, {"type": "string", "pattern": _SHA}
MANIFEST = Contract("period-manifest", VERSION, _fields(
    schema_version={"const": VERSION}, kind={"enum": ["week", "month", "year"]}, period=_TEXT, timezone={"const": ZONE}, start_date={"type": "string", "format": "date"}, end_date={"type": "string", "format": "date"},
    source_date_epoch={"type": "integer", "minimum": 0}, input_fingerprint=_HASH, month_manifests={"type": "array", "uniqueItems": True, "items": _TEXT},
    documents={"type": "array", "items": _fields(
        document_id=_TEXT, bitstream_id=_TEXT, doi=_nullable({"type": "string", "maxLength": 512, "pattern": r"^10\.[0-9]{4,9}/[^\s]+$"}), version={"type": "integer", "minimum": 1}, source_id=_TEXT,
        publication_date={"type": "string", "format": "date"}, pdf_artifact_id=_nullable(_NAME), pdf_sha256=_nullable(_HASH), markdown_artifact_id=_nullable(_NAME), markdown_sha256=_nullable(_HASH),
    ) | {"allOf": [_both_or_none("pdf"), _both_or_none("markdown")]}},
    archives={"type": "array", "items": _fields(
        archive_id=_NAME, kind={"enum": [f"{k}-{f}" for k in ("week", "month", "year") for f in FORMATS]}, relative_bundle={"type": "string", "pattern": r"^(?!/)(?!.*(?:^|/)\.\.(?:/|$))(?!.*\\).{1,500}$"},
        input_fingerprint=_HASH, output_sha256=_HASH, bytes={"type": "integer", "minimum": 0}, storage_reference=_nullable(_NAME),
    )},
))
_TYPED_FRAME = "schema_version:string,kind:string,period:string,timezone:string,start_date:string,end_date:string,source_date_epoch:bigint,input_fingerprint:string"
_TYPED_DOCUMENT = "struct<document_id:string,bitstream_id:string,doi:string,version:bigint,source_id:string,publication_date:string,pdf_artifact_id:string,pdf_sha256:string,markdown_artifact_id:string,markdown_sha256:string>"
_TYPED_ARCHIVE = "struct<archive_id:string,kind:string,relative_bundle:string,input_fingerprint:string,output_sha256:string,bytes:bigint,storage_reference:string>"
_TYPED = f"struct<{_TYPED_FRAME},month_manifests:array<string>,documents:array<{_TYPED_DOCUMENT}>,archives:array<{_TYPED_ARCHIVE}>>"


def validate_manifests(manifests: DataFrame, raw: str = "raw", layout: Layout = Layout()) -> DataFrame:
    """``manifests`` with the typed ``manifest`` and the first ``problem`` of each (null: valid).

    In order: what is no bounded JSON object, schema, period, documents_unsorted, document_repeated, archives_unsorted, archive_name,
    archive_repeated, month_manifests, fingerprint, not_canonical."""
    read = read_objects(manifests, raw, MAX_MANIFEST_BYTES, "_value", "problem")
    read = read.withColumn("problem", F.coalesce("problem", F.when(F.size(violations(MANIFEST.schema, F.col("_value"))) > 0, "schema")))
    read = read.withColumn("manifest", F.when(F.col("problem").isNull(), F.try_variant_get("_value", "$", _TYPED))).drop("_value")
    m = F.col("manifest")
    kind, value = m["kind"], m["period"]
    start, end = c.period_start(kind, value), c.period_end(kind, value)
    canonical_period = c.valid_period(kind, value) & (m["start_date"] == start.cast("string")) & (m["end_date"] == end.cast("string")) & (m["source_date_epoch"] == c.close_epoch(end))
    order = F.transform(m["documents"], lambda d: F.struct(d["publication_date"], d["document_id"], d["bitstream_id"]))
    ids = F.transform(m["documents"], lambda d: F.struct(d["document_id"], d["bitstream_id"]))
    names = F.transform(m["archives"], lambda a: a["archive_id"])
    form = lambda a: F.substring_index(a["kind"], "-", -1)
    named = lambda a: (F.substring_index(a["kind"], "-", 1) == kind) & (a["archive_id"] == layout.archive_id(kind, value, form(a))) & (a["relative_bundle"] == layout.bundle(kind, value, start, end, form(a)))
    outside = (kind == "year") & F.exists(m["documents"], lambda d: F.substring(d["publication_date"], 1, 4) != value)
    period = {x: m[x] for x in ("kind", "period", "timezone", "start_date", "end_date", "source_date_epoch")}
    parts = (m["documents"], m["archives"], m["month_manifests"])
    body = F.concat(stable_json(_manifest_json(period, *parts, m["input_fingerprint"])), F.lit("\n"))
    found = (
        F.when(~F.coalesce(canonical_period, F.lit(False)), "period").when(order != F.array_sort(order), "documents_unsorted").when(F.size(F.array_distinct(ids)) < F.size(ids), "document_repeated")
        .when(names != F.array_sort(names), "archives_unsorted").when(~F.forall(m["archives"], named), "archive_name").when(F.size(F.array_distinct(names)) < F.size(names), "archive_repeated")
        .when(outside | (m["month_manifests"] != month_manifests(kind, m["documents"], layout)), "month_manifests")
        .when(m["input_fingerprint"] != stable_hash(_manifest_json(period, *parts, None)), "fingerprint").when(F.col(raw).cast("binary") != body.cast("binary"), "not_canonical")
    )
    return read.withColumn("problem", F.coalesce("problem", F.when(m.isNotNull(), found)))


def inspect_publications(periods: DataFrame, manifests: DataFrame, archives: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """What was published for each asked period (kind, value): manifest_sha256, the number of archives, and the first problem.

    ``manifests`` are files (path, raw); ``archives`` what is known of the archive files: relative_bundle, archive_id, input_fingerprint,
    output_sha256, bytes and problem (null: the container is sound).  Problems: missing_manifest, those of
    :func:`validate_manifests`, other_period, missing_archive, those of the containers, other_archive."""
    asked = periods.select("kind", "value", layout.manifest(F.col("kind"), F.col("value")).alias("path"))
    known = validate_manifests(asked.join(manifests, "path", "left"), layout=layout)
    m = F.col("manifest")
    known = known.withColumn("problem", F.when(F.col("raw").isNull(), "missing_manifest").otherwise(F.coalesce("problem", F.when((m["kind"] != F.col("kind")) | (m["period"] != F.col("value")), "other_period"))))
    shared_folder(known)
    known = known.checkpoint()  # checked once for both uses below; no filter is pushed into the checks
    stated = known.where("problem IS NULL").select("kind", "value", F.explode("manifest.archives").alias("a"))
    have = archives.select(*[F.col(x).alias(f"have_{x}") for x in ("relative_bundle", "archive_id", "input_fingerprint", "output_sha256", "bytes", "problem")])
    same = F.lit(True)
    for x in ("archive_id", "input_fingerprint", "output_sha256", "bytes"):
        same = same & F.col(f"have_{x}").eqNullSafe(F.col("a")[x])
    wrong = F.when(F.col("have_relative_bundle").isNull(), "missing_archive").when(F.col("have_problem").isNotNull(), F.col("have_problem")).when(~same, "other_archive")
    found = stated.join(have, F.col("a.relative_bundle") == F.col("have_relative_bundle"), "left").groupBy("kind", "value").agg(F.count("*").alias("n"), F.min(wrong).alias("wrong"))
    out = known.join(found, ["kind", "value"], "left")
    digest = F.when(F.col("problem").isNull(), F.sha2(F.col("raw").cast("binary"), 256))
    return out.select("kind", "value", digest.alias("manifest_sha256"), F.coalesce("n", F.lit(0)).alias("archives"), F.coalesce("problem", "wrong").alias("problem"))
