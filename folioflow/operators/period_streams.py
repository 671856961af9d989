"""Publications of periods of any size: the records of :mod:`publications` without a period in one row.

A period's record is dealt into pieces: its frame (a row a period) and one row for each document or archive entry.  Pieces are
shuffled as plain columns, sorted in their partition (Spark spills), written out as text after the sort, and hashed as they
pass, so memory does not grow with a period.  A hash of a whole text is one chain, so one task passes over each period.

A frame is written with marks where its lists belong (:func:`_framed`); marks are drawn for each query.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as c
from ..functions.identity import sha256, stable_json
from ..functions.text import table_cell
from ..functions.urls import relative_link
from .chains import digests
from .integrity import kept
from .periods import ARCHIVE_FORMAT_VERSION
from .publications import _DOCUMENT, FORMATS, VERSION, ZONE, Labels, Layout, dated, month_references

_PERIOD = ["kind", "value"]
_PREPARED = ("artifact_id", "logical_key", "sha256", "bytes", "source_id", "source_sha256", "decision_sha256", "rights_state", "visibility", "document_id", "conversion_id")


def fan_out(documents: DataFrame, periods: DataFrame) -> DataFrame:
    """A row for each document and period (kind, value) that was asked for."""
    fan = documents.withColumn("_p", F.explode(c.periods_of(F.col("publication_date")))).select("_p.kind", "_p.value", *documents.columns)
    return fan.join(F.broadcast(periods.select(*_PERIOD).distinct()), _PERIOD, "left_semi")


def _name(payload: Column) -> Column:
    return F.regexp_extract(payload["logical_key"], r"([^/]+)$", 1)


def _collisions(documents: DataFrame, periods: DataFrame) -> DataFrame:
    """Periods with an archive in which base names collide: only names that the whole table has twice can."""
    named = documents.select("publication_date", F.explode(F.array(*[F.struct(F.lit(f).alias("form"), F.lower(_name(F.col(f))).alias("name"), F.col(f).isNotNull().alias("there")) for f in FORMATS])).alias("n")).where("n.there")
    named = named.select("publication_date", "n.form", "n.name")
    twice = named.groupBy("form", "name").count().where("count > 1").select("form", "name")
    return fan_out(named.join(twice, ["form", "name"], "left_semi"), periods).groupBy(*_PERIOD, "form", "name").count().where("count > 1").select(*_PERIOD, F.lit(True).alias("collision")).distinct()


def period_facts(documents: DataFrame, periods: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """One row for each asked period: its dates and paths, the numbers of documents (``n``), its archives with their numbers of entries, the
    months of its documents, and ``problem`` as in :func:`publications.plan_archives`.  No list grows with the documents."""
    wanted = dated(periods)
    first = F.struct(F.col("publication_date"), F.col("document_id"), F.col("bitstream_id"))
    asked = [F.count("*").alias("n"), F.collect_set(F.date_format("publication_date", "yyyy-MM")).alias("months")]
    for f in FORMATS:
        seen = F.col(f)["visibility"]
        asked += [
            F.count(f).alias(f"n_{f}"), F.min_by(seen, F.when(F.col(f).isNotNull(), first)).alias(f"visibility_{f}"),
            (F.coalesce(F.min(seen) != F.max(seen), F.lit(False)) | ((F.count(seen) > 0) & (F.count(seen) < F.count(f)))).alias(f"mixed_{f}"),
        ]
    out = wanted.join(fan_out(documents, periods).groupBy(*_PERIOD).agg(*asked), _PERIOD, "left").join(_collisions(documents, periods), _PERIOD, "left")
    kind, value, start, end = (F.col(x) for x in ("kind", "value", "start", "end"))
    made = [F.struct(
        layout.archive_id(kind, value, F.lit(f)).alias("archive_id"), F.concat(kind, F.lit(f"-{f}")).alias("kind"), layout.bundle(kind, value, start, end, F.lit(f)).alias("relative_bundle"), F.col(f"visibility_{f}").alias("visibility"),
        F.coalesce(F.col(f"n_{f}"), F.lit(0)).alias("n"), F.lit(f).alias("form"),
    ) for f in FORMATS]
    mixed = F.coalesce(F.col("mixed_pdf") | F.col("mixed_markdown"), F.lit(False))
    problem = F.when(F.col("collision"), "colliding_names").when(mixed, "mixed_visibility")
    none = F.array().cast("array<string>")
    months = F.array_sort(F.when(kind == "year", F.transform("months", lambda m: layout.manifest(F.lit("month"), m))).otherwise(none))
    return out.select(
        "kind", "value", "start", "end", "epoch", F.coalesce("n", F.lit(0)).alias("n"), F.filter(F.array(*made), lambda a: a["n"] > 0).alias("archives"), F.coalesce(months, none).alias("months"),
        layout.index(kind, start).alias("index_path"), layout.manifest(kind, value).alias("manifest_path"), problem.alias("problem"),
    )


def _framed(frame: Column, mark: str, lists: dict[str, tuple[int, str]]) -> Column:
    """Pieces of a frame, whose lists are scalars ``mark`` + name: an array of (section, text, sep).  ``lists`` states section and closing text."""
    pattern = f'"{mark}([a-z]+)"'
    parts, names = F.split(frame, pattern), F.regexp_extract_all(frame, F.lit(pattern), F.lit(1))
    section = F.create_map(*[F.lit(x) for name, (k, _) in lists.items() for x in (name, k)])
    closing = F.create_map(*[F.lit(x) for name, (_, end) in lists.items() for x in (name, end)])
    of = lambda m, i: F.try_element_at(m, F.get(names, i))
    return F.transform(parts, lambda text, i: F.struct(
        F.coalesce(of(section, i - 1) + 1, F.lit(0)).alias("section"), F.concat(F.coalesce(of(closing, i - 1), F.lit("")), text, F.when(i < F.size(names), "[\n").otherwise("")).alias("text"), F.lit(",\n").alias("sep"),
    ))


def _mark() -> str:
    return f"list-{uuid.uuid4().hex}-"


def _frames(frames: DataFrame, columns: list[str], pieces: Column) -> DataFrame:
    return frames.select(*columns, F.explode(pieces).alias("_f")).select(*columns, "_f.*")


def _rows(fan: DataFrame, columns: list[str], sections: dict[str, int], carried: list[str]) -> DataFrame:
    """Rows of lists: of each payload an entry ``e`` by path, of each document ``d`` (the columns ``carried``) by date and ids."""
    fan = fan.withColumn("_d", F.struct(*carried))
    empty = {x: F.lit(None).cast(fan.schema[x].dataType) for x in ("_d", "pdf")}
    out = []
    for name, k in sections.items():
        key = ("", "", "") if name != "documents" else (F.col("publication_date").cast("string"), "document_id", "bitstream_id")
        if name == "documents":
            row = F.struct(F.lit(k).alias("section"), key[0].alias("k1"), F.col(key[1]).alias("k2"), F.col(key[2]).alias("k3"), F.col("_d").alias("d"), empty["pdf"].alias("e"))
        else:
            path = F.concat(F.lit("PDF/" if name == "pdf" else "Markdown/"), _name(F.col(name)))
            row = F.when(F.col(name).isNotNull(), F.struct(F.lit(k).alias("section"), path.alias("k1"), F.lit("").alias("k2"), F.lit("").alias("k3"), empty["_d"].alias("d"), F.col(name).alias("e")))
        out.append(row)
    return fan.select(*columns, F.explode(F.array_compact(F.array(*out))).alias("_r")).select(*columns, "_r.*")


_ORDER = ["section", "k1", "k2", "k3"]


def _whole(frames: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.unionByName(frames, allowMissingColumns=True)


def _shown(document: Column | None, entry: Column | None) -> Column:
    """The text of a piece: of a frame as it stands, else written from its columns."""
    if document is None or entry is None:
        return F.coalesce(F.col("text"), entry if document is None else document)
    return F.when(F.col("text").isNotNull(), F.col("text")).when(F.col("d").isNotNull(), document).otherwise(entry)


def _plan_pieces(documents: DataFrame, facts: DataFrame, base: int, columns: list[str], before: Column, after: Column) -> tuple[DataFrame, Column]:
    mark, pad = _mark(), "  " * base
    day = lambda x: F.col(x).cast("string")
    frame = stable_json({
        "period": {"kind": F.col("kind"), "value": F.col("value"), "start": day("start"), "end": day("end"), "source_date_epoch": F.col("epoch")}, "documents": F.lit(f"{mark}documents"),
        "archives": (F.col("archives"), lambda a: {x: a[x] for x in ("relative_bundle", "archive_id", "kind", "visibility")} | {"entries": F.concat(F.lit(mark), a["form"])}),
        "index_path": F.col("index_path"), "manifest_path": F.col("manifest_path"),
    }, base)
    frame = F.concat(before, F.when(F.col("n") == 0, F.replace(frame, F.lit(f'"{mark}documents"'), F.lit("[]"))).otherwise(frame), after)
    lists = {"markdown": (1, f"\n{pad}      ]"), "pdf": (3, f"\n{pad}      ]"), "documents": (5, f"\n{pad}  ]")}
    d, e = F.col("d"), F.col("e")
    fan = fan_out(documents, facts).join(F.broadcast(facts.select(*_PERIOD, *[x for x in columns if x not in _PERIOD])), _PERIOD) if set(columns) - set(_PERIOD) else fan_out(documents, facts)
    fan = fan.withColumns({"pdf_id": F.col("pdf")["artifact_id"], "markdown_id": F.col("markdown")["artifact_id"]})
    rows = _rows(fan, columns, {k: v[0] for k, v in lists.items()}, [*_DOCUMENT, "pdf_id", "markdown_id"])
    document = {x: (d[x].cast("string") if x == "publication_date" else d[x]) for x in _DOCUMENT} | {"pdf": d["pdf_id"], "markdown": d["markdown_id"]}
    path = {"path": F.col("k1")} | {x: e[x] for x in _PREPARED}
    text = _shown(F.concat(F.lit(f"{pad}    "), stable_json(document, base + 2)), F.concat(F.lit(f"{pad}        "), stable_json(path, base + 4)))
    return _whole(_frames(facts, columns, _framed(frame, mark, lists)), rows), text


def plan_digests(documents: DataFrame, facts: DataFrame) -> DataFrame:
    """kind, value and the hash of each period's plan alone, as :func:`publications.plan_fingerprints`."""
    pieces, text = _plan_pieces(documents, facts, 0, _PERIOD, F.lit(""), F.lit("\n"))
    return digests(pieces, _PERIOD, _ORDER, text).select(*_PERIOD, F.col("sha256").alias("plan_sha256"))


def plan_digest(documents: DataFrame, facts: DataFrame) -> DataFrame:
    """One row, as :func:`publications.plan_fingerprint`: the hash of the whole plan, which is one text and so one stream."""
    periods = Window.partitionBy("plan").orderBy("rank", "start")  # periods alone, no documents
    ranked = facts.withColumns({"plan": F.lit("plan"), "rank": c.kind_rank(F.col("kind"))})
    ranked = ranked.withColumns({"first": F.row_number().over(periods) == 1, "periods": F.count("*").over(Window.partitionBy("plan"))})
    ranked = ranked.withColumn("last", F.row_number().over(Window.partitionBy("plan").orderBy(F.desc("rank"), F.desc("start"))) == 1)
    pieces, text = _plan_pieces(documents, ranked, 1, ["plan", "rank", "start"], F.when(F.col("first"), "[\n  ").otherwise(",\n  "), F.when(F.col("last"), "\n]\n").otherwise(""))
    found = digests(pieces, ["plan"], ["rank", "start", *_ORDER], text)
    return facts.agg(F.count("*").alias("periods")).join(found, F.lit(True), "left").select("periods", F.coalesce("sha256", sha256(F.lit("[]\n"))).alias("input_fingerprint"))


def archive_digests(documents: DataFrame, facts: DataFrame) -> DataFrame:
    """(kind, value, epoch, start, end and ``a``, an archive of the facts) with ``input_fingerprint``, as :func:`publications.archive_fingerprint`."""
    mark, group = _mark(), [*_PERIOD, "form"]
    flat = facts.select(*_PERIOD, "start", "end", "epoch", F.explode("archives").alias("a")).withColumn("form", F.col("a.form"))
    frame = stable_json({
        "format_version": ARCHIVE_FORMAT_VERSION, "archive": {"archive_id": F.col("a.archive_id"), "period": F.col("value"), "kind": F.col("a.kind")}, "zip_datetime": (c.archive_datetime(F.col("epoch")), lambda x: x),
        "visibility": F.col("a.visibility"), "entries": F.lit(f"{mark}entries"),
    })
    e = F.col("e")
    slim = documents.select("publication_date", F.explode(F.array(*[F.struct(F.lit(f).alias("form"), F.col(f).alias("e")) for f in FORMATS])).alias("x")).select("publication_date", "x.*").where("e IS NOT NULL")
    slim = slim.select("publication_date", "form", F.concat(F.when(F.col("form") == "pdf", "PDF/").otherwise("Markdown/"), _name(e)).alias("k1"), F.struct(e["bytes"].alias("bytes"), e["sha256"].alias("sha256")).alias("e"))
    rows = fan_out(slim, facts).select(*group, F.lit(1).alias("section"), "k1", "e")
    text = _shown(None, F.concat(F.lit("    "), stable_json({"path": F.col("k1"), "bytes": e["bytes"], "sha256": e["sha256"]}, 2)))
    pieces = _whole(_frames(flat, group, _framed(F.concat(frame, F.lit("\n")), mark, {"entries": (1, "\n  ]")})), rows)
    return flat.join(digests(pieces, group, ["section", "k1"], text).select(*group, F.col("sha256").alias("input_fingerprint")), group)


def weekly_references(stated: DataFrame) -> DataFrame:
    """Archives of weeks among those of :func:`archive_digests`, as :func:`publications.weekly_references` has them."""
    none = F.lit(None)
    return stated.where("kind = 'week'").select("value", "start", "end", "a.archive_id", "a.kind", "a.relative_bundle", "input_fingerprint", none.cast("string").alias("output_sha256"), none.cast("long").alias("bytes"))


def month_index_digests(documents: DataFrame, facts: DataFrame, references: DataFrame, layout: Layout = Layout(), labels: Labels = Labels()) -> DataFrame:
    """value, index_path and the hash of each month's index, as :func:`publications.month_index` writes it."""
    months = facts.where("kind = 'month'")
    linked = months.join(month_references(months.select("value"), references).select(F.col("month").alias("value"), "references"), "value")
    link = lambda name, at, target: F.concat(F.lit("["), name, F.lit("]("), relative_link(at, target), F.lit(")"))
    weekly = F.transform("references", lambda r: link(F.when(r["kind"] == "week-pdf", "PDF").otherwise("Markdown"), F.col("index_path"), F.concat(r["relative_bundle"], F.lit("/archive.zip"))))
    linked = linked.withColumn("links", F.array_join(weekly, " "))
    none, row = F.lit(labels.none), lambda cells: f"| {' | '.join(cells)} |"
    size = F.col("n").cast("string")
    head = F.concat(F.lit(f"# {labels.title} "), "value", F.lit(f"\n\n{labels.count}: "), size, F.lit(f"\n\n{row(labels.columns)}\n{row('---' for _ in labels.columns)}\n"))
    end = F.concat("links", F.lit(" |\n"))
    foot = F.concat(F.when(F.col("n") > 0, end).otherwise(""), F.lit(f"\n## {labels.weekly}\n\n"), F.when(F.col("links") == "", none).otherwise(F.col("links")), F.lit("\n"))
    piece = lambda k, text: F.struct(F.lit(k).alias("section"), text.alias("text"), end.alias("sep"))
    d = F.col("d")
    at = layout.index(F.lit("month"), F.trunc(d["publication_date"], "month"))
    file = lambda form, name: F.when(d[form].isNotNull(), link(F.lit(name), at, d[form]["logical_key"])).otherwise(none)
    cells = [
        table_cell(d["publication_date"].cast("string")), table_cell(d["title"]), table_cell(d["handle"]), table_cell(d["bitstream_id"]), F.coalesce(table_cell(d["doi"]), none), file("pdf", "PDF"), file("markdown", "Markdown"),
        table_cell(d["conversion_state"]), F.coalesce(d["pdf"]["sha256"], none), F.coalesce(d["markdown"]["sha256"], none),
    ]
    text = _shown(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" | ")), None)
    slim = documents.withColumns({f: F.when(F.col(f).isNotNull(), F.struct(F.col(f)["logical_key"].alias("logical_key"), F.col(f)["sha256"].alias("sha256"))) for f in FORMATS})
    rows = _rows(fan_out(slim, months), _PERIOD, {"documents": 1}, ["publication_date", "title", "handle", "bitstream_id", "doi", "conversion_state", "pdf", "markdown"]).drop("e")
    pieces = _whole(_frames(linked, _PERIOD, F.array(piece(0, head), piece(2, foot))), rows)
    return months.select("value", "index_path").join(digests(pieces, _PERIOD, _ORDER, text).select("value", F.col("sha256").alias("body_sha256")), "value")


_KEPT = ("document_id", "bitstream_id", "doi", "version", "source_id", "publication_date", "pdf_artifact_id", "pdf_sha256", "markdown_artifact_id", "markdown_sha256")


def _manifest_frame(period: dict[str, Column], stored: Callable[[Column], Column]) -> Column:
    """Pieces of a manifest's frame, of the columns ``n``, ``built`` and ``months``: an array of (section, text, sep, late).  The fingerprint of
    the inputs stands before ``late``; ``stored`` gives an archive's storage reference."""
    mark = _mark()
    frame = stable_json({
        "schema_version": F.lit(VERSION), **period, "documents": F.lit(f"{mark}documents"), "month_manifests": (F.col("months"), lambda m: m),
        "archives": (F.col("built"), lambda a: {x: a[x] for x in ("archive_id", "kind", "relative_bundle", "input_fingerprint", "output_sha256", "bytes")} | {"storage_reference": stored(a)}),
    })
    frame = F.concat(F.when(F.col("n") == 0, F.replace(frame, F.lit(f'"{mark}documents"'), F.lit("[]"))).otherwise(frame), F.lit("\n"))
    cut = '\n  "kind": '  # the fingerprint of the inputs stands before this line
    return F.transform(_framed(frame, mark, {"documents": (1, "\n  ]")}), lambda p: F.struct(
        p["section"].alias("section"), F.when(F.contains(p["text"], F.lit(cut)), F.concat(F.substring_index(p["text"], cut, 1), F.lit("\n"))).otherwise(p["text"]).alias("text"), p["sep"].alias("sep"),
        F.when(F.contains(p["text"], F.lit(cut)), F.concat(F.lit(cut[1:]), F.substring_index(p["text"], cut, -1))).alias("late"),
    ))


def _manifest_text(document: Column) -> Column:
    return _shown(F.concat(F.lit("    "), stable_json({x: (document[x].cast("string") if x == "publication_date" else document[x]) for x in _KEPT}, 2)), None)


def manifest_pieces(documents: DataFrame, facts: DataFrame, stated: DataFrame, builds: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """Periods with ``problem`` as :func:`publications.render_manifests` finds it, the pieces of all manifests, and the text of a piece."""
    made = builds.groupBy("archive_id").agg(F.count("*").alias("b"), *[F.min(x).alias(x) for x in ("input_fingerprint", "output_sha256", "bytes")])
    archives = stated.select(*_PERIOD, "a.archive_id", F.col("a.kind").alias("archive_kind"), "a.relative_bundle", F.col("input_fingerprint").alias("expected")).join(made, "archive_id", "left")
    wrong = F.when(F.col("b").isNull(), "missing_build").when(F.col("b") > 1, "repeated_build").when(F.col("input_fingerprint") != F.col("expected"), "other_inputs")
    row = F.struct("archive_id", F.col("archive_kind").alias("kind"), "relative_bundle", "input_fingerprint", "output_sha256", "bytes")
    built = archives.groupBy(*_PERIOD).agg(F.array_sort(F.collect_list(row)).alias("built"), F.min(wrong).alias("wrong"))  # an archive for each format
    out = facts.join(built, _PERIOD, "left")
    out = out.withColumns({"built": F.coalesce("built", F.array().cast(out.schema["built"].dataType)), "problem": F.coalesce("problem", "wrong")})
    period = {"kind": F.col("kind"), "period": F.col("value"), "timezone": F.lit(ZONE), "start_date": F.col("start").cast("string"), "end_date": F.col("end").cast("string"), "source_date_epoch": F.col("epoch")}
    last = _manifest_frame(period, lambda a: F.lit(None).cast("string"))
    frames = out.select(*_PERIOD, F.explode(last).alias("_f")).select(*_PERIOD, "_f.*")
    slim = documents.withColumns({f"{f}_{x}": F.col(f)[x] for f in FORMATS for x in ("artifact_id", "sha256")}).withColumn("pdf", F.lit(None).cast("string")).drop("markdown")
    rows = _rows(fan_out(slim, facts), _PERIOD, {"documents": 1}, list(_KEPT)).drop("e")
    return out, _whole(frames, rows), _manifest_text(F.col("d"))


FINGERPRINT = '  "input_fingerprint": "{}",\n'


def with_fingerprint(text: Column, fingerprint: Column, late: Column) -> Column:
    """The text of a piece with what comes late."""
    before, after = FINGERPRINT.split("{}")
    return F.when(late.isNull(), text).otherwise(F.concat(text, F.lit(before), fingerprint, F.lit(after), late))


def manifest_bodies(documents: DataFrame, facts: DataFrame, stated: DataFrame, builds: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
    """The periods that have no problem (kind, value, manifest_path), the pieces of their manifests' bodies, and the text of a piece."""
    out, pieces, text = manifest_pieces(documents, facts, stated, builds)
    valid = kept(out.where("problem IS NULL").select(*_PERIOD, "manifest_path"))
    pieces = pieces.join(F.broadcast(valid.select(*_PERIOD)), _PERIOD, "left_semi")
    found = digests(pieces, _PERIOD, _ORDER, text, insert=FINGERPRINT).select(*_PERIOD, "inner")
    ends = pieces.where("late IS NOT NULL").join(found, _PERIOD).withColumn("text", with_fingerprint(F.col("text"), F.col("inner"), F.col("late")))
    return valid, pieces.where("late IS NULL").drop("late").unionByName(ends.drop("inner", "late")), text


def manifest_digests(documents: DataFrame, facts: DataFrame, stated: DataFrame, builds: DataFrame) -> DataFrame:
    """kind, value, manifest_path, input_fingerprint, body_sha256 and problem, as of :func:`publications.render_manifests`."""
    out, pieces, text = manifest_pieces(documents, facts, stated, builds)
    found = digests(pieces, _PERIOD, _ORDER, text, insert=FINGERPRINT)
    return out.select(*_PERIOD, "manifest_path", "problem").join(found.select(*_PERIOD, F.col("inner").alias("input_fingerprint"), F.col("sha256").alias("body_sha256")), _PERIOD)
