"""Identities, paths, fingerprints and canonical JSON."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import parse_qsl, quote, unquote, urlencode, urlsplit, urlunsplit

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names that some systems keep for devices; no path component may be one of them.
RESERVED = "con|prn|aux|nul|com[1-9]|lpt[1-9]"
MAX_COMPONENT_BYTES = 240


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


#: Control characters whose escapes hold letters; Spark writes these in upper case.
_LETTERED = ("000B", "000E", "000F", "001A", "001B", "001C", "001D", "001E", "001F")


def json_scalar(value: Column) -> Column:
    """A scalar as JSON: other than Spark's own writer, escapes of control characters have lower-case digits."""
    shown = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"})
    lowered = shown
    for code in _LETTERED:
        lowered = F.regexp_replace(lowered, rf"(?<!\\)((?:\\\\)*+)\\u{code}", rf"$1\\u{code.lower()}")
    shown = F.when(shown.rlike(r"\\u00[01][A-F]"), lowered).otherwise(shown)
    text, kind = value.cast("string"), F.typeof(value)  # the type is known when the query is planned, so only one branch is left
    plain = (kind == "string") & ~text.rlike(r'[\x00-\x1f"\\]')
    return F.when(value.isNull(), "null").when(plain, F.concat(F.lit('"'), text, F.lit('"'))).when(kind.isin("int", "bigint"), text).otherwise(F.substring(shown, F.lit(6), F.length(shown) - 6))


@dataclass(frozen=True)
class Nullable:
    """A record that may be missing: null, or what ``of`` makes of the struct."""

    struct: Column
    of: Callable[[Column], dict]


def stable_json(value, level: int = 0) -> Column:
    """Indented JSON with sorted keys, ``,`` and ``: `` between parts, as an expression.

    A dict is an object, a pair (array column, function from element to value) a list, a :class:`Nullable` an object or null, a column a scalar."""
    outer, inner = "  " * level, "  " * (level + 1)
    if isinstance(value, Nullable):
        return F.when(value.struct.isNull(), "null").otherwise(stable_json(value.of(value.struct), level))
    if isinstance(value, dict):
        parts = [F.concat(F.lit(f'{inner}"{name}": '), stable_json(value[name], level + 1)) for name in sorted(value)]
        return F.concat(F.lit("{\n"), F.array_join(F.array(*parts), ",\n"), F.lit(f"\n{outer}}}")) if parts else F.lit("{}")
    if isinstance(value, tuple):
        array, of = value
        rows = F.transform(array, lambda x: F.concat(F.lit(inner), stable_json(of(x), level + 1)))
        return F.when(F.size(array) > 0, F.concat(F.lit("[\n"), F.array_join(rows, ",\n"), F.lit(f"\n{outer}]"))).otherwise(F.lit("[]"))
    return json_scalar(value if isinstance(value, Column) else F.lit(value))


def stable_hash(value) -> Column:
    """Hash of the stable JSON and a final newline."""
    return sha256(F.concat(stable_json(value), F.lit("\n")))


def conversion_fingerprint(source_sha256: Column, converter: Column, version: Column, options_sha256: Column, toolchain: Column, runtime: Column) -> Column:
    """Hash of all that can change a conversion's output.  ``toolchain`` is an array of (name, version_output, executable_sha256,
    argv, environment of (name, value), ocr_settings: null or dpi, color_mode, psm, oem, languages and tessdata of (name, sha256)),
    ``runtime`` has platform, libc, shared_libraries and fonts of (name, sha256)."""
    named = lambda x: {"name": x["name"], "sha256": x["sha256"]}
    ocr = lambda o: {k: o[k] for k in ("dpi", "color_mode", "psm", "oem")} | {"languages": (o["languages"], lambda x: x), "tessdata": (o["tessdata"], named)}
    tool = lambda x: {
        "name": x["name"], "version_output": x["version_output"], "executable_sha256": x["executable_sha256"], "argv": (x["argv"], lambda a: a),
        "environment": (x["environment"], lambda e: {"name": e["name"], "value": e["value"]}), "ocr_settings": Nullable(x["ocr_settings"], ocr),
    }
    return stable_hash({
        "source_sha256": source_sha256, "converter": converter, "converter_version": version, "options_sha256": options_sha256, "toolchain": (toolchain, tool),
        "runtime": {"platform": runtime["platform"], "libc": runtime["libc"], "shared_libraries": (runtime["shared_libraries"], named), "fonts": (runtime["fonts"], named)},
    })


def canonical_bitstream(url: Column) -> Column:
    """Lower-case host, path quoted anew, of the query only ``sequence``.  An Arrow batch function: Spark's own
    URL functions quote differently."""

    def clean(batch):
        out = []
        for v in batch.to_pylist():
            try:
                p = urlsplit(v)
                keep = [(k, x) for k, x in parse_qsl(p.query, keep_blank_values=True) if k == "sequence"]
                out.append(urlunsplit((p.scheme.lower(), p.netloc.lower(), quote(unquote(p.path), safe="/-._~"), urlencode(keep), "")))
            except (ValueError, TypeError, AttributeError):
                out.append(None)
        return pa.array(out, pa.string())

    return F.arrow_udf(clean, "string")(url)


def bitstream_id(canonical_url: Column) -> Column:
    return F.concat(F.lit("bitstream-"), sha256(canonical_url))


def handle_number(handle: Column) -> Column:
    return F.regexp_extract(handle, r"^(\d+)(?:\.\d+)?$", 1)


def handle_version(handle: Column) -> Column:
    """A handle's version: 1 without a suffix; a written version is 2 or more, else null."""
    suffix = F.regexp_extract(handle, r"^\d+\.(\d+)$", 1)
    return F.when(handle.rlike(r"^\d+$"), 1).when(handle.rlike(r"^\d+\.([2-9]|[1-9]\d+)$"), suffix.try_cast("int"))


def supersedes(handle: Column) -> Column:
    """The version before, null for the first: version 2 supersedes the bare number."""
    v, n = handle_version(handle), handle_number(handle)
    return F.when(v == 2, n).when(v > 2, F.concat(n, F.lit("."), (v - 1).cast("string")))


def portable_component(text: Column) -> Column:
    """Whether a path component is portable: short, no reserved name, no separator, no final dot or space."""
    return (F.octet_length(text) <= MAX_COMPONENT_BYTES) & (F.length(text) > 0) & ~text.rlike(rf"(?i)^({RESERVED})(\..*)?$") & ~text.rlike(r'[<>:"/\\|?*\x00-\x1f]') & ~text.rlike(r"[. ]$")


def relative_posix(text: Column) -> Column:
    """Whether a path is relative, without traversal, back-slashes, NULs and empty parts."""
    return text.isNotNull() & (F.length(text) > 0) & ~text.rlike(r"^/|\\|\x00|//|/$") & ~text.rlike(r"(^|/)\.\.?(/|$)")


def document_paths(document: Column, bitstream: Column, kind: Column, day: Column) -> Column:
    """Struct (pdf, markdown): date_kind_document_bitstream below its directory, with hashes where that is too long."""
    stem = F.concat_ws("_", F.date_format(day, "yyyy-MM-dd"), kind, document, bitstream)
    short = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("_"), kind, F.lit("_d-"), sha256(document), F.lit("_b-"), sha256(bitstream))
    stem = F.when(F.octet_length(stem) + 4 > MAX_COMPONENT_BYTES, short).otherwise(stem)
    base = F.when(kind == "issue", F.concat(F.lit("years/"), F.date_format(day, "yyyy"))).otherwise(F.concat(F.lit("articles/"), F.date_format(day, "yyyy/MM")))
    return F.struct(F.concat(base, F.lit("/PDF/"), stem, F.lit(".pdf")).alias("pdf"), F.concat(base, F.lit("/Markdown/"), stem, F.lit(".md")).alias("markdown"))


def bundle_path(kind: Column, value: Column, start: Column, end: Column, form: Column, root: str = "archive") -> Column:
    """Path of a period's bundle; a week is filed under its Monday's month."""
    suffix = F.when(form == "markdown", "Markdown").otherwise("PDF")
    week = F.concat(F.lit(f"{root}/months/"), F.date_format(start, "yyyy/MM"), F.lit("/ZIP/weeks/articles-"), start.cast("string"), F.lit("_to_"), end.cast("string"), F.lit("-"), suffix)
    month = F.concat(F.lit(f"{root}/months/"), F.date_format(start, "yyyy/MM"), F.lit("/ZIP/articles-"), value, F.lit("-"), suffix)
    year = F.concat(F.lit(f"{root}/years/"), F.date_format(start, "yyyy"), F.lit("/ZIP/articles-"), value, F.lit("-"), suffix)
    return F.when(kind == "week", week).when(kind == "month", month).otherwise(year)


def storage_key(prefix: str, key: Column) -> Column:
    """The prefix once, however often it is asked for."""
    return F.when(key.startswith(prefix), key).otherwise(F.concat(F.lit(prefix), key))


def canonical_json(text: Column, indent: int | None = None) -> Column:
    """Keys sorted, ``,`` and ``: `` between parts, a final newline; null for text that is not strict JSON (repeated
    keys, NaN, a byte-order mark).  An Arrow batch function."""

    def pairs(items):
        if len({k for k, _ in items}) < len(items):
            raise ValueError("repeated key")
        return dict(items)

    def refuse(_):
        raise ValueError("not a JSON number")

    def dump(batch):
        out = []
        for v in batch.to_pylist():
            try:
                if v.startswith("﻿"):
                    raise ValueError("byte-order mark")
                got = json.loads(v, object_pairs_hook=pairs, parse_constant=refuse)
                out.append(json.dumps(got, ensure_ascii=False, sort_keys=True, separators=(",", ": "), indent=indent) + "\n")
            except (ValueError, AttributeError, RecursionError):
                out.append(None)
        return pa.array(out, pa.string())

    return F.arrow_udf(dump, "string")(text)


def glob_pattern(glob: Column) -> Column:
    """A case-sensitive glob as a regular expression; ``*`` and ``?`` match separators too."""
    quoted = F.regexp_replace(glob, r"([.\\+^$(){}|])", r"\\$1")
    return F.concat(F.lit("^(?s)"), F.replace(F.replace(F.regexp_replace(quoted, r"\*+", "*"), F.lit("?"), F.lit(".")), F.lit("*"), F.lit(".*")), F.lit("$"))


def content_range_start(value: Column) -> Column:
    """(start, end, total) of ``bytes s-e/total`` if they are consistent, else null."""
    part = lambda k: F.regexp_extract(value, r"^bytes (\d+)-(\d+)/(\d+)$", k).try_cast("long")
    return F.when((part(1) <= part(2)) & (part(2) < part(3)), F.struct(part(1).alias("start"), part(2).alias("end"), part(3).alias("total")))


def media_type_ok(header: Column) -> Column:
    """A PDF, plain bytes, or no header at all."""
    return F.coalesce(F.lower(F.trim(F.split(header, ";")[0])).isin("application/pdf", "application/octet-stream"), F.lit(True))


def pointer(text: Column) -> Column:
    """Struct (oid, size) of a large-file pointer of exactly three lines, else null."""
    form = r"^version https://git-lfs\.github\.com/spec/v1\noid sha256:([0-9a-f]{64})\nsize (0|[1-9]\d*)\n$"
    return F.when(text.rlike(form), F.struct(F.regexp_extract(text, form, 1).alias("oid"), F.regexp_extract(text, form, 2).try_cast("long").alias("size")))


def portable_identity(values: Column) -> Column:
    """Whether an identity is in NFC and case-folded, without separators, a final dot or space, or a device's name.  An
    Arrow batch function for the Unicode part; the rest are expressions."""
    import unicodedata

    def folded(batch):
        return pa.array([None if v is None else v == unicodedata.normalize("NFC", v).casefold() for v in batch.to_pylist()], pa.bool_())

    return F.coalesce(F.arrow_udf(folded, "boolean")(values) & portable_component(values), F.lit(False))


def same_provenance(source: Column, document: Column) -> Column:
    """Whether a source and a document name the same handle and version (``kind-number[.version]``)."""
    form = r"-(\d+(?:\.\d+)?)$"
    return (F.regexp_extract(source, form, 1) == F.regexp_extract(document, form, 1)) & (F.regexp_extract(source, form, 1) != "")
