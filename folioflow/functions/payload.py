"""Checks of binary payloads and tool output.  PDF checks are expressions; containers are read an Arrow batch at a time."""

from __future__ import annotations

import io
import json
import zipfile
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_PDF_BYTES = 256 << 20
MAX_MEMBERS, MAX_MEMBER_BYTES, MAX_TOTAL_BYTES, MAX_RATIO = 10_000, 256 << 20, 4 << 30, 100
MAX_PIXELS = 100_000_000


def pdf_problem(content: Column, expected_md5: Column, max_bytes: int = MAX_PDF_BYTES) -> Column:
    """The first problem of a PDF's bytes, or null."""
    size = F.octet_length(content)
    tail = F.substring(content, F.greatest(size - 1023, F.lit(1)), F.lit(1024))
    return (
        F.when(content.isNull() | (size == 0), "empty").when(size > max_bytes, "too_large").when(~F.startswith(content, F.lit(b"%PDF-")), "no_magic")
        .when(~F.contains(tail, F.lit(b"%%EOF")), "no_end").when(expected_md5.isNotNull() & (F.md5(content) != F.lower(expected_md5)), "checksum")
    )


def pdfinfo(text: Column) -> Column:
    """(pages, encrypted) of key: value lines; null if a key is missing, repeated or not of its form."""
    line = lambda key: F.filter(F.split(text, "\n"), lambda x: x.startswith(f"{key}:"))
    value = lambda key: F.trim(F.regexp_replace(F.get(line(key), F.lit(0)), "^[^:]*:", ""))
    pages = value("Pages").try_cast("int")
    ok = (F.size(line("Pages")) == 1) & (F.size(line("Encrypted")) == 1) & (pages >= 1) & value("Encrypted").rlike("^(yes|no)")
    return F.when(ok, F.struct(pages.alias("pages"), value("Encrypted").startswith("yes").alias("encrypted")))


def pgm_size(content: Column, max_pixels: int = MAX_PIXELS) -> Column:
    """(width, height) of a binary grey map of eight bits whose length fits its header, else null."""
    head = F.decode(F.substring(content, F.lit(1), F.lit(64)), "ISO-8859-1")
    form = r"^P5\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+255\s"
    width, height = (F.regexp_extract(head, form, k).try_cast("long") for k in (1, 2))
    at = F.length(F.regexp_extract(head, form, 0))
    return F.when((width * height <= max_pixels) & (width * height > 0) & (F.octet_length(content) == at + width * height), F.struct(width.alias("width"), height.alias("height")))


def zip_problem(content: Column) -> Column:
    """The first problem of a bundle, or null: stored members in order within limits, no comments, no unsafe names, and
    checksums that agree with its ``checksums.txt``."""

    def look(raw):
        if raw is None:
            return "empty"
        try:
            with zipfile.ZipFile(io.BytesIO(raw)) as z:
                infos = z.infolist()
                names = [i.filename for i in infos]
                if z.comment or any(i.comment or i.extra for i in infos):
                    return "comment"
                if len(infos) > MAX_MEMBERS or sum(i.file_size for i in infos) > MAX_TOTAL_BYTES or any(i.file_size > MAX_MEMBER_BYTES for i in infos):
                    return "too_large"
                if any(i.file_size > MAX_RATIO * max(1, i.compress_size) for i in infos):
                    return "ratio"
                if any(n.startswith("/") or "\\" in n or ".." in n.split("/") for n in names):
                    return "unsafe_name"
                if len(set(names)) < len(names) or names != sorted(names):
                    return "order"
                if any(i.compress_type != zipfile.ZIP_STORED for i in infos):
                    return "compressed"
                stated = dict(reversed(x.split("  ", 1)) for x in z.read("checksums.txt").decode().splitlines())
                actual = {n: sha256(z.read(n)).hexdigest() for n in names if n not in ("checksums.txt", "manifest.json")}
                if stated != actual:
                    return "checksums"
                if json.loads(z.read("manifest.json"))["entries"] != sorted(actual):
                    return "manifest"
        except (zipfile.BadZipFile, KeyError, ValueError, NotImplementedError):
            return "broken"
        return None

    def batch(values):
        return pa.array([look(v) for v in values.to_pylist()], pa.string())

    return F.arrow_udf(batch, "string")(content)
