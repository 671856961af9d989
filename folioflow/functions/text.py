"""Text expressions: redaction, escaping, safe names, page text.  Built-in functions unless a function says otherwise."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# What redaction takes out, in this order.
TOKEN_PATTERNS = (
    (r"(?i)\b(?:github_pat_|gh[pousr]_)[A-Za-z0-9_]{12,}\b", "[REDACTED]"),
    (r"\bsk-[A-Za-z0-9_-]{12,}\b", "[REDACTED]"),
    (r"(?i)(authorization\s*:\s*bearer\s+)\S+", "$1[REDACTED]"),
    (r"(?i)\b(token|password|passwd|secret|api[_-]?key|access[_-]?key)\s*[:=]\s*([^\s,;]+)", "[REDACTED]"),
    (r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b", "[REDACTED]"),
)
PAGE_MARK = "<!-- page {} -->"
MIN_VISIBLE_PER_PAGE = 40
MAX_REPLACEMENT_RATIO = 0.01
# Fixed values, which must match: name of an empty component, reasons in order, verdicts.
FALLBACK_NAME = "datei"
QUALITY_REASONS = ("page_count_mismatch", "too_few_characters", "replacement_ratio", "empty_pages")
QUALITY_VERDICTS = ("good", "needs_review")


def sanitize_url(url: Column) -> Column:
    """Without query and fragment; a URL with credentials, without a host or of another scheme than http(s) becomes a fixed token."""
    plain = url.rlike(r"(?i)^https?://[^/?#]+") & ~url.rlike(r"^[^/?#]*//[^/?#]*@")
    return F.when(url.isNull(), None).when(plain, F.regexp_replace(url, r"(?s)[?#].*$", "")).otherwise(F.lit("[REDACTED-URL]"))


def redact(text: Column, limit: int = 2000) -> Column:
    """Struct (text, changed): NULs out, cut at twice the limit, URLs, secrets in order, cut at the limit."""
    start = F.substring(F.regexp_replace(F.coalesce(text, F.lit("")), "\x00", ""), 1, max(2 * limit, limit))
    # trailing marks stay outside a URL
    out = F.regexp_replace(start, r"https?://[^\s<>/?#]*@[^\s<>]*?(?=[.,;)]*(?:[\s<>]|$))", "[REDACTED-URL]")
    out = F.regexp_replace(out, r"(https?://[^\s<>?#]+)[?#][^\s<>]*?(?=[.,;)]*(?:[\s<>]|$))", "$1")
    for pattern, with_ in TOKEN_PATTERNS:
        out = F.regexp_replace(out, pattern, with_)
    return F.struct(F.substring(out, 1, limit).alias("text"), (out != start).alias("changed"))


def table_cell(text: Column) -> Column:
    """Escapes one Markdown table cell; the ampersand comes first."""
    out = text
    for raw, safe in (("&", "&amp;"), ("\\", "&#92;"), ("[", "&#91;"), ("]", "&#93;"), ("<", "&lt;"), (">", "&gt;"), ("|", "&#124;"), ("\r", " "), ("\n", " ")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def fold_line(value: Column) -> Column:
    """One printable line: terminal codes and control, format and surrogate characters out, white space folded."""
    out = F.regexp_replace(F.coalesce(value, F.lit("-")), "\x1b\\[[0-9;]*[A-Za-z]", "")
    out = F.regexp_replace(out, r"[\s\p{Z}]+", " ")
    return F.trim(F.regexp_replace(out, r"[\p{Cc}\p{Cf}\p{Cs}]", ""))


def markdown_escape(text: Column) -> Column:
    """HTML entities for & < >, then a backslash before Markdown's own characters."""
    out = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.regexp_replace(out, r"([\\`*_{}\[\]()#+.!|-])", r"\\$1")


def safe_component(text: Column, max_length: int = 100) -> Column:
    """A portable display name: percent-decoded, without control characters, reserved characters to ``_``."""
    out = F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)
    out = F.regexp_replace(out, r"[\x00-\x1f\x7f]", "")
    out = F.regexp_replace(out, r'[<>:"/\\|?*]+', "_")
    out = F.regexp_replace(F.regexp_replace(out, r"\s+", " "), r"^[ ._]+|[ ._]+$", "")
    return F.regexp_replace(F.substring(F.when(out == "", F.lit(FALLBACK_NAME)).otherwise(out), 1, max_length), r"[ ._]+$", "")


def joined_identity(values: Column, separator: str, limit: int = 120) -> Column:
    """Parts joined; a longer identity than the limit is replaced by its hash."""
    joined = F.array_join(values, separator)
    return F.when(F.length(joined) > limit, F.concat(F.lit("sha256:"), F.sha2(joined.cast("binary"), 256))).otherwise(joined)


def pages(text: Column) -> Column:
    """Pages of a form-feed separated text; the text ends with a form feed, else the result is null."""
    parts = F.split(text, "\\f")
    return F.when(text.endswith("\f"), F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))))


def page_markers(page_array: Column, name: str = "page") -> Column:
    """Pages with numbered markers, each on a line of its own; null if a page holds a marker itself.  ``name`` is the marker's own."""
    marked = F.transform(page_array, lambda p, i: F.concat(F.lit(f"<!-- {name}: "), (i + 1).cast("string"), F.lit(" -->\n"), F.regexp_replace(p, r"\n+$", "")))
    return F.when(~F.exists(page_array, lambda p: p.contains(f"<!-- {name}:")), F.concat(F.array_join(marked, "\n\n"), F.lit("\n")))


def quality(page_array: Column, expected_pages: Column) -> Column:
    """Struct (visible, replacement_ratio, empty_pages, reasons, verdict) of a document's pages."""
    visible = F.transform(page_array, lambda p: F.length(F.regexp_replace(p, r"[\s\p{Z}\x1c-\x1f\x85]", "")))
    total = F.aggregate(visible, F.lit(0).cast("long"), lambda a, x: a + x)
    replaced = F.aggregate(page_array, F.lit(0).cast("long"), lambda a, p: a + F.length(p) - F.length(F.replace(p, F.lit("�"), F.lit(""))))
    ratio = F.when(total > 0, replaced / total).otherwise(F.lit(0.0))
    empty = F.filter(F.transform(visible, lambda v, i: F.when(v == 0, i + 1)), lambda x: x.isNotNull())
    reasons = F.filter(
        F.array(
            F.when(F.size(page_array) != expected_pages, QUALITY_REASONS[0]),
            F.when(F.exists(visible, lambda v: v < MIN_VISIBLE_PER_PAGE), QUALITY_REASONS[1]),
            F.when(ratio > MAX_REPLACEMENT_RATIO, QUALITY_REASONS[2]),
            F.when(F.size(empty) > 0, QUALITY_REASONS[3]),
        ),
        lambda x: x.isNotNull(),
    )
    return F.struct(total.alias("visible"), ratio.alias("replacement_ratio"), empty.alias("empty_pages"), reasons.alias("reasons"), F.when(F.size(reasons) > 0, QUALITY_VERDICTS[1]).otherwise(QUALITY_VERDICTS[0]).alias("verdict"))


def collision_key(values: Column) -> Column:
    """NFC and case folding, which Spark has no function for: an Arrow batch function."""

    def fold(batch):
        return pa.array([None if v is None else unicodedata.normalize("NFC", v).casefold() for v in batch.to_pylist()], pa.string())

    return F.arrow_udf(fold, "string")(values)
