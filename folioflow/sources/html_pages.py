"""Item pages: anchors, metas and what follows from them.  Parsing HTML is the one thing done in Python, an Arrow batch
at a time; everything after it is expressions over arrays."""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import strict_date

_KIND = pa.struct(
    [
        ("anchors", pa.list_(pa.struct([("pos", pa.int32()), ("href", pa.string()), ("text", pa.string()), ("rel", pa.string())]))),
        ("metas", pa.list_(pa.struct([("pos", pa.int32()), ("name", pa.string()), ("content", pa.string())]))),
        ("heading", pa.string()),
        ("text", pa.string()),
    ]
)
PAGE = "struct<anchors:array<struct<pos:int,href:string,text:string,rel:string>>,metas:array<struct<pos:int,name:string,content:string>>,heading:string,text:string>"
#: Parts of a page.
PARTS = ("anchors", "metas", "heading", "text")
# What names a next page, labels of open and closed access, names of metas in the order of their fields.
NEXT_TEXTS = ("next", "weiter", ">", "›", "»")
OPEN, CLOSED = ("1", "true", "yes", "open", "openaccess"), ("0", "false", "no", "closed", "closedaccess", "restricted", "restrictedaccess")
DATE_METAS = ["dc.date", "dc.date.issued", "dcterms.issued", "citation_publication_date", "citation_date"]
ACCESS_METAS = ["dc.rights.accessrights", "dcterms.accessrights", "citation_open_access", "eprints.accessrights"]
RIGHTS_METAS = {
    "label": ["dc.rights", "dcterms.rights", "citation_publication_rights"], "uri": ["dc.rights.uri", "dcterms.license", "license"], "copyright_notice": ["dc.rights.holder", "dcterms.rightsholder", "copyright"],
}
DOI_METAS = ["dc.identifier", "citation_doi", "dc.identifier.doi"]
#: Characters of a page that are searched for a date or year.
HEAD = 2000


#: What a plain page is made of: tags with quoted attributes, and text.  Pages that hold anything else go to Python's parser.
_TOKEN = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z][a-zA-Z0-9:_-]*=(?:'[^'<>&]*'|"[^"<>&]*"))*)[ \t\n\r\f]*>|([^<]+)""", re.ASCII)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][a-zA-Z0-9:_-]*)=(?:'([^']*)'|"([^"]*)")""", re.ASCII)
#: Elements whose content has rules of its own.
_RAW = {"script", "style", "textarea", "title", "plaintext", "xmp", "iframe", "noembed", "noframes", "noscript"}
#: Pages that are turned into one Arrow array at a time.
CHUNK = 64


class _Page(HTMLParser):
    """``wants`` names the parts that are kept: anchors, metas, heading, text."""

    def __init__(self, wants=PARTS):
        super().__init__(convert_charrefs=True)
        self.wants = wants
        self.anchors, self.metas, self.words, self.heading = [], [], [], None
        self.open, self.skip, self.title = None, 0, None

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.close_anchor()
            if "anchors" in self.wants:
                a = {k: v or "" for k, v in attrs}
                self.open = [a.get("href"), [], f"{a.get('rel', '')} {a.get('class', '')}".strip().lower()]
        elif tag == "meta":
            a = {k: v or "" for k, v in attrs}
            if "metas" in self.wants and (a.get("name") or a.get("property")):
                self.metas.append({"pos": len(self.metas), "name": (a.get("name") or a.get("property")).lower(), "content": a.get("content", "")})
        elif tag in ("script", "style"):
            self.skip += 1
        elif tag in ("h1", "h2") and self.heading is None and self.title is None and "heading" in self.wants:
            self.title = []

    def handle_endtag(self, tag):
        if tag == "a":
            self.close_anchor()
        elif tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag in ("h1", "h2") and self.title is not None:
            self.heading, self.title = " ".join("".join(self.title).split()), None

    def handle_data(self, data):
        if self.skip:
            return
        if "text" in self.wants:
            self.words.append(data)
        if self.open is not None:
            self.open[1].append(data)
        if self.title is not None:
            self.title.append(data)

    def close_anchor(self):
        if self.open is not None and self.open[0] is not None:
            self.anchors.append({"pos": len(self.anchors), "href": self.open[0], "text": " ".join("".join(self.open[1]).split()), "rel": self.open[2]})
        self.open = None

    def plain(self, html: str) -> bool:
        """Reads a plain page; false, and nothing is said of it, if it is none."""
        tokens = list(_TOKEN.finditer(html))
        end = 0
        for m in tokens:
            if m.start() != end or m[2] and m[2].lower() in _RAW or m[1] and m[3]:
                return False
            end = m.end()
        if end != len(html) or tokens and tokens[-1][4] and "&" in tokens[-1][4]:
            return False
        for m in tokens:
            if m[4]:
                if "text" in self.wants or self.open is not None or self.title is not None:
                    self.handle_data(unescape(m[4]) if "&" in m[4] else m[4])
            elif m[1]:
                self.handle_endtag(m[2].lower())
            else:
                tag = m[2].lower()
                self.handle_starttag(tag, [(x[1].lower(), x[2] if x[2] is not None else x[3]) for x in _ATTRIBUTE.finditer(m[3])] if tag in ("a", "meta") else ())
        return True


def _read(html: str, wants) -> dict:
    p = _Page(wants)
    if not p.plain(html):
        p = _Page(wants)
        p.feed(html)
        p.close()
    p.close_anchor()
    return {"anchors": p.anchors, "metas": p.metas, "heading": p.heading, "text": " ".join(" ".join(p.words).split())}


def parse(html: Column, wants: tuple[str, ...] = PARTS) -> Column:
    """Struct of anchors and metas in document order, the first heading, and the visible text; parts that are not among ``wants`` are empty.

    A batch becomes Arrow arrays a few pages at a time, so the worker never holds a batch as Python objects."""
    if set(wants) - set(PARTS):
        raise ValueError(f"no such part of a page: {wants}")

    def pages(batch):
        out = [pa.array([_read(v or "", wants) for v in batch.slice(at, CHUNK).to_pylist()], _KIND) for at in range(0, len(batch), CHUNK)]
        return pa.concat_arrays(out) if out else pa.array([], _KIND)

    return F.arrow_udf(pages, PAGE)(html)


def written_title(html: Column) -> Column:
    """The text of the first plain ``h1`` as the page writes it, white space collapsed: of references only ``&amp;`` is decoded."""
    written = F.replace(F.regexp_extract(html, "<h1>([^<]*)</h1>", 1), F.lit("&amp;"), F.lit("&"))
    return F.trim(F.regexp_replace(written, r"[\t\n\f\r ]+", " "))


def year_collections(anchors: DataFrame) -> DataFrame:
    """(page, year, href) of anchors whose whole text is a year; the last of a year wins."""
    years = anchors.where(F.col("text").rlike(r"^(19|20)\d{2}$"))
    return years.groupBy("page_id", F.col("text").cast("int").alias("year")).agg(F.max_by("href", "pos").alias("href"))


def item_links(anchors: DataFrame, excluded: list[str] = ()) -> DataFrame:
    """Same-site links of a page, each target once, in target order."""
    kept = anchors.where(F.col("href").rlike(r"^/[^/]") & ~F.col("href").isin(*excluded) if excluded else F.col("href").rlike(r"^/[^/]"))
    return kept.groupBy("page_id", "href").agg(F.min_by("text", "pos").alias("text"))


def next_page(anchors: DataFrame) -> DataFrame:
    """The first anchor whose relation or class names a next page anywhere, or whose text says so."""
    says = F.col("rel").contains("next") | F.lower("text").isin(*NEXT_TEXTS)
    return anchors.where(says).groupBy("page_id").agg(F.min_by("href", "pos").alias("next"))


def first_meta(metas: Column, names: list[str]) -> Column:
    """The first non-empty content of any of the names, in document order."""
    hits = F.filter(metas, lambda m: m["name"].isin(*[n.lower() for n in names]) & (F.trim(m["content"]) != ""))
    return F.trim(F.get(hits, F.lit(0))["content"])


def listing_bounds(text: Column) -> Column:
    """(first, last, total) of an English or German listing line, thousands marks removed; null if implausible."""
    en = r"(?i)Now\s+showing\s+items\s+(\d+)\s*[-–]\s*(\d+)\s+of\s+([\d.,]+)"
    de = r"(?i)(?:Einträge|Elemente)\s+(\d+)\s*[-–]\s*(\d+)\s+(?:von|aus)\s+([\d.,]+)"
    part = lambda k: F.regexp_replace(F.when(text.rlike(en), F.regexp_extract(text, en, k)).otherwise(F.regexp_extract(text, de, k)), "[.,]", "").try_cast("long")
    return F.when((part(1) >= 1) & (part(1) <= part(2)) & (part(2) <= part(3)), F.struct(part(1).alias("first"), part(2).alias("last"), part(3).alias("total")))


def publication_date(meta: Column, text: Column, title: Column) -> Column:
    """The first valid date of the meta, the first 2000 characters, and the title."""
    found = lambda c: strict_date(F.regexp_extract(c, r"\b((?:19|20)\d{2}-[01]\d-[0-3]\d)\b", 1))
    return F.coalesce(found(F.coalesce(meta, F.lit(""))), found(F.substring(text, 1, HEAD)), found(F.coalesce(title, F.lit(""))))


def publication_year(day: Column, text: Column, title: Column, fallback: Column) -> Column:
    found = lambda c: F.regexp_extract(c, r"\b((?:19|20)\d{2})\b", 1).try_cast("int")
    return F.coalesce(F.year(day), found(F.substring(text, 1, HEAD)), found(F.coalesce(title, F.lit(""))), fallback)


def open_access(value: Column) -> Column:
    """True, false or null (unsaid) of a rights label."""
    plain = F.lower(F.regexp_replace(value, r"[\s_-]", ""))
    return F.when(plain.isin(*OPEN), True).when(plain.isin(*CLOSED), False)


def rights(metas: Column) -> Column:
    """Struct of what a page states on its rights, as it stands there: label, uri, copyright_notice, open_access."""
    return F.struct(*[first_meta(metas, names).alias(k) for k, names in RIGHTS_METAS.items()], open_access(first_meta(metas, ACCESS_METAS)).alias("open_access"))


def doi(meta: Column, text: Column, prefix: str = r"10\.\d{4,9}") -> Column:
    """The DOI of the meta, else of the text, in lower case."""
    found = lambda c: F.nullif(F.regexp_extract(c, rf"(?i)\b({prefix}/[0-9]+(?:\.[0-9]+)?)\b", 1), F.lit(""))
    return F.lower(F.coalesce(found(F.coalesce(meta, F.lit(""))), found(text)))


def file_candidates(anchors: DataFrame) -> DataFrame:
    """File links of a page, one row for each target: its checksum if one is stated, and whether several differ."""
    files = anchors.where(F.col("href").rlike(r"(?i)\.(pdf|html)([?#]|$)"))
    md5 = F.regexp_extract("text", r"(?i)\bMD5\s*:\s*([0-9a-f]{32})\b", 1)
    return files.withColumn("md5", F.when(md5 != "", F.lower(md5))).groupBy("page_id", "href").agg(F.max("md5").alias("md5"), (F.count_distinct("md5") > 1).alias("conflict"), F.min("pos").alias("pos"))
