"""URL predicates and rewrites, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def part(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit(name))


def allowed(url: Column, hosts: list[str]) -> Column:
    """https, an allowed host, the default port, no credentials; anything that does not parse is not allowed."""
    host, authority = F.lower(part(url, "HOST")), part(url, "AUTHORITY")
    ok = (part(url, "PROTOCOL") == "https") & host.isin(*hosts) & part(url, "USERINFO").isNull() & (authority.rlike(r"^[^:@]+(:443)?$"))
    return F.coalesce(ok, F.lit(False))


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, "#.*$", "")


def handle_path(url: Column, base_host: str, prefix: str = "handle") -> Column:
    """The handle of a same-host https URL below /prefix/, else null."""
    handle = F.regexp_extract(part(url, "PATH"), rf"^/{prefix}/(\d+/\d+(?:\.\d+)?)/?$", 1)
    return F.when(allowed(url, [base_host]) & (handle != ""), handle)


def with_offset(url: Column, offset: Column) -> Column:
    """Sets the query parameter ``offset``, or takes it away for zero; other parameters stay in order."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(url, r"([?&])offset=[^&#]*&", "$1"), r"[?&]offset=[^&#]*", ""), "#.*$", "")
    joined = F.concat(bare, F.when(bare.contains("?"), "&").otherwise("?"), F.lit("offset="), offset.cast("string"))
    return F.when(offset == 0, bare).otherwise(joined)


def relative_link(source: Column, target: Column) -> Column:
    """A percent-encoded relative path from a file to another: common directories go, then one ``..`` for each left."""
    a, b = F.split(source, "/"), F.split(target, "/")
    shared = F.aggregate(
        F.sequence(F.lit(0), F.least(F.size(a), F.size(b)) - 2),
        F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")),
        lambda s, i: F.when((i >= 0) & s["on"] & (F.get(a, i) == F.get(b, i)), F.struct((s["n"] + 1).alias("n"), F.lit(True).alias("on"))).otherwise(F.struct(s["n"].alias("n"), F.lit(False).alias("on"))),
        lambda s: s["n"],
    )
    up = F.array_repeat(F.lit(".."), F.size(a) - 1 - shared)
    down = F.transform(F.slice(b, shared + 1, F.size(b)), lambda x: F.replace(F.url_encode(x), F.lit("+"), F.lit("%20")))
    return F.array_join(F.concat(up, down), "/")


def beneath(path: Column, root: Column) -> Column:
    """Whether a normal path lies below a root."""
    clean = F.regexp_replace(root, "/+$", "")
    return (path == clean) | path.startswith(F.concat(clean, F.lit("/")))
