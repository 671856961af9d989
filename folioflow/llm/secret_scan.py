"""Secrets by a trigram inverted index: Boolean queries from the rules, intersected postings, verified candidates.

Every rule is a regular expression.  What it must match is read off its syntax tree: the literal strings of each alternative give
trigrams (lower-cased) that any match contains, so a rule becomes an OR over alternatives of an AND over trigrams
(:func:`trigram_query`).  The index holds postings of just the trigrams that some rule needs: for each block of texts
and trigram the keys of the texts that contain it.  Intersecting the lists of an alternative, and joining those of a rule's
alternatives, gives the candidates; only for these the regular expression runs (candidates are a superset, the
expression decides).  A rule with an alternative without a trigram runs over every text.

Only DataFrame and SQL functions.  Blocks follow a hash of row and text, about ``BLOCK_TEXTS`` in each, so posting lists stay short
and even at any size.  Texts move at most once: the rarest trigram of each alternative, by the index's own counts, is asked
where the text lies, and only texts with one of them go into the join with the candidates' keys; all other rows go without their text.
A key shared by two rows only makes more candidates; the skewed part of the join is split by Spark.

Base rules are fixed by their contract; further rules add spans of their own kinds, which may overlap others.

Defined results: null and empty texts have no spans; matches of a rule that are too short are dropped and not searched again; spans are whole
matches in code points, the end exclusive; repeated rows are each searched for themselves; an empty table gives an empty
result; other columns come through :func:`with_secrets` unchanged.
"""

from __future__ import annotations

import re._constants as C
import re._parser as regex_parser
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Workspace, fresh, matches, table, text_or_empty


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Fixed values of the contract; a run of hexadecimal digits that is too short is never begun.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}+", 0, 16),
)
#: Public formats of keys and tokens.
ADDED = (
    Rule("private_key", r"-----BEGIN\x20(?:[A-Z]+\x20)*PRIVATE\x20KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}+"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}+"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("bearer", r"(?i:authorization)\x20*:\x20*(?i:bearer|basic)\x20+[A-Za-z0-9+/_.=~-]{16,}+"),
    Rule("login", r"(?<![a-z0-9+])[a-z][a-z0-9+]{1,15}+://[^\x00-\x20/:@]{1,64}+:[^\x00-\x20/@]{3,64}+@"),
)
RULES = BASE + ADDED
BLOCK_TEXTS = 1024
#: More alternatives than this, or classes of more characters, count as "anything".
_ALTERNATIVES, _CLASS = 64, 8

Query = tuple[frozenset[str], ...]


def trigram_query(pattern: str) -> Query | None:
    """Sets of trigrams of which a matching text, lower-cased, contains at least one whole set; None: nothing is sure."""
    found = {frozenset(part[i : i + 3] for part in _parts(path) for i in range(len(part) - 2)) for path in _paths(regex_parser.parse(pattern))}
    if frozenset() in found:
        return None
    return tuple(sorted((s for s in found if not any(other < s for other in found)), key=sorted))  # a set that holds another adds nothing


def _parts(path: tuple) -> list[str]:
    """The strings between gaps (None)."""
    out = [""]
    for x in path:
        if x is None:
            out.append("")
        else:
            out[-1] += x
    return out


def _paths(tree) -> list[tuple]:
    """The alternatives of a syntax tree, each a row of lower-case characters and gaps."""
    paths: list[tuple] = [()]
    for op, arg in tree:
        step = _step(op, arg)
        longer = {(*p, *s) for p in paths for s in step}
        paths = sorted(longer, key=repr) if len(longer) <= _ALTERNATIVES else [(*p, None) for p in paths]
    return paths


def _step(op, arg) -> list[tuple]:
    gap = [(None,)]
    if op is C.LITERAL:
        return [(chr(arg).lower(),)]
    if op is C.IN:
        chars = {chr(c).lower() for kind, x in arg if kind in (C.LITERAL, C.RANGE) for c in ((x,) if kind is C.LITERAL else range(x[0], min(x[1], x[0] + 2 * _CLASS) + 1))}
        plain = all(kind in (C.LITERAL, C.RANGE) for kind, _ in arg)
        return [(c,) for c in sorted(chars)] if plain and len(chars) <= _CLASS else gap
    if op is C.BRANCH:
        return [p for branch in arg[1] for p in _paths(branch)]
    if op is C.SUBPATTERN:
        return _paths(arg[3])
    if op is C.ATOMIC_GROUP:
        return _paths(arg)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        least, most, inner = arg
        if most == 1:
            return _paths(inner) + ([()] if least == 0 else [])
        return [(*p, None) for p in _paths(inner)] if least else gap
    if op in (C.ASSERT, C.ASSERT_NOT, C.AT):
        return [()]
    return gap


@dataclass(frozen=True)
class Index:
    """Posting lists (block, trigram, keys) of the trigrams that the rules need."""

    postings: DataFrame
    trigrams: tuple[str, ...]

    def counts(self) -> dict[str, int]:
        """In how many texts each trigram is; a row for each trigram."""
        rows = self.postings.groupBy("trigram").agg(F.sum(F.size("keys")).alias("n")).collect()
        return {t: 0 for t in self.trigrams} | {self.trigrams[r["trigram"]]: r["n"] for r in rows}


def row_key(docs: DataFrame, text: str, key: str) -> Column:
    return F.xxhash64(F.col(key), text_or_empty(text))


def build_index(docs: DataFrame, queries: list[Query | None], work: Workspace, text: str = "text", key: str = "doc_id", block_texts: int = BLOCK_TEXTS) -> Index:
    """Writes the postings of the trigrams of ``queries``: one scan, and a shuffle of keys by block and trigram."""
    trigrams = tuple(sorted({t for q in queries if q for s in q for t in s}))
    blocks = max(1, -(-docs.count() // block_texts))
    folded = docs.select(row_key(docs, text, key).alias("key"), F.lower(text_or_empty(text)).alias("low"))
    has = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(n)) for n, t in enumerate(trigrams)], F.lit(None).cast("int")))
    flat = folded.select("key", F.explode(has).alias("trigram"))
    lists = flat.groupBy(F.pmod("key", F.lit(blocks)).alias("block"), "trigram").agg(F.collect_set("key").alias("keys"))
    return Index(work.save(lists, "postings"), trigrams)


def candidates(index: Index, queries: list[Query | None]) -> DataFrame:
    """key and the rules (bits) for which the text of that key must be searched."""
    places = {t: n for n, t in enumerate(index.trigrams)}
    lists = index.postings.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("lists"))
    none = F.array().cast("array<bigint>")

    def meets(trigrams: frozenset[str]) -> Column:
        return reduce(F.array_intersect, [F.coalesce(F.try_element_at("lists", F.lit(places[t])), none) for t in sorted(trigrams)])

    asked = [(n, reduce(F.array_union, [meets(s) for s in q])) for n, q in enumerate(queries) if q]
    rows = F.flatten(F.array(*[F.transform(keys, _of_rule(n)) for n, keys in asked])) if asked else F.array().cast("array<struct<key:bigint,rules:bigint>>")
    found = lists.select(F.explode(rows).alias("r")).select("r.key", "r.rules")
    return found.groupBy("key").agg(F.bit_or("rules").alias("rules"))


def _of_rule(n: int):
    return lambda k: F.struct(k.alias("key"), F.lit(1 << n).cast("long").alias("rules"))


def spans_of(rule: Rule, text: Column) -> Column:
    """Array of (s, e) of a rule's matches that are long enough."""
    found = F.filter(matches(text, rule.pattern, rule.group), lambda x: F.length(x["v"]) >= rule.least)
    return F.when(text.rlike(rule.pattern), F.transform(found, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))).otherwise(F.array().cast("array<struct<s:int,e:int>>"))


def _searched(docs: DataFrame, spans: str, rules: tuple[Rule, ...], text: str, key: str, columns: list[str]) -> DataFrame:
    """``columns`` of every row and its spans: a struct with an array for each rule."""
    work = Workspace(docs.sparkSession, "secrets")
    queries = [trigram_query(r.pattern) for r in rules]
    index = build_index(docs, queries, work, text, key)
    counts = index.counts()
    rarest = sorted({min(s, key=lambda t: (counts[t], t)) for q in queries if q for s in q if all(counts[t] for t in s)})
    at, low, moved, full, bits = fresh(docs.select(*docs.columns, F.lit(0).alias(spans)), "key", "low", "moved", "full", "rules")
    step = docs.withColumns({at: row_key(docs, text, key), low: F.lower(text_or_empty(text))})
    maybe = reduce(lambda a, b: a | b, [F.contains(F.col(low), F.lit(t)) for t in rarest], F.lit(False))
    whole = F.struct(*[spans_of(r, text_or_empty(text)).alias(r.kind) for r, q in zip(rules, queries, strict=True) if q is None], F.lit(0).alias("_"))
    step = step.withColumns({moved: F.when(maybe, F.col(text)), full: whole}).select(*columns, at, moved, full)
    joined = step.join(candidates(index, queries).withColumnsRenamed({"key": at, "rules": bits}), at, "left")

    def of(n: int, r: Rule, q: Query | None) -> Column:
        asked = F.coalesce(F.col(bits), F.lit(0)).bitwiseAND(F.lit(1 << n)) != 0
        return F.col(full)[r.kind] if q is None else F.when(asked, spans_of(r, F.coalesce(F.col(moved), F.lit("")))).otherwise(F.array().cast("array<struct<s:int,e:int>>"))

    found = F.struct(*[of(n, r, q).alias(r.kind) for n, (r, q) in enumerate(zip(rules, queries, strict=True))])
    return joined.select(*columns, found.alias(spans))


def with_secrets(docs: DataFrame, spans: str = "secrets", rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with a struct of the spans (s, e) of each rule."""
    return _searched(docs, spans, rules, text, key, docs.columns)


def masked(docs: DataFrame, mask: str = "[secret]", rules: tuple[Rule, ...] = RULES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with every secret of its text replaced; overlapping spans become one."""
    (spans,) = fresh(docs, "secrets")
    found = with_secrets(docs, spans, rules, text, key)
    every = F.array_sort(F.concat(*[F.col(spans)[r.kind] for r in rules]))
    whole = text_or_empty(text)
    done = F.aggregate(
        every, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        lambda a, x: F.struct(
            F.greatest(a["at"], x["e"]).alias("at"),
            F.when(x["s"] >= a["at"], F.concat(a["out"], F.array(F.substring(whole, a["at"] + 1, x["s"] - a["at"]), F.lit(mask)))).otherwise(a["out"]).alias("out"),
        ),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(whole, a["at"] + 1, F.length(whole))),
    )
    return found.withColumn(text, F.when(F.size(every) > 0, done).otherwise(F.col(text))).select(*docs.columns)


def listing(spans: str, rules: tuple[Rule, ...]) -> Column:
    """kind:begin:end by begin, then the order of the rules, comma-joined."""
    named = [F.transform(F.col(spans)[r.kind], _named(n)) for n, r in enumerate(rules)]
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(F.array_sort(F.concat(*named)), lambda x: F.concat_ws(":", kinds[x["k"]], x["s"].cast("string"), x["e"].cast("string"))), ",")


def _named(n: int):
    return lambda x: F.struct(x["s"].alias("s"), F.lit(n).alias("k"), x["e"].alias("e"))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, and n_spans for every row."""
    found = _searched(docs.select("doc_id", "text"), "found", RULES, "text", "doc_id", ["doc_id"])
    counts = [F.size(F.col("found")[r.kind]).cast("long") for r in RULES]
    return found.select(
        "doc_id", *[c.alias(f"n_{r.kind}") for r, c in zip(BASE, counts, strict=False)],
        F.sha2(listing("found", BASE).cast("binary"), 256).alias("base_sha256"), listing("found", RULES).alias("spans"), sum(counts[1:], counts[0]).alias("n_spans"),
    )


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
