"""Personal data: high-recall span generators, gradient-boosted trees over format and context, calibrated thresholds.

Only DataFrame and SQL functions.  For each kind a strict base pattern with a check finds spans that always stay.
Generators propose more, overlapping ones: written-out and broken forms of addresses, and for cards and phones every
stretch between two digit groups of a run of numbers whose count of digits fits, so that a number is proposed by itself where the
base pattern reads it together with its neighbours and fails.  Boosted trees score every proposal from features of its format
and of the characters around it; the trees are one SQL expression.  Proposals whose calibrated score passes the kind's
threshold and that touch no base span compete: the best score wins, then the earlier, then the shorter one.

Training needs no marked text.  A proposal that is a base span, begin and end, is a positive; all others are negatives, parts of base
spans too, so the trees learn where a span begins and ends.  Only parts of a match that failed the base check count as neither.  Each is counted a second time in a rewritten form (no plus
sign, other separators, ``at`` and ``dot``), positives and negatives alike: by this the trees meet forms that the base patterns
never accept, and the rewriting itself tells nothing.  Every proposal of every document counts, but the
trees see only a histogram of feature vectors, which a grouped count makes once.  Scores are calibrated on the
third of the documents that the trees did not see: the threshold of a kind is the lowest score bin from which on
at least ``PRECISION`` of the held-out proposals, and one failure more, are positives; a kind that never reaches it adds nothing.

Patterns use possessive quantifiers and begin only where a run of their first characters begins (or where the last
match ended), so they find the same leftmost spans as the plain patterns, in linear time and without recursion.

Secrets (a name such as token or password, a sign, and a long string) are found by a pattern alone; they are no kind of span and are
counted apart.

Defined results: null and empty text has no spans; a table without proposals learns nothing and adds nothing; repeated rows are
searched each for itself and train as often as they stand there; other columns come through :func:`with_spans` unchanged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import Workspace, bound, fresh, matches, table

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without these has no proposal of the kind, so its patterns need not run.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"[0-9]"}
#: Generators: wider than the base patterns, so that they meet written-out, broken and unchecked forms too.
_AT, _DOT = r"(?:\x20?[@＠]\x20?|\x20?[\[(]at[\])]\x20?|\x20at\x20)", r"(?:\x20?\.|\x20?[\[(]dot[\])]\x20?|\x20dot\x20)"
WIDE = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:(?:[.,]\x20?|\x20\.\x20|\[\.\])[0-9]++){3}+",
    "card": r"[0-9](?:[\x20.\-_]{0,2}+[0-9])++",
    "phone": r"[+(]{0,2}+[0-9](?:[\x20()./-]{0,3}+[0-9])++",
}
_MAY = {"email": r"[@＠]|[\x20\[(]at[\x20\])]", "ip": r"[0-9][.,\x20\[]", "card": r"[0-9](?:[\x20.\-_]{0,2}[0-9]){11}", "phone": r"[0-9](?:[\x20()./-]{0,3}[0-9]){6}"}
#: Digits of a stretch that is proposed from a run of numbers.
STRETCH = {"card": (13, 19), "phone": (7, 15)}
SECRET = r"(?i)(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\x22']?\x20?[=:]\x20?[\x22']?[A-Za-z0-9+/_-]{16,}+"
FEATURES = ("digits", "length", "marks", "groups", "first", "lead", "before", "upper", "ends", "check", "head", "tail", "widest")
ROUNDS = 8
LEARNING_RATE = 0.5
PRECISION = 0.98
SCORE_BINS = 40
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _of(f, bound):
    """A function of one element: Spark would take a second parameter for the element's index."""
    return lambda x: f(x, bound)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda a, i: a + F.when(F.pmod(F.length(digits) - i, F.lit(2)) == 0, _digit(digits, i)).otherwise(_doubled(_digit(digits, i))),
    )
    return F.pmod(total, F.lit(10)) == 0


def _digit(digits: Column, i: Column) -> Column:
    return F.ascii(F.substring(digits, i, F.lit(1))) - 48


def _doubled(d: Column) -> Column:
    return F.when(d >= 5, 2 * d - 9).otherwise(2 * d)


def passes(kind: str, value: Column) -> Column:
    digits = digits_of(value)
    n = F.length(digits)
    return {
        "email": F.lit(True),
        "ip": value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "card": n.between(16, 19) & F.when(n.between(16, 19), luhn(digits)).otherwise(False),
        "phone": n.between(8, 15),
    }[kind]


def base_matches(text: Column) -> dict[str, Column]:
    """For each kind the array of (s, e, ok) that match; ok: the check passes, so it is a base span."""
    empty = F.array().cast("array<struct<s:int,e:int,ok:boolean>>")
    judged = {k: F.transform(matches(text, BASE[k]), _of(lambda x, k: F.struct(x["s"].alias("s"), x["e"].alias("e"), passes(k, x["v"]).alias("ok")), k)) for k in KINDS}
    return {k: F.when(text.rlike(NEEDS[k]), judged[k]).otherwise(empty) for k in KINDS}


def proposals(text: Column) -> dict[str, Column]:
    """For each kind the array of proposed (s, e, v); they may overlap."""
    empty = F.array().cast("array<struct<s:int,e:int,v:string>>")
    found = {k: matches(text, WIDE[k]) for k in KINDS}
    for k, (low, high) in STRETCH.items():
        found[k] = F.flatten(F.transform(found[k], _of(lambda run, bounds: _stretches(run, *bounds), (low, high))))
    return {k: F.when(text.rlike(_MAY[k]), found[k]).otherwise(empty) for k in KINDS}


def _stretches(run: Column, low: int, high: int) -> Column:
    """All parts of a run of numbers, from the begin of one digit group to the end of another, that have ``low`` to ``high`` digits; a plus sign or
    bracket before the first belongs to it.

    The run is cut once into pieces, each a group with what stands before it.  A part has at most ``high`` groups and is joined from
    its pieces, so the time is linear in the run's length; which ends fit is asked of the groups' lengths before any text is joined."""
    empty = F.array().cast("array<struct<s:int,e:int,v:string>>")

    def parts(x: Column) -> Column:
        groups, pieces, last = x["groups"], x["pieces"], F.size(x["pieces"]) - 1

        def until(i: Column) -> Column:
            digits = lambda j: F.aggregate(F.slice(groups, i + 1, j - i + 1), F.lit(0), lambda a, g: a + g["e"] - g["s"])
            ends = F.filter(F.sequence(i, F.least(i + high - 1, last)), lambda j: digits(j).between(low, high))
            first = F.regexp_extract(pieces[i], r"\+?\(?[0-9]+$", 0)

            def part(j: Column, first: Column) -> Column:
                begin = groups[i]["e"] - F.length(first)
                return F.struct((run["s"] + begin).alias("s"), (run["s"] + groups[j]["e"]).alias("e"), F.concat(first, F.array_join(F.slice(pieces, i + 2, j - i), "")).alias("v"))

            return F.when((groups[i]["e"] - groups[i]["s"]) <= high, bound(first, lambda first: F.transform(ends, lambda j: part(j, first)))).otherwise(empty)

        return F.flatten(F.transform(F.sequence(F.lit(0), last), lambda i: until(i)))

    cut = F.struct(matches(run["v"], "[0-9]+").alias("groups"), F.regexp_extract_all(run["v"], F.lit("[^0-9]*+[0-9]+"), F.lit(0)).alias("pieces"))
    # a run that is too short has no part
    return F.when(F.length(digits_of(run["v"])) >= low, bound(cut, parts)).otherwise(empty)


def rewritten(kind: str, v: Column) -> Column:
    """Another way to write a span of the kind."""
    return {
        "email": F.regexp_replace(F.regexp_replace(v, "@", " at "), r"\.([A-Za-z0-9-]+)$", " dot $1"),
        "ip": F.regexp_replace(v, r"\.", ", "),
        "card": F.regexp_replace(v, r"[\x20-]", "."),
        "phone": F.regexp_replace(v, r"^\+", ""),
    }[kind]


def features_of(kind: str, around: Column, v: Column) -> Column:
    """Small numbers (0..31) that tell proposals apart: format of the span ``v``, and the text before and after it (``around``)."""
    small = lambda c: F.least(c, F.lit(31)).cast("int")

    def numbers(q: Column) -> Column:
        v, digits, groups, before, last, after = (q[k] for k in ("v", "digits", "groups", "before", "last", "after"))
        check = {
            "card": F.when(F.length(digits).between(12, 19), luhn(digits).cast("int")).otherwise(0),
            "ip": F.forall(groups, lambda g: g.rlike(f"^{_OCTET}$")).cast("int"),
        }.get(kind, F.lit(0))
        values = [
            small(F.length(digits)),
            small(F.length(v)),
            small(F.length(F.regexp_replace(v, r"[A-Za-z0-9\x20]", ""))),
            small(F.size(groups)),
            F.when(v.startswith("+"), 0).when(v.startswith("("), 1).when(v.startswith("0"), 2).when(v.rlike("^[1-9]"), 3).otherwise(4),
            F.when(last == "", 0).when(last == " ", 1).when(last == "\n", 2).when(last.rlike("[A-Za-z0-9]"), 3).when(last.rlike(r"[=:]"), 4).otherwise(5),
            F.when(before.rlike("(?i)(?:e-?mail|contact)[^A-Za-z]*$"), 1).when(before.rlike("(?i)(?:phone|tel|fax|call|mobile)[^A-Za-z]*$"), 2)
            .when(before.rlike("(?i)(?:card|visa|credit|account)[^A-Za-z]*$"), 3).when(before.rlike("(?i)(?:ip|host|server|address)[^A-Za-z]*$"), 4).when(before.rlike(r"[0-9]\S*\s*$"), 5).otherwise(0),
            F.when(v.contains(" "), 1).otherwise(0) + F.when(v.contains("-"), 2).otherwise(0) + F.when(v.contains("."), 4).otherwise(0) + F.when(v.rlike(r"[_,/@＠]"), 8).otherwise(0),
            F.when(after == "", 0).when(after == " ", 1).when(after.rlike(r"[.,;!?\n]"), 2).when(after.rlike("[A-Za-z0-9]"), 3).otherwise(4),
            check,
            small(F.coalesce(F.length(F.try_element_at(groups, F.lit(1))), F.lit(0))),
            small(F.coalesce(F.length(F.try_element_at(groups, F.lit(-1))), F.lit(0))),
            small(F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0))),
        ]
        return F.array(*[x.cast("int") for x in values])

    parts = F.struct(
        v.alias("v"), digits_of(v).alias("digits"), F.regexp_extract_all(v, F.lit("[A-Za-z0-9]+"), F.lit(0)).alias("groups"),
        around["before"].alias("before"), F.when(around["before"] == "", "").otherwise(F.substring(around["before"], -1, 1)).alias("last"), around["after"].alias("after"),
    )
    return bound(parts, numbers)


@dataclass(frozen=True)
class Tree:
    """Depth two: a split, then a split on each side; leaves are additions to the log-odds."""

    root: tuple[int, int]
    sides: tuple[tuple[int, int] | None, tuple[int, int] | None]
    leaves: tuple[float, float, float, float]

    def column(self, x: Column) -> Column:
        def side(split, low, high):
            return F.lit(low) if split is None else F.when(x[split[0]] <= split[1], low).otherwise(high)

        return F.when(x[self.root[0]] <= self.root[1], side(self.sides[0], *self.leaves[:2])).otherwise(side(self.sides[1], *self.leaves[2:]))


@dataclass(frozen=True)
class Detector:
    """Trees and threshold of each kind; a kind without a threshold adds no spans."""

    trees: dict[str, list[Tree]]
    start: dict[str, float]
    threshold: dict[str, float | None]

    def log_odds(self, kind: str, x: Column) -> Column:
        out = F.lit(self.start[kind])
        for t in self.trees[kind]:
            out = out + t.column(x)
        return out


def _split(cells: dict[int, dict[int, tuple[float, float]]], l2: float = 1.0, least: float = 5.0):
    """The best split of gradient and weight sums by (feature, value): (gain, feature, value), or None."""
    best = None
    for f, values in sorted(cells.items()):
        total_g, total_h = (sum(v[i] for v in values.values()) for i in (0, 1))
        g = h = 0.0
        for value in sorted(values)[:-1]:
            g, h = g + values[value][0], h + values[value][1]
            if min(h, total_h - h) < least * 0.01:
                continue
            gain = g * g / (h + l2) + (total_g - g) ** 2 / (total_h - h + l2) - total_g**2 / (total_h + l2)
            if gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                best = (gain, f, value)
    return best


def learn(histogram: DataFrame, rounds: int = ROUNDS, rate: float = LEARNING_RATE, precision: float = PRECISION) -> Detector:
    """Boosts on a histogram (kind, held, y, x array<int>, n) of proposals.

    A round is one aggregation: gradient and weight sums by kind, feature and value, and the same within each half
    of every first split, so the driver sees at most kinds * features * 32 * (1 + features * 32) rows of sums and
    in fact far fewer, because only the chosen split's halves are asked for.
    """
    total = {(r["kind"], r["y"]): r["n"] for r in histogram.where("NOT held").groupBy("kind", "y").agg(F.sum("n").alias("n")).collect()}
    kinds = [k for k in KINDS if (k, 1) in total]
    d = Detector({k: [] for k in kinds}, {k: math.log((total[k, 1] + 1) / (total.get((k, 0), 0) + 1)) for k in kinds}, dict.fromkeys(kinds))
    taught = histogram.where(~F.col("held") & F.col("kind").isin(kinds)) if kinds else None
    for _ in range(rounds if kinds else 0):
        roots = {k: _split(c) for (k, _), c in _sums(taught, d, {}).items()}
        halves = _sums(taught, d, {k: (s[1], s[2]) for k, s in roots.items() if s})
        for k, s in roots.items():
            if not s:
                continue
            sides, leaves = [], []
            for side in (0, 1):
                cells = halves.get((k, side), {})
                inner = _split(cells)
                sides.append(inner and inner[1:])
                values = next(iter(cells.values()), {})
                low = [v for x, v in (cells[inner[1]] if inner else values).items() if not inner or x <= inner[2]]
                high = [v for x, v in cells[inner[1]].items() if x > inner[2]] if inner else low
                leaves += [rate * sum(v[0] for v in part) / (sum(v[1] for v in part) + 1.0) for part in (low, high)]
            d.trees[k].append(Tree((s[1], s[2]), (sides[0], sides[1]), tuple(leaves)))
    for k in kinds:  # calibration on the documents that were held out
        p = 1 / (1 + F.exp(-d.log_odds(k, F.col("x"))))
        rows = histogram.where(F.col("held") & (F.col("kind") == k)).groupBy(F.floor(p * SCORE_BINS).cast("int").alias("bin")).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("y")).collect()
        n = y = 0
        for r in sorted(rows, key=lambda r: -r["bin"]):
            n, y = n + r["n"], y + r["y"]
            if y >= precision * (n + 1):
                d.threshold[k] = r["bin"]
    return d


def _sums(taught: DataFrame, d: Detector, splits: dict[str, tuple[int, int]]) -> dict[tuple[str, int], dict[int, dict[int, tuple[float, float]]]]:
    """Gradient (label minus probability) and weight sums by kind, side of the kind's split, feature and value."""
    x, score, side = F.col("x"), F.lit(0.0), F.lit(0)
    for k in d.trees:
        score = F.when(F.col("kind") == k, d.log_odds(k, x)).otherwise(score)
    for k, (f, value) in splits.items():
        side = F.when((F.col("kind") == k) & (x[f] > value), 1).otherwise(side)
    p = 1 / (1 + F.exp(-score))
    rows = (
        taught.select("kind", side.alias("side"), (F.col("n") * (F.col("y") - p)).alias("g"), (F.col("n") * p * (1 - p)).alias("h"), F.posexplode("x").alias("f", "value"))
        .groupBy("kind", "side", "f", "value").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
    )
    out: dict = {}
    for r in sorted(rows, key=lambda r: (r["kind"], r["side"], r["f"], r["value"])):
        out.setdefault((r["kind"], r["side"]), {}).setdefault(r["f"], {})[r["value"]] = (r["g"], r["h"])
    return out


def with_candidates(frame: DataFrame, text: str, base: str, wide: str) -> DataFrame:
    """Adds struct columns: the base spans of each kind, and the proposals of each kind, each with its features (x), those of its
    rewritten form (again), and whether it is a base span (y; null for a part of a match that failed the check)."""
    (whole,) = fresh(frame, "whole")
    step = frame.withColumn(whole, F.coalesce(F.col(text), F.lit("")))
    t = F.col(whole)
    b, w = fresh(step.select("*", *[F.lit(0).alias(c) for c in {base, wide}]), "found", "widest")
    step = step.withColumns({b: F.struct(*[c.alias(k) for k, c in base_matches(t).items()]), w: F.struct(*[c.alias(k) for k, c in proposals(t).items()])})
    any_proposal = sum((F.size(F.col(w)[k]) for k in KINDS), F.lit(0)) > 0
    step = step.withColumn(whole, F.when(any_proposal, _blocks(t)).otherwise(F.array().cast("array<string>")))

    def scored(k):
        def one(x: Column) -> Column:
            same = lambda z: (z["s"] == x["s"]) & (x["e"] == z["e"])
            is_base = F.exists(F.col(b)[k], lambda z: z["ok"] & same(z))
            unclear = F.exists(F.col(b)[k], lambda z: ~z["ok"] & (z["s"] < x["e"]) & (x["s"] < z["e"]) & ~same(z))
            around = F.struct(_cut(t, x["s"] - 24, x["s"]).alias("before"), _cut(t, x["e"], x["e"] + 1).alias("after"))
            return bound(around, lambda c: F.struct(x["s"].alias("s"), x["e"].alias("e"), features_of(k, c, x["v"]).alias("x"), features_of(k, c, rewritten(k, x["v"])).alias("again"), F.when(is_base, 1).when(~unclear, 0).alias("y")))

        return F.transform(F.col(w)[k], lambda x: one(x))

    bare = F.struct(*[F.transform(F.filter(F.col(b)[k], lambda x: x["ok"]), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias(k) for k in KINDS])
    return step.withColumns({base: bare, wide: F.struct(*[scored(k).alias(k) for k in KINDS])}).drop(b, w, whole)


#: Characters of the blocks that a text is cut into, so that a short part of it is found without reading all before.
BLOCK = 2048


def _blocks(text: Column) -> Column:
    """The text in blocks of ``BLOCK`` characters."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}+"), F.lit(0))


def _cut(blocks: Column, begin: Column, end: Column) -> Column:
    """The characters from ``begin`` to ``end`` (code points, less than a block apart), as far as they are there."""
    low = F.greatest(begin, F.lit(0))
    at = F.floor(low / BLOCK).cast("int")
    two = F.concat(F.coalesce(F.get(blocks, at), F.lit("")), F.coalesce(F.get(blocks, at + 1), F.lit("")))
    return F.substring(two, low - at * BLOCK + 1, end - low)


def histogram_of(candidates: DataFrame, wide: str, key: Column) -> DataFrame:
    """How often each (kind, held, y, x) occurs; every proposal counts as it is and rewritten."""
    both = [F.transform(F.col(wide)[k], _of(lambda r, which: F.struct(F.lit(which[0]).alias("kind"), r[which[1]].alias("x"), r["y"].alias("y")), (k, form))) for k in KINDS for form in ("x", "again")]
    rows = F.concat(*both)
    flat = candidates.where(F.size(rows) > 0).select((F.pmod(key, F.lit(3)) == 0).alias("held"), F.explode(rows).alias("r")).select("held", "r.kind", "r.x", "r.y").where("y IS NOT NULL")
    return flat.groupBy("kind", "held", "y", "x").agg(F.count("*").alias("n"))


def added_spans(d: Detector, wide: str, base: str) -> dict[str, Column]:
    """For each kind the proposals that pass its threshold, without those that touch a base span of any kind or a better proposal of any kind."""
    empty = F.array().cast("array<struct<p:double,s:int,e:int,k:int>>")
    passed = []
    for n, k in enumerate(KINDS):
        if d.threshold.get(k) is None:
            continue
        named = F.transform(F.filter(F.col(wide)[k], lambda x: F.coalesce(x["y"], F.lit(0)) == 0), _of(lambda x, kind: F.struct((-1 / (1 + F.exp(-d.log_odds(kind[1], x["x"])))).alias("p"), x["s"].alias("s"), x["e"].alias("e"), F.lit(kind[0]).alias("k")), (n, k)))
        good = F.filter(named, _of(lambda x, low: F.floor(-x["p"] * SCORE_BINS) >= low, d.threshold[k]))
        for other in KINDS:
            good = F.filter(good, _of(lambda x, other: ~F.exists(F.col(base)[other], lambda z: (z["s"] < x["e"]) & (x["s"] < z["e"])), other))
        passed.append(good)
    best = empty
    if passed:  # best first
        best = F.aggregate(F.array_sort(F.concat(*passed)), empty, lambda a, x: F.when(F.exists(a, lambda z: (z["s"] < x["e"]) & (x["s"] < z["e"])), a).otherwise(F.array_append(a, x)))
    return {k: F.transform(F.filter(best, _of(lambda x, n: x["k"] == n, n)), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))) for n, k in enumerate(KINDS)}


def with_spans(docs: DataFrame, base: str, spans: str, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, Detector]:
    """``docs`` with the base spans (struct of arrays by kind) and all spans, and the detector that was learned."""
    (wide,) = fresh(docs.select("*", F.lit(0).alias(base), F.lit(0).alias(spans)), "proposed")
    work = Workspace(docs.sparkSession, "pii")
    (row,) = fresh(docs, "row")
    held = work.save(with_candidates(docs, text, base, wide), "candidates")
    histogram = work.save(histogram_of(held, wide, F.xxhash64(F.col(key))), "histogram")
    d = learn(histogram)
    more = added_spans(d, wide, base)
    both = F.struct(*[F.array_sort(F.concat(F.col(base)[k], more[k])).alias(k) for k in KINDS])
    return held.withColumn(spans, both).drop(wide, row), d


def listing(spans: str) -> Column:
    """kind:begin:end by kind, then begin, comma-joined."""
    return F.array_join(F.concat(*[F.transform(F.col(spans)[k], _of(lambda x, k: F.concat(F.lit(f"{k}:"), x["s"].cast("string"), F.lit(":"), x["e"].cast("string")), k)) for k in KINDS]), ",")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans for every row of ``docs``; then n_spans (all spans), n_secrets,
    and n_found (both)."""
    text_free, _ = _slim(docs)
    every = sum((F.size(F.col("all")[k]) for k in KINDS), F.lit(0)).cast("long")
    return text_free.select(
        "doc_id", *[F.size(F.col("base")[k]).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(listing("base").cast("binary"), 256).alias("base_sha256"), listing("all").alias("spans"),
        every.alias("n_spans"), "n_secrets", (every + F.col("n_secrets")).alias("n_found"),
    )


def _slim(docs: DataFrame) -> tuple[DataFrame, Detector]:
    """Like :func:`with_spans`, but only doc_id and the spans are written."""
    work = Workspace(docs.sparkSession, "pii")
    secrets = F.coalesce(F.regexp_count("text", F.lit(SECRET)), F.lit(0)).cast("long")
    held = work.save(with_candidates(docs.select("doc_id", "text", secrets.alias("n_secrets")), "text", "base", "wide").drop("text"), "candidates")
    d = learn(work.save(histogram_of(held, "wide", F.xxhash64("doc_id")), "histogram"))
    more = added_spans(d, "wide", "base")
    both = F.struct(*[F.array_sort(F.concat(F.col("base")[k], more[k])).alias(k) for k in KINDS])
    return held.withColumn("all", both), d


def redact(docs: DataFrame, mask: str = "[{}]") -> DataFrame:
    """``docs`` with every span of its text replaced by the name of its kind; overlapping spans become one."""
    base, spans, cuts = fresh(docs, "base", "spans", "cuts")
    found, _ = with_spans(docs, base, spans)
    named = F.array_sort(F.concat(*[F.transform(F.col(spans)[k], _of(lambda x, k: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(mask.format(k)).alias("m")), k)) for k in KINDS]))
    step = found.withColumn(cuts, named)
    text = F.coalesce(F.col("text"), F.lit(""))
    done = F.aggregate(
        F.col(cuts), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, x: F.struct(
            F.greatest(a["at"], x["e"]).alias("at"),
            F.when(x["s"] >= a["at"], F.concat(a["out"], F.substring(text, a["at"] + 1, x["s"] - a["at"]), x["m"])).otherwise(a["out"]).alias("out"),
        ),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    return step.withColumn("text", F.when(F.size(cuts) > 0, done).otherwise(F.col("text"))).select(*docs.columns)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
