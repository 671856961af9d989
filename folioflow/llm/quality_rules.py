"""Quality rules: a decision list learned by sequential covering, applied as a conditional expression.

Only DataFrame and SQL functions: text statistics are built-in string and array functions, learning
reads aggregated counts of binned statistics, and the learned list is one ordered ``CASE``.

Defined results
* null text: no words; every count is 0 and the row fails the base rule.
* empty table: no rules are learned and no rows come out.
* repeated rows: each row is judged for itself and stays repeated.
* labels: a doc_id labelled more than once counts as low quality if any label says so; null labels are
  ignored.  Without labels of both kinds no rule is learned and only the base rule rejects.
* ties between conditions go to the first feature in ``FEATURES``, then the lower bound.
* other columns of the input are never read and, in :func:`quality_filter`, come back unchanged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import SPACE_CLASS, Workspace, fresh, table

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Statistics that the learner sees, all derived from one document's text.
FEATURES = (
    "symbol_ratio", "bang_ratio", "upper_ratio", "digit_ratio", "mean_word", "dup_line_ratio",
    "repeat_ratio", "distinct_ratio", "words_per_line", "log_words",
)


def with_text_stats(frame: DataFrame, text: str, out: str) -> DataFrame:
    """Adds a struct column ``out`` of text statistics.

    Repeated windows are found inside the row: word hashes, then hashes of eight of them, then one sort of
    the hashes of the texts that have any repetition (64-bit XXH64, so two different windows of one text
    are taken for equal with a chance below n*n/2**65).  No word leaves its row, so nothing is shuffled.
    """
    words, lines, hashes, wins, spots = fresh(frame, "_words", "_lines", "_hashes", "_wins", "_spots")
    whole = F.coalesce(F.col(text), F.lit(""))
    step = frame.withColumns(
        {
            words: F.array_remove(F.split(whole, SPACE_CLASS), ""),
            lines: F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    step = step.withColumn(hashes, F.transform(F.col(words), lambda w: F.xxhash64(w)))
    # the array itself is the lambda's argument, and read again inside: so it is computed once, in its own projection
    step = step.withColumn(
        wins,
        F.expr(
            f"CASE WHEN size(`{hashes}`) > {WINDOW} THEN transform(slice(`{hashes}`, 1, size(`{hashes}`) - {WINDOW - 1}),"
            f" (h, i) -> xxhash64(slice(`{hashes}`, i + 1, {WINDOW}))) ELSE array() END"
        ),
    )
    step = step.withColumn(
        spots,
        F.expr(
            f"CASE WHEN size(array_distinct(`{wins}`)) < size(`{wins}`) THEN"
            f" sort_array(transform(`{wins}`, (h, i) -> named_struct('h', h, 'i', i))) END"
        ),
    )
    # positions of windows found twice or more; each adds the words that the one before did not cover
    repeated = F.expr(
        f"CASE WHEN `{spots}` IS NULL THEN 0L ELSE aggregate(sort_array(transform(filter(`{spots}`, (x, i) ->"
        f" (i > 0 AND get(`{spots}`, i - 1).h = x.h) OR coalesce(get(`{spots}`, i + 1).h = x.h, false)), x -> x.i)),"
        f" named_struct('n', 0L, 'last', -{WINDOW}), (a, p) -> named_struct('n', a.n + least({WINDOW}, p - a.last), 'last', p), a -> a.n) END"
    )
    n_words = F.size(words).cast("long")
    counts = F.struct(
        n_words.alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(whole, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.array_distinct(words)).cast("long").alias("n_distinct"),
        F.regexp_count(whole, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(whole, F.lit(r"[!?]")).cast("long").alias("n_bang"),
        F.regexp_count(whole, F.lit(r"[0-9]")).cast("long").alias("n_digit"),
    )
    return step.withColumn(out, counts).drop(words, lines, hashes, wins, spots)


def base_failed(stats: str) -> Column:
    s = F.col(stats)
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def feature_columns(stats: str) -> dict[str, Column]:
    s = F.col(stats)
    share = lambda a, b: s[a] / F.greatest(s[b], F.lit(1))
    return {
        "symbol_ratio": share("n_symbols", "word_chars"),
        "bang_ratio": share("n_bang", "word_chars"),
        "upper_ratio": share("n_upper", "word_chars"),
        "digit_ratio": share("n_digit", "word_chars"),
        "mean_word": share("word_chars", "n_words"),
        "dup_line_ratio": share("n_dup_lines", "n_lines"),
        "repeat_ratio": share("n_repeat_words", "n_words"),
        "distinct_ratio": share("n_distinct", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
        "log_words": F.log1p(s["n_words"]),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    bound: float

    def column(self, features: dict[str, Column]) -> Column:
        return features[self.feature] > F.lit(self.bound) if self.above else features[self.feature] <= F.lit(self.bound)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.bound:.6g}"


@dataclass
class DecisionList:
    """Ordered rules; a row that satisfies one is rejected, the first that holds names the reason."""

    rules: list[list[Condition]] = field(default_factory=list)

    def reason(self, features: dict[str, Column]) -> Column:
        """The 1-based number of the first rule that holds, or null."""
        out = F.lit(None).cast("int")
        for k, rule in reversed(list(enumerate(self.rules, 1))):
            out = F.when(_all(c.column(features) for c in rule), F.lit(k)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, rule))}" for rule in self.rules)


def _all(columns) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & c
    return out


def learn_decision_list(
    labelled: DataFrame, features: tuple[str, ...] = FEATURES, label: str = "bad", bins: int = 32, max_rules: int = 8,
    max_conditions: int = 3, min_precision: float = 0.9, min_cover: float = 0.01, split_key: str = "split",
) -> DecisionList:
    """Sequential covering over the rows of ``labelled`` (features as doubles, ``label`` 1 = to reject).

    Every count comes from all labelled rows by an aggregation; the driver sees at most
    ``len(features) * (bins + 1)`` rows of counts at a time.  Rows are split by the hash in ``split_key``:
    two thirds grow a rule by FOIL gain, one third prunes it from the end.  A rule that rejects with less
    than ``min_precision`` on the pruning rows, or covers under ``min_cover`` of what is left to
    reject there, ends the list.
    """
    cuts = labelled.groupBy(label).agg(F.array(*[F.percentile_approx(f, [k / bins for k in range(1, bins)], 2000) for f in features]).alias("q")).collect()
    if len(cuts) < 2:
        return DecisionList()
    edges = [sorted({v for row in cuts for v in (row["q"][k] or [])}) for k in range(len(features))]
    edges = [[x for x in e if x is not None] for e in edges]
    # the bin of a value: how many edges lie below it, so "value <= edge[j]" is "bin <= j"
    binned = labelled.select(
        F.col(label).cast("int").alias("y"),
        (F.pmod(F.col(split_key), F.lit(3)) == 0).alias("held"),
        F.array(*[_bin(f, e) for f, e in zip(features, edges, strict=True)]).alias("b"),
    ).groupBy("y", "held", "b").agg(F.count("*").alias("n"))
    spark = labelled.sparkSession
    work = Workspace(spark, "quality-rules")
    binned = work.save(binned, "binned")
    holds = lambda c: F.col("b")[features.index(c[0])] > c[1] if c[2] else F.col("b")[features.index(c[0])] <= c[1]
    found: list[list[tuple[str, int, bool]]] = []
    left = binned
    while len(found) < max_rules:
        rule: list[tuple[str, int, bool]] = []
        while len(rule) < max_conditions:
            rows = (
                left.where(~F.col("held")).where(_all(holds(c) for c in rule)).select("y", "n", F.posexplode("b").alias("f", "bin"))
                .groupBy("f", "bin").agg(F.sum(F.col("n") * F.col("y")).alias("p"), F.sum(F.col("n") * (1 - F.col("y"))).alias("m")).collect()
            )
            best = _best_condition(rows, features, edges)
            if best is None:
                break
            rule.append(best[1])
            if best[2]:
                break
        if not rule:
            break
        prefix = [_all(holds(c) for c in rule[: k + 1]) for k in range(len(rule))]
        aims = [F.sum(F.when(w, F.col("n") * F.col("y")).otherwise(0)).alias(f"p{k}") for k, w in enumerate(prefix)] + [F.sum(F.when(w, F.col("n") * (1 - F.col("y"))).otherwise(0)).alias(f"m{k}") for k, w in enumerate(prefix)]
        got = left.where("held").agg(F.sum(F.col("n") * F.col("y")).alias("all"), *aims).first()
        if not got["all"]:
            break
        keep = max(range(len(rule)), key=lambda k: ((got[f"p{k}"] - got[f"m{k}"]) / max(1, got[f"p{k}"] + got[f"m{k}"]), -k))
        p, m = got[f"p{keep}"], got[f"m{keep}"]
        if p < max(1, min_cover * got["all"]) or p < min_precision * (p + m):
            break
        rule = rule[: keep + 1]
        found.append(rule)
        left = left.where(~_all(holds(c) for c in rule))
    work.drop()
    return DecisionList([[Condition(f, above, float(edges[features.index(f)][j])) for f, j, above in rule] for rule in found])


def _bin(feature: str, edges: list[float]) -> Column:
    array = F.array(*[F.lit(float(x)) for x in edges]) if edges else F.array().cast("array<double>")
    return F.size(F.filter(array, lambda x: F.col(feature) > x))


def _best_condition(rows, features, edges):
    """The condition of the highest FOIL gain, and whether the rows that it leaves are all to be rejected."""
    counts: dict[int, dict[int, tuple[int, int]]] = {}
    for r in rows:
        counts.setdefault(r["f"], {})[r["bin"]] = (r["p"], r["m"])
    if not counts:
        return None
    total_p = sum(p for p, _ in counts[0].values())
    total_m = sum(m for _, m in counts[0].values())
    if not total_p or not total_m:
        return None
    before = math.log2(total_p / (total_p + total_m))
    best = None
    for f in range(len(features)):
        low_p = low_m = 0
        for j in range(len(edges[f])):
            p, m = counts[f].get(j, (0, 0))
            low_p, low_m = low_p + p, low_m + m
            for above, a, b in ((False, low_p, low_m), (True, total_p - low_p, total_m - low_m)):
                if not a or a + b == total_p + total_m:
                    continue
                gain = a * (math.log2(a / (a + b)) - before)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, (features[f], j, above), b == 0)
    return best


def _labels(labels: DataFrame) -> DataFrame:
    return labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.min("quality") < 1).cast("int").alias("bad"))


def learn_from(stats: DataFrame, doc_id: str, stats_column: str, labels: DataFrame, **how) -> DecisionList:
    """Learns from the labelled rows of ``stats`` that pass the base rule."""
    named = feature_columns(stats_column)
    rows = stats.where(~base_failed(stats_column)).select(F.col(doc_id).alias("doc_id"), *[c.alias(f) for f, c in named.items()])
    rows = rows.join(_labels(labels), "doc_id").withColumn("split", F.xxhash64("doc_id"))
    return learn_decision_list(rows, **how)


def quality_verdicts(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, rule (number of the rejecting rule) for each row of ``docs``."""
    work = Workspace(docs.sparkSession, "quality")
    stats = work.save(with_text_stats(docs.select("doc_id", "text"), "text", "s").select("doc_id", "s"), "stats")
    rules = learn_from(stats, "doc_id", "s", labels, **how)
    s = F.col("s")
    reason = rules.reason(feature_columns("s"))
    return stats.select(
        "doc_id", *[s[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed("s").alias("base_failed"), (~base_failed("s") & reason.isNull()).alias("kept"), reason.alias("rule"),
    )


def quality_filter(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that the base rule and the learned list keep, with the columns of ``docs``.

    The list is learned from a slim table of statistics; filtering computes them again, which costs a second pass over
    the texts and saves a written copy of them.
    """
    stats, kept = fresh(docs, "stats", "kept")
    work = Workspace(docs.sparkSession, "quality")
    slim = work.save(with_text_stats(docs.select("doc_id", "text"), "text", "s").select("doc_id", "s"), "stats")
    rules = learn_from(slim, "doc_id", "s", labels, **how)
    keep = ~base_failed(stats) & rules.reason(feature_columns(stats)).isNull()
    # the row number keeps the filter above the statistics: pushed below, each use would compute them anew
    verdict = keep & (F.monotonically_increasing_id() >= 0)
    return with_text_stats(docs, "text", stats).withColumn(kept, verdict).where(kept).select(*docs.columns)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
