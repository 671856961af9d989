"""Mixing sources to target weights by entropy balancing.

Rates r minimise the entropy distance of the mix from the corpus, sum of q*(r*log r - r + 1) over documents with
base mass q = size / (size/mean)**tilt, subject to sum(size*r) = target for every source and r <= cap.  The dual is
convex with one multiplier for each source, and its solution is the exponential tilt
r = min(cap, exp(lambda * (size/mean)**tilt)).  All sources take safeguarded Newton steps together: a step is one
grouped aggregation over the (source, size) histogram, no row of which leaves the cluster.

Rates become whole copies without drift: every document first gets floor(r) copies; what the source still lacks
is filled by one more copy for the documents of the lowest priority (a seeded hash of the document, divided by
the fraction of its rate), up to the point where the next one would pass the target; what then lacks is met by one
more copy of the one document whose size comes nearest.  The point is found by prefix sums over priority buckets and then inside the
one bucket that holds it, so no source is ever sorted as a whole.

Repeated rows (equal id, text and source) are one unit of ``n`` rows: their rates add up, whole copies of the sum are dealt evenly
(some rows get one more than the others), and only what is left of the sum takes part in the priorities.

Defined results: null text has size 0; documents of size 0 take part with taken 0 and get one copy in
:func:`mixed_corpus`; a null source is a source of its own, after all others; of repeated rows the numbers of copies differ by
one at most; an empty table gives an empty result; sources without words have target 0; other columns are only carried along.
Multipliers that do not settle within ``STEPS`` steps are an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import SPACE_CLASS, Workspace, fresh, table

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
TILT = 0.5
SEED = 17
STEPS = 60
BUCKETS = 4096
#: Repeated rows that are dealt together; more are cut into so large runs.
RUN = 10_000


def word_count(text: Column) -> Column:
    """Number of runs of characters that are not white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """source, source_size, target: the words of all sources shared by weight, none above ``cap`` times its size.  ``sizes`` has
    source, size and the number n of rows of that size.

    One row for each source; the excess over a ceiling is shared again by weight among the others until none is above.
    The final water level is computed directly: with sources in order of ceiling/weight, the first k are full for the
    smallest k at which the level left for the others is below the next one's ceiling.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    # code-point order is byte order of UTF-8, which is how Spark sorts strings
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1)
    per = per.withColumn("weight", w).withColumns({"ceiling": cap * F.col("source_size"), "all": F.sum("source_size").over(Window.partitionBy())})
    ranked = Window.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = ranked.rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumns(
        {
            "full": F.coalesce(F.sum("ceiling").over(upto), F.lit(0.0)),
            "open": F.sum("weight").over(Window.partitionBy()) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)),
        }
    ).withColumn("level", (F.col("all") - F.col("full")) / F.col("open"))
    # the level of the first source that is not full holds for all after it
    per = per.withColumn("fits", F.col("level") * F.col("weight") <= F.col("ceiling"))
    level = F.min(F.when(F.col("fits"), F.struct((F.col("ceiling") / F.col("weight")).alias("at"), F.col("level").alias("level"))) ).over(Window.partitionBy())["level"]
    return per.select("source", "source_size", F.least(F.col("ceiling"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight")).alias("target"))


def solve_rates(sizes: DataFrame, aims: DataFrame, work: Workspace, cap: float = CAP, tilt: float = TILT, steps: int = STEPS) -> DataFrame:
    """source, source_size, target, mean, lam: the multiplier of each source (null: every document at the cap)."""
    histogram = work.save(
        sizes.where("size > 0").groupBy("source", "size").agg(F.sum("n").alias("n")), "histogram"
    )
    mean = histogram.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = aims.join(mean, aims["source"].eqNullSafe(mean["source"]), "left").select(aims["*"], F.coalesce("mean", F.lit(1.0)).alias("mean"))
    state = work.save(state.withColumns({"lam": F.lit(0.0), "low": F.lit(float("-inf")), "high": F.lit(float("inf")), "done": (F.col("target") <= 0) | (F.col("target") >= cap * F.col("source_size") * (1 - 1e-12))}).coalesce(1), "state0")
    for k in range(1, steps + 1):
        if not state.where("NOT done").limit(1).count():
            break
        h, s = histogram.alias("h"), _side(state.where("NOT done")).alias("s")
        x = F.pow(F.col("h.size") / F.col("s.mean"), F.lit(tilt))
        rate = F.least(F.lit(cap), F.exp(F.col("s.lam") * x))
        free = F.col("s.lam") * x < F.log(F.lit(cap))
        words = F.col("h.size") * F.col("h.n") * rate
        sums = h.join(s, F.col("h.source").eqNullSafe(F.col("s.source"))).groupBy(F.col("h.source").alias("of")).agg(F.sum(words).alias("words"), F.sum(F.when(free, words * x).otherwise(0.0)).alias("slope"))
        step = state.join(sums, state["source"].eqNullSafe(sums["of"]), "left")
        miss = F.col("words") - F.col("target")
        step = step.withColumns(
            {
                "low": F.when(~F.col("done") & (miss < 0), F.col("lam")).otherwise(F.col("low")),
                "high": F.when(~F.col("done") & (miss > 0), F.col("lam")).otherwise(F.col("high")),
                "end": F.col("done") | (F.abs(miss) <= 1e-9 * F.col("target") + 1e-6),
            }
        )
        newton = F.col("lam") - miss / F.col("slope")
        inside = F.col("slope").isNotNull() & (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        halved = F.when(F.col("low") == float("-inf"), F.col("high") - 1 - F.abs("high")).when(F.col("high") == float("inf"), F.col("low") + 1 + F.abs("low")).otherwise((F.col("low") + F.col("high")) / 2)
        step = step.withColumn("lam", F.when(F.col("end"), F.col("lam")).when(inside, newton).otherwise(halved)).withColumn("done", F.col("end"))
        state = work.save(step.select(*state.columns).coalesce(1), f"state{k}")
        work.drop(f"state{k - 1}")
    else:
        if state.where("NOT done").limit(1).count():
            raise ValueError(f"multipliers did not settle in {steps} steps")
    return state.select("source", "source_size", "target", "mean", F.when(F.col("target") < cap * F.col("source_size") * (1 - 1e-12), F.col("lam")).alias("lam"))


def _few(state: DataFrame, limit: int = 50_000) -> bool:
    """Whether the sources are few enough to broadcast (at most ``limit`` rows of about 60 bytes)."""
    return state.limit(limit + 1).count() <= limit


def copies(sizes: DataFrame, work: Workspace, weights=WEIGHTS, cap: float = CAP, tilt: float = TILT) -> DataFrame:
    """``sizes`` (doc_id, key, source, size, n rows, and others) with source_size, target, rate of each row, and copies of all n rows."""
    solved = work.save(solve_rates(sizes, targets(sizes, weights, cap), work, cap, tilt).coalesce(1), "solved")
    d = sizes.withColumn("u", (F.pmod(F.col("key"), F.lit(1 << 40)) + 1) / F.lit(float(1 << 40))).alias("d")
    s = _side(solved).alias("s")
    tilted = F.least(F.lit(cap), F.exp(F.col("s.lam") * F.pow(F.col("d.size") / F.col("s.mean"), F.lit(tilt))))
    rate = F.when(F.col("d.size") == 0, F.lit(1.0)).when(F.col("s.target") <= 0, F.lit(0.0)).when(F.col("s.lam").isNull(), F.lit(cap)).otherwise(tilted)
    rated = d.join(s, F.col("d.source").eqNullSafe(F.col("s.source"))).select("d.*", F.col("s.source_size"), F.col("s.target"), rate.alias("rate"))
    # priority in [0, 1): u/(u+fraction) keeps the order of u/fraction; null: no further copy
    share = F.col("n") * (F.col("rate") - F.floor("rate"))
    fraction = share - F.floor(share)
    rated = rated.withColumns({"base": F.col("n") * F.floor("rate").cast("long") + F.floor(share).cast("long"), "priority": F.when((F.col("size") > 0) & (fraction > 0), F.col("u") / (F.col("u") + fraction))})
    rated = work.save(rated.withColumn("bucket", F.least(F.floor(F.col("priority") * BUCKETS), F.lit(BUCKETS - 1)).cast("int")), "rated")
    sums = rated.groupBy("source", "bucket").agg(F.sum(F.col("base") * F.col("size")).alias("held"), F.sum(F.when(F.col("bucket").isNotNull(), F.col("size")).otherwise(0)).alias("more"), F.max("target").alias("target"))
    whole = Window.partitionBy("source")
    order = whole.orderBy(F.col("bucket").asc_nulls_first())
    sums = sums.withColumns({"lack": F.col("target") - F.sum("held").over(whole), "before": F.sum("more").over(order) - F.col("more")}).where("bucket IS NOT NULL")
    # a bucket is taken as a whole, not at all, or is the one in which the words run out
    plan = work.save(sums.select(F.col("source").alias("of"), F.col("bucket").alias("at"), (F.col("before") + F.col("more") <= F.col("lack")).alias("all"), (F.col("lack") - F.col("before")).alias("room")).where("all OR room > 0"), "plan")
    last = _side(plan.groupBy("of").agg(F.max(F.when(F.col("all"), F.col("at"))).alias("last"), F.max(F.when(~F.col("all"), F.struct("at", "room"))).alias("edge")))
    out = rated.join(last, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    at_edge = F.coalesce(F.col("bucket") == F.col("edge.at"), F.lit(False))
    inner = Window.partitionBy("source").orderBy("priority", "key", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = out.where(at_edge).withColumn("extra", (F.sum("size").over(inner) <= F.col("edge.room")).cast("long"))
    rest = out.where(~at_edge).withColumn("extra", F.coalesce(F.col("bucket") <= F.col("last"), F.lit(False)).cast("long"))
    out = work.save(rest.unionByName(edge).drop("last", "edge"), "picked")
    # what is still lacking is less than the next document's size: one more copy of the document whose size comes nearest
    lack = _side(out.groupBy("source").agg((F.max("target") - F.sum((F.col("base") + F.col("extra")) * F.col("size"))).alias("lack")).select(F.col("source").alias("of"), "lack"))
    miss = F.abs(F.col("size") - F.col("lack"))
    fits = out.where(F.col("base") + F.col("extra") + 1 <= cap * F.col("n")).join(lack, F.col("source").eqNullSafe(F.col("of"))).where((F.col("size") > 0) & (miss < F.col("lack")))
    top = fits.groupBy("source").agg(F.min(F.struct(miss.alias("miss"), "key", "doc_id")).alias("top"))
    top = _side(top.select(F.col("source").alias("of"), F.col("top.key").alias("top_key"), F.col("top.doc_id").alias("top_doc"), F.lit(1).alias("one_more")))
    out = out.join(top, F.col("source").eqNullSafe(F.col("of")) & (F.col("key") == F.col("top_key")) & F.col("doc_id").eqNullSafe(F.col("top_doc")), "left")
    return out.withColumn("copies", F.col("base") + F.col("extra") + F.coalesce("one_more", F.lit(0))).drop("u", "base", "priority", "bucket", "extra", "of", "top_key", "top_doc", "one_more")


def _side(frame: DataFrame) -> DataFrame:
    """A table of a row for each source, marked for broadcast if it is small enough, else joined by shuffle."""
    return F.broadcast(frame) if _few(frame) else frame


def _keyed(seed: int) -> Column:
    """A hash of the document: two rows share it only if their id and text are equal."""
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def _units(docs: DataFrame, seed: int) -> DataFrame:
    """One row for each document; repeated rows (equal id, text and source) are one unit of ``n`` rows."""
    rows = docs.select("doc_id", "source", _keyed(seed).alias("key"), word_count(F.col("text")).alias("size"))
    return rows.groupBy("doc_id", "source", "key", "size").agg(F.count("*").alias("n"))


def _counted(docs: DataFrame, seed: int, work: Workspace, how: dict) -> DataFrame:
    """Units with what each of their rows gets: ``each`` copies, and one more for ``rest`` of the rows."""
    out = copies(work.save(_units(docs, seed), "sizes"), work, **how)
    return out.withColumns({"each": F.floor(F.col("copies") / F.col("n")).cast("long"), "rest": F.pmod("copies", "n")})


def mix(docs: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """doc_id, size, source_size, target, taken, rate, copies for every row of ``docs``."""
    out = _counted(docs, seed, Workspace(docs.sparkSession, "mix"), how)
    small = out.where(F.col("n") <= RUN).withColumn("first", F.lit(1).cast("long"))
    large = out.where(F.col("n") > RUN).withColumn("first", F.explode(F.sequence(F.lit(1).cast("long"), "n", F.lit(RUN).cast("long")))).repartition("key", "first")
    rows = small.unionByName(large).withColumn("i", F.explode(F.sequence("first", F.least(F.col("n"), F.col("first") + RUN - 1))))
    rows = rows.withColumn("copies", F.col("each") + (F.col("i") <= F.col("rest")).cast("long"))
    return rows.select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"), (F.col("copies") * F.col("size")).alias("taken"), "rate", "copies")


def mixed_corpus(docs: DataFrame, seed: int = SEED, **how) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with the columns of ``docs``.

    Rows meet their numbers of copies by id, text hash and source, so no copy of the texts is written on the way.  Only repeated rows
    that are not all taken equally often are numbered, in runs of about ``RUN``; a run deals its share of the copies that are left over
    evenly, rounded down."""
    key, n, each, rest, unit = fresh(docs, "key", "rows", "each", "rest", "unit")
    work = Workspace(docs.sparkSession, "mix")
    counted = work.save(_counted(docs, seed, work, how).where("copies > 0").select("doc_id", "source", "key", "n", "each", "rest"), "copies")
    c = counted.alias("c")
    d = docs.withColumn(key, _keyed(seed)).alias("d")
    same = (F.col(f"d.{key}") == F.col("c.key")) & F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & F.col("d.source").eqNullSafe(F.col("c.source"))
    joined = d.join(c, same).select("d.*", F.col("c.n").alias(n), F.col("c.each").alias(each), F.col("c.rest").alias(rest))
    uneven = (F.col(n) > 1) & (F.col(rest) > 0)
    if counted.where("n > 1 AND rest > 0").limit(1).count():
        run = F.pmod(F.monotonically_increasing_id(), F.ceil(F.col(n) / RUN))
        place = F.row_number().over(Window.partitionBy(key, "doc_id", "source", unit).orderBy(F.lit(0))).cast("long")
        dealt = joined.where(uneven).withColumn(unit, run).withColumn(unit, place)
        more = F.floor(F.col(unit) * F.col(rest) / F.col(n)) - F.floor((F.col(unit) - 1) * F.col(rest) / F.col(n))
        joined = joined.where(~uneven).unionByName(dealt.withColumn(each, F.col(each) + more).drop(unit))
    else:
        joined = joined.withColumn(each, F.col(each) + F.col(rest))  # of one row all that is left, of others nothing
    return joined.withColumn(each, F.explode(F.array_repeat(F.lit(0), F.col(each).cast("int")))).select(*docs.columns)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
