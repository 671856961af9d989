"""Each contract query against a plain Python version, over the smallest tables and over odd rows."""

import collections
import hashlib
import itertools
import math
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from folioflow.llm import decontamination, language_id, lm_scoring, mixing, near_dedup, pii, quality_rules, sharding, simhash, token_ids

SF = "/root/testdata/sf0.001"
SPACE = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def pairs(rows, *columns):
    return sorted(((r["doc_id"], *[r[c] for c in columns]) for r in rows), key=repr)


def base_counts(text):
    w = SPACE.findall(text or "")
    seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def test_quality_counts(spark, sample, odd, labels):
    for docs in (sample, odd):
        got = quality_rules.quality_verdicts(docs, labels).collect()
        want = []
        for r in docs.collect():
            c = base_counts(r["text"])
            want.append((r["doc_id"], *c, c[0] < 20 or 100 * c[4] > 30 * c[0]))
        assert pairs(got, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(want, key=repr)
        assert not any(r["kept"] and r["base_failed"] for r in got)


def test_quality_rules_learn(spark):
    got = {r["doc_id"]: r["kept"] for r in quality_rules.op1_quality_rules(spark, "/root/testdata/sf0.01").collect()}
    labelled = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    bad, good = ([got[r["doc_id"]] for r in labelled if r["quality"] == q] for q in (0, 1))
    assert sum(bad) <= 0.1 * len(bad) and sum(good) >= 0.95 * len(good)


def contaminated(text, items, window=10):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    wins = collections.defaultdict(set)
    for item, t in items:
        w = word.findall(lower(t))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins[tuple(w[i : i + window])].add("" if item is None else str(item))
    w, hit, found = word.findall(lower(text)), set(), set()
    for size in {len(k) for k in wins}:
        for i in range(len(w) - size + 1):
            if (k := tuple(w[i : i + size])) in wins:
                hit.update(range(i, i + size))
                found |= wins[k]
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontamination(spark, sample, odd, benchmark, block_bytes):
    bench = benchmark.unionByName(spark.read.parquet(f"{SF}/benchmark.parquet")) if block_bytes > 60 else benchmark
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    for docs in (sample, odd) if block_bytes > 60 else (odd,):
        got = decontamination.contamination(docs, bench, block_bytes=block_bytes).collect()
        assert pairs(got, "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == sorted(((r["doc_id"], *contaminated(r["text"], items)) for r in docs.collect()), key=repr)
    assert any(r["contaminated"] for r in got)


def test_partial_containment(spark):
    docs = spark.createDataFrame([(1, "x y a b c d e f g h i j z"), (2, "x y a b c d e f g h Q j z"), (3, "a b c Q d e f Q g h")], "doc_id int, text string")
    bench = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id int, text string")
    hit = lambda t: {r["doc_id"] for r in decontamination.contamination(docs, bench, containment=t).where("contaminated").collect()}
    assert hit(1.0) == {1} and hit(0.7) == {1, 2}


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, v):
    g = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(p) <= 255 for p in v.split("."))
    if kind == "card":
        return 16 <= len(g) <= 19 and sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(g[::-1])) % 10 == 0
    return kind == "email" or 8 <= len(g) <= 15


def spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k in BASE for m in re.finditer(BASE[k], text or "") if valid(k, m.group())]


def test_pii_base(spark, sample, odd):
    extra = spark.createDataFrame(
        [(100 + k, t) for k, t in enumerate(["a@b.c_d@e.fg", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.0.0.1 1.2.3", "4111-1111-1111-1111 4111111111111112 " + "1 " * 3000, "a" * 50_000 + "@", "+1+49 (30) 1234567.", "é😀 x@y.z.w", ".a" * 5000 + "@b" + ".c" * 5000, "9" * 60_000])],
        "doc_id long, text string",
    )
    for docs in (sample.select("doc_id", "text"), odd.select("doc_id", "text"), extra):
        got = pii.find(docs).collect()
        want = []
        for r in docs.collect():
            s = spans(r["text"])
            want.append((r["doc_id"], *[sum(x.startswith(k) for x in s) for k in BASE], hashlib.sha256(",".join(s).encode()).hexdigest()))
        assert pairs(got, "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == sorted(want, key=repr)
        text = collections.defaultdict(list)
        for r in docs.collect():
            text[r["doc_id"]].append(r["text"])
        for r in got:
            assert any(set(spans(t)) <= set(r["spans"].split(",") if r["spans"] else []) for t in text[r["doc_id"]])


def stretches(text, low, high):
    """All parts of the runs of numbers of a text, from the begin of a digit group to the end of another, with their marks."""
    out = []
    for run in re.finditer(r"[+(]{0,2}[0-9](?:[\x20()./-]{0,3}[0-9])+", text):
        groups = [(m.start(), m.end()) for m in re.finditer("[0-9]+", run[0])]
        for i, (s, _) in enumerate(groups):
            s -= len(re.search(r"\+?\(?$", run[0][max(0, s - 2) : s])[0])
            out += [(run.start() + s, run.start() + e, run[0][s:e]) for _, e in groups[i:] if low <= len(re.sub("[^0-9]", "", run[0][s:e])) <= high]
    return sorted(out)


def test_pii_stretches_equal_plain_python(spark):
    texts = ["12 34 (56) 78-90 +1 (826) 555-4081 190.137.223.204", "+49 30 1234567 x 0123456789012345678901 12 3456789", "(555) 555-1234/555-9999", "1" * 50 + " 1234567", "ü +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8", "12", ""]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", pii.proposals(F.col("t"))["phone"].alias("p")).collect()
    for r in got:
        assert sorted((x["s"], x["e"], x["v"]) for x in r["p"]) == stretches(r["t"], *pii.STRETCH["phone"]), r["t"]


def test_pii_very_long_runs_of_numbers(spark):
    """Time grows with the run's length: a way that is quadratic takes some ten minutes for the first text."""
    texts = ["12 " * 30_000, "7" * 300_000, "+1 (555) 555-1234 " * 2_000]
    began = time.time()
    got = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(got) == 3 and time.time() - began < 120


def test_pii_learns_and_adds(spark):
    """Numbers that the base patterns read together with their neighbours, and forms that they never accept, are added; clean numbers are not."""
    from pyspark.sql import functions as F

    card = lambda k: (lambda d: d + str(next(c for c in range(10) if valid("card", d + str(c)))))(str(400000000000000 + 977 * k))
    rows = [(k, f"write to user{k}@mail{k % 9}.example.com today or tel +1 (55{k % 10}) 555-{1000 + k} now") for k in range(300)]
    rows += [(1000 + k, f"number {5551000000 + k} of {k % 10} items, item {card(k)} and {4000000000000000 + 7 * k} end") for k in range(300)]
    broken = [(2000, "tel +1 (555) 555-1234 190.137.223.204 now"), (2001, f"pay {card(7)} {card(8)} end"), (2002, "tel 1 (555) 555-1234 now"), (2003, "write to user7 at mail1.example dot com today")]
    docs = spark.createDataFrame(rows + broken, "doc_id long, text string")
    found, detector = pii.with_spans(docs, "base", "spans")
    assert all(detector.threshold[k] is not None for k in ("phone", "card", "email")) and detector.trees["phone"]
    assert found.count() == len(rows) + len(broken)
    red = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert red[0] == "write to [email] today or tel [phone] now" and red[1007].startswith("number 5551000007 of 7 items, item [card] and ")
    assert red[2000] == "tel [phone] [ip] now" and red[2001] == "pay [card] [card] end" and red[2002] == "tel [phone] now"
    more = {r["doc_id"]: r["n"] for r in found.select("doc_id", sum((F.size(F.col("spans")[k]) - F.size(F.col("base")[k]) for k in pii.KINDS), F.lit(0)).alias("n")).collect()}
    assert [more[2000], more[2001], more[2002]] == [1, 2, 1] and sum(more[k] for k, _ in rows) <= 6


def test_pii_boosting_equals_plain_python(spark):
    """The same trees from a plain Python boosting run over the same histogram."""
    rng = np.random.default_rng(4)
    rows = [("card", bool(rng.integers(3) == 0), int(v[2] > 3 or v[0] > 9), v, int(rng.integers(1, 5))) for v in rng.integers(0, 12, (400, 3)).tolist()]
    d = pii.learn(spark.createDataFrame(rows, "kind string, held boolean, y int, x array<int>, n long"), rounds=3)
    train = [r for r in rows if not r[1]]
    pos, neg = (sum(r[4] for r in train if r[2] == y) for y in (1, 0))
    score = {id(r): math.log((pos + 1) / (neg + 1)) for r in rows}

    def best(part):
        cells = collections.defaultdict(lambda: collections.defaultdict(lambda: (0.0, 0.0)))
        for r in part:
            p = 1 / (1 + math.exp(-score[id(r)]))
            for f, v in enumerate(r[3]):
                g, h = cells[f][v]
                cells[f][v] = (g + r[4] * (r[2] - p), h + r[4] * p * (1 - p))
        return pii._split(cells)

    def leaf(part):
        g = h = 0.0
        for r in part:
            p = 1 / (1 + math.exp(-score[id(r)]))
            g, h = g + r[4] * (r[2] - p), h + r[4] * p * (1 - p)
        return pii.LEARNING_RATE * g / (h + 1)

    for tree in d.trees["card"]:
        _, f, v = best(train)
        assert tree.root == (f, v)
        step = {}
        for side, inside in enumerate((lambda r: r[3][f] <= v, lambda r: r[3][f] > v)):
            half = [r for r in train if inside(r)]
            inner = best(half)
            assert tree.sides[side] == (inner and inner[1:])
            for k, low in enumerate((True, False)):
                part = [r for r in half if not inner or (r[3][inner[1]] <= inner[2]) == low]
                assert abs(leaf(part) - tree.leaves[2 * side + k]) < 1e-9
                step |= {id(r): tree.leaves[2 * side + k] for r in rows if inside(r) and (not inner or (r[3][inner[1]] <= inner[2]) == low)}
        for k, x in step.items():
            score[k] += x
    assert d.threshold["card"] is not None


def expected_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        left = [s for s in order if s not in full]
        if not left:
            return {s: 3 * sizes[s] for s in order}
        level = (total - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in left)
        new = {s for s in left if level * weight[s] > 3 * sizes[s]}
        if not new:
            return {s: 3 * sizes[s] if s in full else level * weight[s] for s in order}
        full |= new


def test_mixing(spark, sample, odd):
    for docs in (sample, odd):
        source = [(r["doc_id"], r["source"], len(SPACE.findall(r["text"] or ""))) for r in docs.collect()]
        sizes = collections.Counter()
        for _, s, n in source:
            sizes[s] += n
        want = expected_targets(sizes)
        got = mixing.mix(docs).collect()
        again = mixing.mix(docs.repartition(5)).collect()
        assert len(got) == len(source)
        assert sorted((r["size"], r["source_size"], round(r["target"], 3)) for r in got) == sorted((n, sizes[s], round(want[s], 3)) for _, s, n in source)
        assert all(0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0) for r in got)
        if docs is sample:
            assert pairs(got, "taken") == pairs(again, "taken")
            by = collections.Counter()
            named = {d: s for d, s, _ in source}
            for r in got:
                by[named[r["doc_id"]]] += r["taken"]
            largest = max(n for _, _, n in source)
            assert all(abs(by[s] - want[s]) <= largest / 2 + 1 for s in want)
            assert mixing.mixed_corpus(docs).count() == sum(r["copies"] for r in got)


@pytest.mark.parametrize("run", [10_000, 7])
def test_mixing_of_repeated_rows(spark, monkeypatch, run):
    """Each source comes near its target, whatever part of it is one row repeated; the mix itself holds what the digest says."""
    monkeypatch.setattr(mixing, "RUN", run)
    rows = [(1, " ".join(["w"] * 10), "en", "a", 0)] * 100 + [(100 + k, " ".join(["w"] * 10), "en", "b", 0) for k in range(100)] + [(k, "x " * (k % 9 + 1), "de", "c", 0) for k in range(300, 330)] + [(9, "y " * 30, "en", "c", 0)] * 12
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    sizes = collections.Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len(text.split())
    want, taken = expected_targets(sizes), collections.Counter()
    got = mixing.mix(docs).collect()
    source = {r[0]: r[3] for r in rows}
    for r in got:
        taken[source[r["doc_id"]]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    assert len(got) == len(rows) and all(abs(taken[s] - want[s]) <= 15 for s in want)
    spread = {r["copies"] for r in got if r["doc_id"] == 1}
    assert max(spread) - min(spread) <= 1
    mixed = collections.Counter(r["source"] for r in mixing.mixed_corpus(docs).collect())
    total = collections.Counter(source[r["doc_id"]] for r in got for _ in range(r["copies"]))
    slack = 0 if run > 1000 else 1 + 100 // run
    assert all(0 <= total[s] - mixed[s] <= slack for s in total)


def test_unsettled_multipliers_are_an_error(spark, sample):
    work = mixing.Workspace(spark, "unsettled")
    sizes = sample.select("source", mixing.word_count(sample["text"]).alias("size")).selectExpr("*", "1L AS n")
    with pytest.raises(ValueError, match="did not settle"):
        mixing.solve_rates(sizes, mixing.targets(sizes), work, steps=1)


def test_lm_scoring(spark, sample, odd):
    for docs in (sample, odd):
        rows = docs.collect()
        train = [r for r in rows if r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1]
        token = lambda t: [*SPACE.findall(lower(t)), "\n"]
        c = collections.Counter(w for r in train for w in token(r["text"]))
        n, z = sum(c.values()), math.log10(sum(c.values()) + 0.5 * (len(c) + 1))
        for how in ({}, {"vocabulary": 50}):
            got = lm_scoring.score(docs, **how).collect()
            key = lambda x: (repr(x[0]), *x[1:])
            want = sorted(((r["doc_id"], len(token(r["text"])), sum(w in c for w in token(r["text"])), r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1, round(sum(math.log10(c[w] + 0.5) - z for w in token(r["text"])), 4)) for r in rows), key=key)
            have = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["held_out"], round(r["base_score"], 4)) for r in got), key=key)
            for a, b in zip(want, have, strict=True):
                assert a[:4] == b[:4] and abs(a[4] - b[4]) <= 2e-4 * max(1, abs(a[4]))
            assert {r["train_tokens"] for r in got} == {n}


def test_lm_both_ways_agree(spark, odd, sample):
    """The same filter, broadcast whole, and asked in its blocks; the blocks are those of the text's size."""
    for docs in (sample, odd):
        score = lambda **how: sorted(((repr(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 5), round(r["score"], 5)) for r in lm_scoring.score(docs, **how).collect()))
        whole = score(block_text=20_000)
        assert score(block_text=20_000, broadcast_bytes=0, part_bytes=50_000) == whole
        assert len(whole) == docs.count()


def test_log_frequency_levels():
    rng = np.random.default_rng(1)
    g, level = rng.integers(0, 1 << 40, 3000).astype(np.uint64), rng.integers(1, 12, 3000)
    bits = lm_scoring.filter_of(g, 1 << (level - 1))
    size, begin = np.full(3000, 8 * len(bits), np.uint64), np.zeros(3000, np.int64)
    got = lm_scoring.levels_in(g, bits, begin, size)
    assert (got >= level).all() and (got == level).mean() > 0.99
    assert (lm_scoring.levels_in(rng.integers(1 << 41, 1 << 42, 3000).astype(np.uint64), bits, begin, size) == 0).mean() > 0.99


def simhash_of(text):
    w = SPACE.findall(lower(text))
    grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in grams]
    return sum((sum(x >> b & 1 for x in h) * 2 > len(h)) << b for b in range(64))


def roots(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return [root(k) for k in range(n)]


@pytest.mark.parametrize("how", [{}, {"blocks": 8}, {"blocks": 1, "tile_points": 7}, {"blocks": 16}, {"radius": 5}])
def test_simhash(spark, sample, how):
    docs = sample.select("doc_id", "text")
    rows = docs.collect()
    f = np.array([simhash_of(r["text"]) for r in rows], np.uint64)
    links = [(i, j) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f[i] ^ f[:i]) <= how.get("radius", 2)).tolist()]
    r = roots(len(f), links)
    low = {k: min(rows[i]["doc_id"] for i in range(len(f)) if r[i] == k) for k in set(r)}
    got = simhash.near_components(docs, **how).collect()
    assert pairs(got, "fingerprint", "component_id") == sorted(((rows[i]["doc_id"], f"{int(f[i]):016x}", low[r[i]]) for i in range(len(f))), key=repr)


def test_near_points_of_every_distance(spark):
    """Fingerprints made to lie 1, 2 and 3 bits apart, in chains and around cell borders."""
    from folioflow.llm._common import Workspace

    rng = np.random.default_rng(3)
    points = {0, 2**64 - 1}
    for _ in range(60):
        x = int(rng.integers(0, 1 << 63))
        for _ in range(6):
            points.add(x)
            for b in rng.choice(64, rng.integers(1, 4), replace=False).tolist():
                x ^= 1 << b
    p = np.array(sorted(points), np.uint64)
    want = roots(len(p), [(i, j) for i in range(len(p)) for j in np.flatnonzero(np.bitwise_count(p[i] ^ p[:i]) <= 2).tolist()])
    frame = spark.createDataFrame([(int(x),) for x in p.view(np.int64)], "fp long")
    for blocks in (1, 2, 4, 8, 16):
        work = Workspace(spark, "t")
        edges = [(r["a"], r["b"]) for r in simhash.near_edges(frame, work, blocks=blocks, tile_points=16).collect()]
        at = {int(x): k for k, x in enumerate(p.view(np.int64))}
        assert roots(len(p), [(at[a], at[b]) for a, b in edges]) == want
        got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long"), work).collect()}
        group = collections.defaultdict(set)
        for k, x in enumerate(p.view(np.int64).tolist()):
            group[want[k]].add(x)
        assert {frozenset(g) for g in group.values() if len(g) > 1} == {frozenset(n for n, r in got.items() if r == k) | {k} for k in set(got.values())}


def test_near_dedup(spark, sample, odd):
    for docs in (sample, odd):
        rows = sorted(docs.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
        sets = []
        for r in rows:
            w = SPACE.findall(lower(r["text"]))
            sets.append(frozenset(" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
        links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] == sets[j] or (sets[i] | sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))]
        want = sorted({rows[k]["doc_id"] for k in roots(len(rows), links)}, key=repr)
        got = near_dedup.near_dedup(docs, tile_points=64)
        assert got.columns == docs.columns and sorted((r["doc_id"] for r in got.collect()), key=repr) == want


def test_language_id(spark, odd):
    got = language_id.op8_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {k for k in lang if zlib.crc32(str(k).encode()) % 3 == 1}
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)
    for r, text in zip(sorted(language_id.identify(odd).collect(), key=repr), [None] * 99, strict=False):
        assert r["lang_pred"] is not None
    und = [r["lang_pred"] for r in language_id.identify(odd.where("text IS NULL OR trim(text) = ''")).collect()]
    assert set(und) == {"und"}


def test_language_vectors():
    s = language_id.Space(64, 3, 1)
    text = "Die äußere Über-Größe 12 x"
    numbers, counts = s.grams(text)
    want = np.zeros(64)
    codes = [0]
    for ch in text.lower():
        c = 1 + ord(ch) % language_id.ALPHABET if ch.isalpha() else 0
        if c or codes[-1]:
            codes.append(c)
    codes += [0] if codes[-1] else []
    for i in range(len(codes) - 2):
        v = np.ones(64)
        for k in range(3):
            v *= s.rotated[k][codes[i + k]]
        want += v
    assert np.allclose(s.bundle(text), want)


def test_sharding(spark, sample, odd):
    for docs, how in ((sample, {}), (sample, {"bucket_bytes": 50_000}), (odd, {"bucket_bytes": 20_000}), (odd.limit(3), {})):
        rows = docs.select("doc_id", "text").collect()
        got = sharding.assign(docs, **how).collect()
        want = [(r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in rows]
        assert pairs(got, "size", "text_crc32") == sorted(want, key=repr)
        by = collections.defaultdict(list)
        for r in got:
            by[r["shard"]].append(r["slot"])
        assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(8))
        sizes = [len(by.get(k, [])) for k in range(8)]
        assert max(sizes) - min(sizes) <= 1
    again = sharding.assign(sample, bucket_bytes=50_000).collect()
    assert pairs(again, "shard", "slot") == pairs(sharding.assign(sample.repartition(3), bucket_bytes=50_000).collect(), "shard", "slot")


def test_token_files(spark, sample, odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    for docs in (sample, odd):
        rows = docs.collect()
        ids = [[*t.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in rows]
        got = token_ids.encode_corpus(docs, path).collect()
        want = [(r["doc_id"], len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for r, x in zip(rows, ids, strict=True)]
        assert pairs(got, "n_tokens", "ids_crc32") == sorted(want, key=repr)
        place = 0
        for r in sorted(got, key=lambda r: r["start"]):
            assert r["start"] == place
            place += r["n_tokens"]
        order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
        assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    back = token_ids.encode_corpus(sample, path, digest=False).collect()
    assert {r["doc_id"]: r["ids"] for r in back} == {r["doc_id"]: [*t.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in sample.collect()}


@pytest.mark.parametrize("n", [1, 63, 64, 65, 16_384, 16_385, 65_536, 65_537, 300_000])
def test_coder_round_trip(n):
    x = np.minimum(np.random.default_rng(n).zipf(1.3, n), 49_000).astype(np.int64)
    table = token_ids.Table.of(token_ids.scaled(np.bincount(x)))
    chunk = token_ids.encode(x, table)
    assert (token_ids.decode(chunk, table) == x).all()
    broken = dict(chunk, words=chunk["words"][:-4] + b"\0\1\2\3") if chunk["words"] else dict(chunk, ids_crc=chunk["ids_crc"] ^ 1)
    with pytest.raises(ValueError):
        token_ids.decode(broken, table)


def test_word_cache_equals_tokenizer():
    import random

    import public_tokenizers

    cache = token_ids.WordCache(public_tokenizers.path("word_bpe_49k.json"), limit=5000)
    assert cache.by_word
    rng = random.Random(5)
    parts = ["a", "B", "É", "é", " ", "\n", "\xa0", "\x1c", ",", ".", "'", "'s", "1", "ß", "İ", "Σ", "！", "<|endoftext|>", "<|ENDOFTEXT|>", "<", "|", "日", "😀", "‍", "b,,", "क़", "ng", "(", ")", "_", "!!", "H", "\u0331", "T", "\u0308", "Ж", "ǰ", "ÿ", "\x85", "\xad"]
    for _ in range(300):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(10)] + [None]
        ids, sizes = cache.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [[*cache.tokenizer.encode(x or "", add_special_tokens=False).ids, 1] for x in texts], texts


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers

    cache = token_ids.WordCache(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["Hello,  world\n x", "", "é 日本 <|endoftext|> a"]
    ids, sizes = cache.encode(pa.array(texts))
    assert not cache.by_word
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [[*cache.tokenizer.encode(x, add_special_tokens=False).ids, 1] for x in texts]


def test_token_files_alone(spark, tmp_path):
    """Ids of another type, texts without spaces, and files that a reader knows only the folder of."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from folioflow.llm._common import Workspace

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [("b", "日本語の文章" * 4000), ("a", "Q0hBUlM9" * 3000), (None, "x y"), ("c", None), ("b", "zz " * 700_000)]
    token_ids.write_files(spark.createDataFrame(rows, "doc_id string, text string"), path, str(tmp_path / "f"), Workspace(spark, "t"))
    got = token_ids.read_files(spark.newSession(), str(tmp_path / "f"), digest=False).orderBy("start").collect()
    t = Tokenizer.from_file(path)
    want = {(k, *t.encode(x or "", add_special_tokens=False).ids, 1) for k, x in rows}
    assert [r["doc_id"] for r in got] == [None, "a", "b", "b", "c"] and {(r["doc_id"], *r["ids"]) for r in got} == want


def test_url_filter_equals_sql(spark):
    import duckdb

    from folioflow.llm import url_filter

    con = duckdb.connect()
    con.execute("CREATE VIEW pages AS SELECT * FROM read_parquet('/root/testdata/sf0.01/pages.parquet')")
    want = con.execute(url_filter.OP5_SQL).fetchall()
    names = ["page_id", "host", "fetched", "entry", "action", "entry_begin", "kept"]
    got = [tuple(r[c] for c in names) for r in url_filter.op5_url_filter(spark, "/root/testdata/sf0.01").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len({r[4] for r in got}) == 3


def test_url_filter_edges(spark):
    import datetime as dt

    from folioflow.llm import url_filter

    day = lambda n: dt.datetime(2024, 1, n)
    events = spark.createDataFrame([("bad.org", "block", day(5)), ("bad.org", "drop", day(9)), ("ok.bad.org", "allow", day(6)), (None, "block", day(1)), ("tie.org", "allow", day(2)), ("tie.org", "block", day(2)), ("bad.org", "block", day(5))], "key string, action string, at timestamp")
    rows = [(1, "http://BAD.org/x", day(4)), (2, "http://a.bad.org./", day(5)), (3, "https://u@ok.bad.org:8/", day(7)), (4, "http://bad.org", day(9)), (5, None, day(7)), (6, "nonsense", day(7)), (7, "http://tie.org", day(3)), (8, "http://bad.org", None), (9, "http://notbad.org", day(6))]
    pages = spark.createDataFrame(rows, "id int, url string, fetched timestamp")
    got = {r["id"]: r["kept"] for r in url_filter.judge(pages, events).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 5: True, 6: True, 7: False, 8: True, 9: True}
    kept = url_filter.url_filter(pages.selectExpr("*", "1 AS host", "2 AS action"), events)
    assert kept.columns == ["id", "url", "fetched", "host", "action"] and kept.count() == 7
    assert url_filter.judge(pages, events.limit(0)).where("NOT kept").count() == 0 and url_filter.judge(pages.limit(0), events).count() == 0


@pytest.mark.parametrize("tile_hashes", [near_dedup.TILE_HASHES, 900])
def test_near_dedup_of_edited_copies(spark, tile_hashes):
    """Groups of many edited copies of one text, whose similarities lie on both sides of the limit."""
    rng, rows = np.random.default_rng(11), []
    for group in range(12):
        text = [f"g{group}w{k}" for k in range(300)]
        for copy in range(30):
            own = list(text)
            for k in rng.choice(60, int(rng.integers(3, 6)), replace=False) * 5 + rng.integers(0, 5):
                own[k] = f"c{copy}e{k}"
            rows.append((len(rows), " ".join(own)))
    sets = [frozenset(" ".join(w[i : i + 5]) for i in range(len(w) - 4)) for w in (t.split() for _, t in rows)]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = sorted(set(roots(len(rows), links)))
    got = near_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string"), tile_hashes=tile_hashes)
    assert sorted(r["doc_id"] for r in got.collect()) == want


@pytest.mark.parametrize("how", [{}, {"vocabulary": 20}, {"vocabulary": 0}, {"vocabulary": 20, "broadcast_bytes": 0, "block_text": 4000}])
def test_lm_scores_equal_exact_counts(spark, how):
    """Scores against exact counts of all n-grams; words outside the broadcast table keep their own bigrams and have quantised counts."""
    rng = np.random.default_rng(2)
    rows = [(k, " ".join(f"{w}{rng.integers(0, 400)}" for w in rng.choice(list("abc"), 40)) + " rare one pair" * int(k % 3 == 0)) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tokens = {k: ["\n", *t.split(), "\n"] for k, t in rows}
    train = [k for k in tokens if zlib.crc32(str(k).encode()) % 5 != 1]
    c = collections.Counter(w for k in train for w in tokens[k][1:])
    pair = collections.Counter(p for k in train for p in itertools.pairwise(tokens[k]))
    z, alpha, most = sum(c.values()) + 0.5 * (len(c) + 1), lm_scoring.ALPHA, how.get("vocabulary", 1 << 18)
    cut = min([b for b in {math.floor(4 * math.log2(n)) for n in c.values()} if sum(math.floor(4 * math.log2(n)) >= b for n in c.values()) <= most], default=math.inf)
    count = {w: n if math.floor(4 * math.log2(n)) >= cut else lm_scoring.quantised(n) for w, n in c.items()}

    def log(v, w):
        a, b = count.get(v, 0), count.get(w, 0)
        return math.log10((min(lm_scoring.quantised(pair[v, w]), a, b) + alpha * (b + 0.5) / z) / (a + alpha))

    got = {r["doc_id"]: r["score"] for r in lm_scoring.score(docs, **how).collect()}
    off = [got[k] - sum(log(v, w) for v, w in itertools.pairwise(tokens[k])) for k in tokens]
    # a false yes of the filter (fewer than 1 in 200) makes a bigram of a few texts likelier, or a rare context commoner
    assert np.mean(np.abs(off) < 1e-6) > 0.6 and np.mean(np.abs(off)) < 0.3 and np.max(np.abs(off)) < 5


def test_lm_a_bigram_seen_once_counts(spark):
    """Two held-out texts of the same words: the one whose bigrams were seen once scores higher."""
    train = next(k for k in range(9) if zlib.crc32(str(k).encode()) % 5 != 1)
    first, second = [k for k in range(20, 99) if zlib.crc32(str(k).encode()) % 5 == 1][:2]
    rows = [(train, "a b c d e f g h"), (first, "a b c d e f g h"), (second, "h g f e d c b a")]
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[first] > got[second]
    assert lm_scoring.quantised(0) == 0 and lm_scoring.quantised(1) == 1 and 2 < lm_scoring.quantised(2) < 4


def test_url_filter_addresses_and_clashing_names(spark):
    from folioflow.llm import url_filter

    urls = ["http://[2001:DB8::1]:80/x", "https://u:p@Example.org:8443/a", "http://h.example.org", "nonsense", None]
    hosts = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "url string").select(url_filter.host_of(url_filter.F.col("url"))).collect()]
    assert hosts == ["[2001:db8::1]", "example.org", "h.example.org", None, None]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "id int, url string, kept string").selectExpr("*", "TIMESTAMP '2024-06-01' AS fetched", "1 AS host", "2 AS action", "3 AS entry", "4 AS verdict", "5 AS of")
    events = spark.createDataFrame([("[2001:db8::1]", "block"), ("example.org", "block")], "key string, action string").selectExpr("*", "TIMESTAMP '2024-01-01' AS at")
    out = url_filter.judge(pages, events)
    assert out.columns == [*pages.columns, "_host", "_entry", "_action", "entry_begin", "_kept"]
    assert {r["id"]: r["_kept"] for r in out.collect()} == {0: False, 1: False, 2: False, 3: True, 4: True}


def test_codes_beyond_63_bits(spark, monkeypatch):
    """Shingle codes of a vocabulary whose cube does not fit: hashes, with the same results."""
    docs = spark.createDataFrame([(1, "x a b c d e f g h i j z"), (2, "j i h g f e d c b a"), (3, "a b c")], "doc_id int, text string")
    bench = spark.createDataFrame([("p", "a b c d e f g h i j"), ("q", "a b c"), ("r", "c b")], "item_id string, text string")
    want = pairs(decontamination.contamination(docs, bench).collect(), "n_hit", "n_items")
    assert want == [(1, 10, 2), (2, 2, 1), (3, 3, 1)]
    windows = decontamination.cut([("p", "a b c d")], 10)
    assert decontamination._base(3_000_000, 3) % 2 == 1 and decontamination._base(2_000_000, 3) == 2_000_000
    big = decontamination.Windows({str(k).encode(): k for k in range(3_000_000)}, [(2_999_999, 2_999_998, 7, 2_999_999)], [["p"]])
    s, codes = big.codes(big.rows[0], 3)
    at, same = decontamination._positions(np.array(big.rows[0], np.int64), 3, 3_000_000)
    assert s == 3 and at.tolist() == [0, 1] and same.tolist() == codes and windows.codes(windows.rows[0], 3)[1] == [0 * 16 + 1 * 4 + 2, 1 * 16 + 2 * 4 + 3]


def test_sharding_of_hot_records(spark, sample):
    """A record repeated for a third of all bytes is spread over the order; other rows keep their places whatever the files."""
    hot = spark.range(3000).selectExpr("7L AS doc_id", "repeat('hot text ', 30) AS text")
    docs = sample.select("doc_id", "text").unionByName(hot)
    runs = [sharding.assign(d, bucket_bytes=50_000).collect() for d in (docs, docs.repartition(5))]
    for got in runs:
        sizes = collections.Counter(r["shard"] for r in got)
        copies = collections.Counter(r["shard"] for r in got if r["size"] == 271 and r["doc_id"] == 7)
        assert len(got) == sample.count() + 3000 and max(sizes.values()) - min(sizes.values()) <= 1
        assert len(copies) == 8 and min(copies.values()) > 300 and max(copies.values()) < 460


def test_no_local_work_folder_on_a_cluster():
    from types import SimpleNamespace

    from folioflow.llm import _common

    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: {}, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        _common.shared_folder(SimpleNamespace(sparkContext=context, conf={}))
