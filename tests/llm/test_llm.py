"""The training-data operators against brute force, round trips and held-out accuracy; nulls, ties, repeats, empty tables."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import abuse, mixing, packing, queries, segments, sketch, tokens, topn
from ledgerlens.llm.components import components
from tests.conftest import DATA, against_sql


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    got, wanted = against_sql(spark, queries.QUERIES[name], queries.ORACLE[name])
    assert got == wanted


# ---- percentiles ----


def test_sketch_error_and_merge(spark):
    rng = np.random.default_rng(1)
    rows = [("hot", int(i % 3), float(x), 1) for i, x in enumerate([*rng.lognormal(5, 3, 1500), *-rng.lognormal(2, 2, 500), 0.0, 0.0])] + [("one", 0, 7.0, 1), ("none", 0, None, 1), ("none", 0, float("nan"), 1), ("inf", 0, float("inf"), 1)]
    df = spark.createDataFrame(rows, "g string, day int, v double, bucket int")
    whole = sketch.build(df, ["g"], "v", 0.01)
    merged = sketch.merge(sketch.build(df, ["g", "day"], "v", 0.01), ["g"])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))
    values = sorted(r[2] for r in rows if r[0] == "hot")
    for r in sketch.percentiles(merged, ["g"], [0.01, 0.25, 0.5, 0.99], 0.01).where("g = 'hot'").collect():
        true = values[max(1, -(-int(round(r.p * 100)) * len(values) // 100)) - 1]
        assert r.low <= true <= r.high and abs(r.estimate - true) <= 0.0100001 * abs(true) + 1e-12
    exact = {(r.g, r.p): r.value for r in sketch.exact_percentiles(df, merged, ["g"], "v", [0.5], 0.01).collect()}
    assert exact == {("hot", 0.5): values[-(-len(values) // 2) - 1], ("one", 0.5): 7.0, ("inf", 0.5): float("inf")}
    assert sketch.percentiles(sketch.build(df.limit(0), ["g"], "v"), ["g"], [0.5]).count() == 0
    assert whole.count() <= sketch.buckets_bound(0.01) + 3
    with pytest.raises(ValueError):
        sketch.gamma_of(1.5)


# ---- top N ----


def test_top_n(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice(["HOT"] * 8 + [f"g{k}" for k in range(20)] + [None]), rng.choice([None, float("nan"), 0.0, -0.0, *map(float, range(2000))]), rng.choice([None, *(f"i{k}" for k in range(300))]), k, "x") for k in range(8000)]
    df = spark.createDataFrame(rows, "grp string, score double, item string, tie long, g string")
    index = topn.cluster(df, ["grp"], "score", "item", "tie", str(tmp_path / "c"))
    got = {(r.g.partition(":")[2], r["rank"]): (r.score, r.item, r.tie) for r in topn.top_n_clustered(index, 4).collect()}
    best = defaultdict(dict)
    for g, s, i, t, _ in rows:
        if None in (g, s, i) or s != s:
            continue
        if i not in best[g] or (-s, t) < best[g][i]:
            best[g][i] = (-s, t)
    wanted = {(g, k + 1): (-s, i, t) for g, b in best.items() for k, ((s, t), i) in enumerate(sorted((v, i) for i, v in b.items())[:4])}
    assert got == wanted
    # only the first band of each file is read; the same layout serves another N, which reads more
    seen, deeper = topn.skips(index, 4).collect(), topn.skips(index, 40).collect()
    assert sum(r.skipped for r in seen) > sum(r.read for r in seen) > 0 and sum(r.read for r in deeper) > sum(r.read for r in seen)
    assert {(r.g.partition(":")[2], r["rank"]) for r in topn.top_n_clustered(index, 2).collect()} == {k for k in wanted if k[1] <= 2}
    assert topn.top_n(df.limit(0), ["grp"], "score", "item", "tie", 2).count() == 0
    assert topn.top_n(df.select("grp", "score", "item", "tie").union(df.select("grp", "score", "item", "tie")), ["grp"], "score", "item", "tie", 4).count() == len(wanted)
    with pytest.raises(ValueError):
        topn.top_n(df, ["grp"], "score", "item", "tie", 0)


# ---- batches against history ----


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _mutate(rng, s, k):
    for _ in range(k):
        i = rng.randrange(max(1, len(s)))
        s = rng.choice([s[:i] + s[i + 1 :], s[:i] + rng.choice("AB01") + s[i:], s[:i] + rng.choice("AB01") + s[i + 1 :]])
    return s


def _jobs(rng, n):
    base = [f"{''.join(rng.choice('AB') for _ in range(4))}2{rng.randrange(5)}-{rng.randrange(10**6):010d}" for _ in range(n // 4)]
    rows = []
    for k in range(n):
        s = rng.choice(base)
        form = rng.choice([lambda x: x, str.lower, lambda x: x.replace("-", "/"), lambda x: f" {x} ", lambda x: x[:7] + x[7:].lstrip("0"), lambda x: _mutate(rng, x, rng.randrange(1, 4))])
        rows.append((k, form(s), rng.choice(["A", "A", "B", None]), rng.choice([1, 2])))
    return [*rows, (n, None, "A", 1), (n + 1, " -/", "A", 1), (n + 2, "-", "A", 1)]


def _brute(rows):
    import re

    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    use = []
    for seq, job, a, b in rows:
        s = re.sub(r"[\W_]+", "", job or "").upper()
        if s:
            m = re.match(r"([A-Z]+\d\d)0*(\d*)$", s)
            use.append((seq, s, m[1] + m[2] if m else s, a and (a, b)))
    for i, x in enumerate(use):
        for y in use[:i]:
            if x[2] == y[2] or x[3] and x[3] == y[3] and _distance(x[1], y[1]) <= 2:
                a, b = find(x[0]), find(y[0])
                parent[max(a, b)] = min(a, b)
    return {(find(u[0]), u[0]) for u in use if find(u[0]) != u[0]}


def test_repeats_and_batches(spark, tmp_path):
    rows = _jobs(random.Random(3), 240)
    df = spark.createDataFrame(rows, "seq long, job string, a string, b int").withColumn("canon", F.lit("clash"))
    keyed = segments.keyed(df, "seq", F.col("job"), [F.col("a"), F.col("b")])
    wanted = _brute(rows)
    assert len(wanted) > 100
    for buckets in (1, 4):
        index = segments.BatchIndex(spark, str(tmp_path / f"index{buckets}"), buckets=buckets)
        before = set()
        for k, (lo, hi) in enumerate(((0, 120), (120, 120), (120, 243))):
            seen = {tuple(r) for r in index.check(k, keyed.where(f"seq >= {lo} and seq < {hi}")).collect()}
            true = _brute([x for x in rows if x[0] < hi])
            # rows of earlier batches whose class got an earlier first row come out again
            assert seen == true - before
            before = true
        assert {tuple(r) for r in index.repeats().collect()} == wanted and index.batches() == [0, 1, 2]
        index.accept(2, keyed)  # not taken again
        index._write(keyed.withColumn("batch", F.lit(3)), "rows")  # broke off before its mark
        assert {tuple(r) for r in index.repeats().collect()} == wanted
    together = segments.BatchIndex(spark, str(tmp_path / "together"), crowd=1, together=2)
    together.accept_all([0, 1, 2], keyed.withColumn("batch", (F.col("seq") % 3).cast("int")))
    assert {tuple(r) for r in together.repeats().collect()} == wanted
    none = segments.BatchIndex(spark, str(tmp_path / "none"))
    assert none.repeats().count() == 0 and none.check(0, keyed.limit(0)).count() == 0


def test_small_batch_reads_few_buckets(spark, tmp_path):
    """The history doubles, the batches stay the same: so do the buckets read, and each has only its share of the strings."""
    df = spark.range(4000).selectExpr("id as seq", "concat('ABCD21', lpad(id, 10, '0')) as s", "s as canon", "id % 2000 as scope")
    index = segments.BatchIndex(spark, str(tmp_path / "index"), buckets=16)
    index.accept_all([0, 1, 2, 3], df.withColumn("batch", F.expr("cast(seq div 1000 as int)")))
    index.accept(9, df.where("seq < 3"))
    buckets = [r[0] for r in index._read("strings", segments.STRINGS, [9]).select("bucket").distinct().collect()]
    part = index._read("strings", segments.STRINGS, [0, 1, 2, 3]).where(F.col("bucket").isin(buckets))
    assert len(buckets) <= 3 and len(part.inputFiles()) <= 3 * 4 * 8 and part.count() < 4000 * 4 / 16


def test_crowded_scope_meets_by_deletions(spark):
    rng = random.Random(5)
    words = list({_mutate(rng, "ABCD21000012", rng.randrange(5)) for _ in range(200)})
    df = spark.createDataFrame([(1, w) for w in words], "scope long, s string")
    known = df.select("scope", "s", segments.segments_of().alias("segments"))
    wanted = {frozenset((x, y)) for x in words for y in words if x < y and _distance(x, y) <= 2}
    for crowd in (10, 10_000):
        assert {frozenset((r.s, r.t)) for r in segments.near(df, known, crowd=crowd).collect()} == wanted


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_segment_index_finds_all_pairs(spark, tau):
    rng = random.Random(4)
    words = list({_mutate(rng, rng.choice(["ABAB0101ABAB", "0101", "A", "ABABAB01"]), rng.randrange(4)) or "B" for _ in range(150)} | {"", "A"} - {""})
    df = spark.createDataFrame([(1, w) for w in words], "scope long, s string")
    got = {frozenset((r.s, r.t)) for r in segments.near(df, df.select("scope", "s", segments.segments_of(tau).alias("segments")), tau).collect()}
    # a string with fewer letters than segments has an empty one, which every string of its length's neighbours shares
    assert got == {frozenset((x, y)) for x in words for y in words if x < y and _distance(x, y) <= tau}


# ---- containers ----


def _check(packed, items, capacity):
    rows = packed.collect()
    fill, pieces = Counter(), defaultdict(list)
    for r in rows:
        fill[r.container] += r["size"]
        pieces[r["item"]].append(r)
    assert max(fill.values(), default=0) <= capacity
    for i, s in items.items():
        assert sum(r["size"] for r in pieces[i]) == s and len(pieces[i]) == max(1, -(-s // capacity)) and {r.pieces for r in pieces[i]} == {len(pieces[i])}
    assert len(rows) == sum(max(1, -(-s // capacity)) for s in items.values())
    return len(fill)


@pytest.mark.parametrize("kind", ["mixed", "one size", "large", "zeros", "thirds"])
def test_packing(spark, monkeypatch, kind):
    monkeypatch.setattr(packing, "RANKED", 50)
    rng = random.Random(5)
    sizes = {"mixed": lambda: rng.choice([0, 7, 30, 90, 250, rng.randrange(1, 100)]), "one size": lambda: 51, "large": lambda: rng.randrange(60, 100), "zeros": lambda: 0, "thirds": lambda: rng.choice([33, 34])}[kind]
    items = {k: sizes() for k in range(400)}
    df = spark.createDataFrame([*items.items()], "item long, size long").withColumn("rank", F.lit(1))
    packed, plan = packing.pack(df, "item", "size", 100)
    used = _check(packed, items, 100)
    bound = -(-sum(items.values()) // 100)
    # of 33 and 34, two and one fill a container; what is left of 34 goes by two
    n33, n34 = (list(items.values()).count(x) for x in (33, 34))
    thirds = min(n33 // 2, n34) + max(0, n34 - n33 // 2) / 2 + max(0, n33 - 2 * n34) / 3
    assert used <= {"mixed": bound * 1.02 + 1, "one size": 400, "large": 400, "zeros": 1, "thirds": thirds * 1.05 + 1}[kind]


def test_packing_edges(spark):
    df = spark.createDataFrame([(1, None), (None, 5), (2, 5), (2, 5)], "item long, size long")
    packed, plan = packing.pack(df, "item", "size", 8)
    assert sorted((r["item"], r["size"]) for r in packed.collect()) == [(1, 0), (2, 5), (2, 5)] and plan.containers == 2
    assert packing.pack(df.limit(0), "item", "size", 8)[0].count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, "item", "size", 0)


def test_program_covers_rare_sizes():
    rng = random.Random(8)
    histogram = {s: rng.randrange(1, 8) for s in rng.sample(range(5, 250), 200)}
    sizes = np.array(sorted(histogram))
    need = np.array([histogram[s] for s in sizes.tolist()])
    chosen, bound = packing.cover(sizes, need, 500, 1.0, packing.LpSpec())
    covered = np.zeros(len(sizes))
    for config, x in chosen.items():
        assert x > 0 and sum(int(sizes[i]) * k for i, k in config) <= 500
        for i, k in config:
            covered[i] += k * x
    assert covered == pytest.approx(need) and bound >= need @ sizes / 500
    made = packing.plan(histogram, 500)
    assert 0 <= made.gap <= 0.02 and made.from_program > 0
    placed = Counter()
    for n, config in made.parts:
        for s, k in config.items():
            placed[s] += n * k
    assert placed == histogram


def test_knapsack_is_best():
    rng = random.Random(6)
    for _ in range(20):
        sizes = np.array(rng.sample(range(2, 12), 3))
        values = np.array([rng.random() for _ in sizes])
        take = packing.knapsack(sizes, values, np.full(3, 99), 20)
        best = max(a * values[0] + b * values[1] + c * values[2] for a in range(11) for b in range(11) for c in range(11) if a * sizes[0] + b * sizes[1] + c * sizes[2] <= 20)
        assert take @ sizes <= 20 and take @ values >= best - 1e-9


# ---- mixing ----


def test_mixing(spark):
    rng = random.Random(7)
    rows = [(k, rng.choice(["a", " A ", "b", "c", None]), rng.choice(["x", "y", None]), rng.choice(["t", "u"]), rng.randrange(0, 60)) for k in range(4000)] + [(9999, "b", "x", "t", None)]
    docs = spark.createDataFrame(rows, "doc long, src string, lang string, topic string, tok long")
    targets = spark.createDataFrame([("a", 0.3, 2), ("b", 0.5, 2), ("c", 0.1, 1), ("gone", 0.1, 5)], "source string, target_share double, max_repeats int")
    sample, report = mixing.mix(docs, "doc", "src", "lang", "topic", "tok", targets)
    total = sum(r[4] or 0 for r in rows)
    size = Counter()
    for r in rows:
        size[(r[1] or "").strip().lower()] += r[4] or 0
    got = {r.source: r for r in report.collect()}
    assert {s: got[s].short for s in got} == {"a": False, "b": size["b"] * 2 < 0.5 * total, "c": False, "gone": True}
    for s, share in (("a", 0.3), ("c", 0.1)):
        assert got[s].planned_size == pytest.approx(share * total, rel=1e-6) and got[s].reached_size == pytest.approx(share * total, rel=0.1)
    assert sum(r.reached_share for r in got.values()) == pytest.approx(1)
    caps = {"a": 2, "b": 2, "c": 1}
    assert all(0 < r.copies <= caps[r.source] for r in sample.collect())
    sample2, _ = mixing.mix(docs.repartition(7), "doc", "src", "lang", "topic", "tok", targets)
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, sample2.collect()))
    empty, report = mixing.mix(docs.limit(0), "doc", "src", "lang", "topic", "tok", targets)
    assert empty.count() == 0 and report.count() == 4


def test_rake_meets_marginals():
    rng = np.random.default_rng(8)
    cells = [(s, lang, t) for s in "abc" for lang in "xy" for t in "tu"]
    size = rng.integers(50, 500, len(cells)).astype(float)
    r = mixing.rake(cells, size, {"a": 0.2, "b": 0.3, "c": 0.5}, {"a": 9, "b": 9, "c": 9})
    w = r.factor * size
    for k, shares in ((0, {"a": 0.2, "b": 0.3, "c": 0.5}), *((k, {v: size[[c[k] == v for c in cells]].sum() / size.sum() for v in names}) for k, names in ((1, "xy"), (2, "tu")))):
        for v, share in shares.items():
            assert w[[c[k] == v for c in cells]].sum() == pytest.approx(share * size.sum(), rel=1e-6)


def test_topics_and_tokens(spark):
    text = ["La facture et la facture, douane", "", None, "nothing here", "customs certificate", "x " * 200_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(text)], "i int, t string")
    rows = df.select("i", mixing.topic_of(F.col("t")).alias("topic"), tokens.count_tokens(F.col("t")).alias("n")).orderBy("i").collect()
    assert [r.topic for r in rows] == ["billing", "other", None, "other", "customs", "other"]
    enc = tokens.encoder()
    assert [r.n for r in rows] == [None if t is None else len(enc.encode_ordinary(t)) for t in text] and rows[1].n == 0 and rows[5].n > 100_000


# ---- components ----


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 6000 + i) for i in range(300)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components(df, "a", "b").collect()}
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: find(x) for x in linked if find(x) != x} or {k: v for k, v in got.items() if k != v} == {x: find(x) for x in linked if find(x) != x}
    assert components(df.limit(0), "a", "b").count() == 0


# ---- content ----


@pytest.mark.parametrize(
    "text, words",
    [
        ("M&#233;rci", ["merci"]), ("opÃ©ration", ["operation"]), ("t u r d at", ["turd", "at"]), ("s-c-u-m!", ["scum"]), ("fо​оt", ["fot"]), ("W#rthless", ["w?rthles"]),
        ("1mpor7ant", ["important"]), ("soooo", ["so"]), ("TQR26-8445047 12:30", []), ("", []), ("...", []), ("p@7he7!c", ["pathetic"]),
    ],
)
def test_spelling(text, words):
    assert [w for s in abuse.sentences(text) for w in s] == words


def _reviewed(spark):
    if not (DATA / "sf0.001").exists():
        pytest.skip("no test data")
    return abuse.examples_of(spark.read.parquet(str(DATA / "sf0.001" / "review_examples.parquet")), "example_id", "example_text", "verdict")


def test_held_out_accuracy(spark):
    """Three folds of the reviewed texts, each scored as a corpus of its own by machines that were trained on the others."""
    texts, bad = _reviewed(spark)
    fold = np.random.default_rng(9).permutation(len(texts)) % 3
    hits = found = true = 0
    for k in range(3):
        own = spark.createDataFrame([(i, texts[i]) for i in np.flatnonzero(fold == k).tolist()], "i int, text string")
        scored, threshold = abuse.score_corpus(own, "text", [t for t, f in zip(texts, fold) if f != k], [b for b, f in zip(bad, fold) if f != k], abuse.FmSpec(bits=20, common=0.05))
        flagged = {r.i for r in scored.where(F.col("score") > threshold).collect()}
        real = {i for i in np.flatnonzero(fold == k).tolist() if bad[i]}
        hits, found, true = hits + len(flagged & real), found + len(flagged), true + len(real)
    # 0.85 and 0.79: about one verdict in twenty is wrong, and a fold has few texts to learn new words from; many are abusive, so a term of them is common
    assert hits / true > 0.8 and hits / found > 0.75


def test_threshold_of_best_expected_f():
    at = np.array(abuse.GRID)
    flagged, found = 0.02 * np.exp(-at / 3) + 0.05 * np.exp(-at / 0.1), np.exp(-at / 3)
    f = 2 * 0.02 * found / (flagged + 0.02)
    chosen = abuse.choose_threshold(flagged, found)
    assert f[int(round(chosen / 0.05)) - 1] > f.max() - 0.01
    assert abuse.choose_threshold(flagged * 0, found) == 1.0 and abuse.choose_threshold(flagged, found * 0) == 1.0


def test_corpus_teaches_new_words(spark):
    """A word that stands only where texts are abusive anyway is found where it stands alone; one that stands everywhere isn't."""
    texts = ["you useless idiot"] * 6 + ["you rotten idiot"] * 6 + ["the container came late"] * 12
    docs = [f"you useless idiot zorbo {i}" for i in range(8)] + ["such a zorbo"] + [f"the container came late with vessel {w}" for w in ("alpha", "beta", "gamma")] * 8
    df = spark.createDataFrame(list(enumerate(docs)), "i int, text string")
    scored, threshold = abuse.score_corpus(df, "text", texts, [True] * 12 + [False] * 12, abuse.FmSpec(bits=18, machines=2, common=1.0, threshold=1.0))
    assert {r.i for r in scored.where(F.col("score") > threshold).collect()} == set(range(9))


def test_scores_of_a_corpus(spark):
    texts, bad = _reviewed(spark)
    docs = [texts[bad.index(False)], next(t for t, b in zip(texts, bad) if b and "idiot" in t), "", None, "12 34", "x y z", "fine. " * 50_000 + "You are a useless idiot, clerk."]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(docs)], "i int, text string, score string")
    small = abuse.FmSpec(machines=1, rounds=8, bits=18, threshold=0.4, common=0.5)
    scored, threshold = abuse.score_corpus(df, "text", texts, bad, small)
    rows = scored.orderBy("i").collect()
    assert [r.i for r in rows] == list(range(7)) and [r.score is None for r in rows] == [False, False, True, True, True, False, False]
    assert threshold == 0.4 and rows[1].score > rows[0].score and rows[5].score <= threshold < rows[6].score
    assert all(r.score is None or r.score == 0 for r in abuse.score_corpus(df, "text", texts[:1], bad[:1])[0].collect())
    assert abuse.score_corpus(df.limit(0), "text", texts, bad, abuse.FmSpec(machines=1, rounds=1))[0].count() == 0
    r = {x.source: x for x in abuse.rates(spark.createDataFrame([("a", 1.0), ("a", None), (None, 0.1)], "s string, score double"), F.col("s"), 0.4).collect()}
    assert r["a"].rate == 0.5 and r[None].n_flagged == 0


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_without_sql_runs(spark, name):
    if not (DATA / "sf0.001").exists():
        pytest.skip("no test data")
    assert queries.QUERIES[name](spark, str(DATA / "sf0.001")).count() > 0
