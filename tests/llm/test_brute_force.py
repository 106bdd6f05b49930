"""Operators without SQL against naive versions of themselves, written with plain loops."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm import DATA, brute_components, shingles

from folio.llm import html_text, langid, mixing, neardup, quality, sharding

# ---- language ID -------------------------------------------------------------------------------


def naive_probabilities(model, window):
    p, top = model.params, []
    for w in langid.WIDTHS:
        for f in range(langid.FILTERS):
            top.append(max(sum(p["embed"][window[i + k]] @ p[f"conv{w}"][k][:, f] for k in range(w)) for i in range(len(window) - w + 1)))
    hidden = np.maximum(0, np.array(top) + p["bias"])
    z = hidden @ p["dense"] + p["out"]
    return np.exp(z - z.max()) / np.exp(z - z.max()).sum()


def some_windows(n=6, size=24):
    rng = np.random.default_rng(4)
    return rng.integers(97, 123, (n, size)).astype(np.uint8), np.arange(n) % 3


def test_network_against_naive_convolution():
    x, y = some_windows()
    model = langid.fit(x, y, ["a", "b", "c"], epochs=2)
    for window, got in zip(x, model.probabilities(x), strict=True):
        assert got == pytest.approx(naive_probabilities(model, window), abs=1e-4)


def test_network_gradient_against_differences():
    """A first small Adam step goes against the sign of the loss's slope, taken by differences."""
    x, y = some_windows()
    start, moved = (langid.fit(x, y, ["a", "b", "c"], epochs=1, batch=len(x), rate=r) for r in (0.0, 1e-3))

    def loss():
        return -sum(np.log(naive_probabilities(start, w)[k]) for w, k in zip(x, y, strict=True)) / len(x)

    rng, checked = np.random.default_rng(2), 0
    for name in ("embed", "conv2", "conv3", "conv4", "dense", "out", "bias"):
        change = moved.params[name] - start.params[name]
        places = np.argwhere(np.abs(change) > 1e-4)
        for at in map(tuple, places[rng.permutation(len(places))[:3]]):
            before, table = loss(), start.params[name]
            table[at] += 1e-6
            slope = (loss() - before) / 1e-6
            table[at] -= 1e-6
            if abs(slope) > 1e-3:
                assert np.sign(slope) == -np.sign(change[at])
                checked += 1
    assert checked > 10


def test_long_texts_are_scored_as_their_windows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = langid.train(docs)
    long = "Was für ein langer Satz, und noch einer. " * 60_000
    row = langid.predict(spark.createDataFrame([(1, long)], "doc_id long, text string"), model).first()
    data = np.frombuffer(long.encode(), np.uint8)
    x, _, size = langid.windows(data, np.array([0, len(data)]))
    mean = (model.probabilities(x) * size[:, None]).sum(0) / size.sum()
    assert row.lang_pred == model.langs[int(mean.argmax())] and row.score == pytest.approx(mean.max(), abs=1e-4)


# ---- sharding ----------------------------------------------------------------------------------


def test_sharding_against_plain_loops(spark):
    df = spark.range(0, 500, 1, 3).select(F.col("id").alias("doc_id"), F.monotonically_increasing_id().alias("n"), F.xxhash64(F.monotonically_increasing_id(), F.lit(11)).alias("h"))
    rows = df.collect()
    parts = sorted({r.n >> 33 for r in rows})
    sizes = [sum(r.n >> 33 == p for r in rows) for p in parts]
    matrix = sharding.communication_matrix(sizes, 7, 11)
    want = {}
    for p, counts in zip(parts, matrix, strict=True):
        goes = [s for s, c in enumerate(counts) for _ in range(c)]
        np.random.default_rng((11, int(p))).shuffle(goes := np.array(goes, np.int32))
        for r in rows:
            if r.n >> 33 == p:
                want[r.doc_id] = (int(goes[r.n & ((1 << 33) - 1)]), r.h, r.n)
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.shuffle(spark.range(0, 500, 1, 3).withColumnRenamed("id", "doc_id"), 7, 11, block_rows=16).collect()}
    for shard in range(7):
        mine = sorted((h, n, i) for i, (s, h, n) in want.items() if s == shard)
        assert [got[i] for _, _, i in mine] == [(shard, slot) for slot in range(len(mine))]


# ---- quality -----------------------------------------------------------------------------------


def test_likelihood_and_its_gradient():
    rng = np.random.default_rng(6)
    rows = [np.unique(rng.integers(0, 12, 5)).astype(np.int32) for _ in range(40)]
    grades, weight = rng.integers(0, 3, 40), rng.uniform(0.5, 2, 40)
    fit = lambda rate: quality.fit(rows, grades, weight, epochs=1, batch=len(rows), rate=rate, decay=0.0, least=1)
    start, moved = fit(0.0), fit(1e-3)

    def loss(model):
        total = 0.0
        for r, g, w in zip(rows, grades, weight, strict=True):
            score = sum(model.weights[b] for b in r)
            above = [1.0, *(1 / (1 + np.exp(t - score)) for t in model.thresholds), 0.0]
            total -= w * np.log(above[g] - above[g + 1])
        return total / len(rows)

    bounds = np.cumsum([0, *map(len, rows)])
    at_least = moved.at_least(moved.score(np.concatenate(rows), bounds))
    for r, got in zip(rows, at_least, strict=True):
        assert got == pytest.approx([1 / (1 + np.exp(t - sum(moved.weights[b] for b in r))) for t in moved.thresholds])
    for table, change in ((start.weights, moved.weights - start.weights), (start.thresholds, moved.thresholds - start.thresholds)):
        for at in np.flatnonzero(np.abs(change) > 1e-6)[:12]:
            before = loss(start)
            table[at] += 1e-6
            slope = (loss(start) - before) / 1e-6
            table[at] -= 1e-6
            assert abs(slope) < 1e-3 or np.sign(slope) == -np.sign(change[at])
    assert loss(moved) < loss(start)


# ---- near-dedup --------------------------------------------------------------------------------


def test_linked_sets_share_a_rare_shingle():
    rng = np.random.default_rng(8)
    often = rng.integers(0, 50, neardup.COUNTERS)
    for percent in (50, 80, 90, 100):
        for _ in range(200):
            n = int(rng.integers(1, 40))
            a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
            b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 62, int(rng.integers(0, 5))).astype(np.uint64)]))
            if len(b) and 100 * len(np.intersect1d(a, b)) >= percent * len(np.union1d(a, b)):
                values, bounds = neardup.rarest(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), often, percent)
                assert set(values[: bounds[1]].tolist()) & set(values[bounds[1] :].tolist())


@pytest.mark.parametrize("common", [2, 64])
def test_pages_of_one_template(spark, monkeypatch, common):
    """Pages that share half of their text are in one region and do not link; a few of them have near copies; all ways of comparing find the same."""
    monkeypatch.setattr(neardup, "COMMON", common)
    rng = random.Random(12)
    frame = [f"t{i}" for i in range(100)]
    rows = [(i, " ".join(frame + [f"p{i}w{j}" for j in range(rng.randint(25, 60))])) for i in range(150)]
    for i in range(12):
        words = rows[i * 7][1].split(" ")
        words[3] = f"x{i}"
        rows.append((1000 + i, " ".join(words)))
    rows += [(2000 + i, " ".join([*frame[:90], f"y{i}"])) for i in range(60)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), shingle=2, percent=80).collect()
    want = brute_components(rows, 2, 80)
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(shingles(t, 2)) for i, t in rows}


# ---- mixing ------------------------------------------------------------------------------------


def test_mixing_of_more_sources_than_the_driver_plans(spark, monkeypatch):
    rng = random.Random(7)
    names = [None, "", *[f"s{i}" for i in range(40)], "ä", "z"]
    rows = [(i, rng.choice(names), "w " * rng.choice([0, 1, 5, 300])) for i in range(600)] + [(9000, "empty", None)] + [(9100 + i, "s1", "w " * 900) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    want = sorted(map(str, mixing.mix(df).collect()))
    monkeypatch.setattr(mixing, "MAX_SOURCES", 5)
    assert sorted(map(str, mixing.mix(df.repartition(3)).collect())) == want
    assert mixing.mix(df.limit(0)).count() == 0


# ---- HTML --------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<style>.h{display:none} #x, p.q > b {visibility:hidden}</style><p class=h>no</p><p id=x>no <b style='visibility:visible'>yes</b></p><p class=q>a <b>no</b> c</p>", "yes\n\na c"),
        ("<div style='visibility:hidden'>x <span style='visibility: visible'>shown</span></div>", "shown"),
        ("<style>@media print{p{display:none}} @media screen { .a .b i{display:none!important} }</style><p>p</p><div class=a><div><p class=b>k <i style='display:inline'>no</i></p></div></div>", "p\n\nk"),
        ("<style>div{display:none} div.k{display:block}</style><div>no</div><div class=k>yes</div><p hidden>no</p>", "yes"),
        ("<style>[x]{display:none} a:hover{display:none} p>{display:none} b + b{display:none}</style><p x>1 <a>2</a> <b>3</b><b>4</b></p>", "1 2 34"),
        ("<style>/* p{display:none} */ .a > .b .c{display:none}</style><div class=a><div class=b><p><i class=c>no</i> x</p></div></div><div class=b><i class=c>yes</i></div>", "x\n\nyes"),
        ("<style>p{display:none</style><p>open rule</p><style>}{}}{</style>", "open rule"),
    ],
)
def test_style_rules(page, want):
    assert html_text.extract(page) == want


# ---- pipeline ----------------------------------------------------------------------------------


def test_language_stage_against_the_network(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    odd = spark.createDataFrame([(90_000 + i, t, None, None, len(t)) for i, t in enumerate(["zq xj vv kk qq zz", "12 34", "a", "ö" * 400])], docs.schema)
    model = langid.train(docs.unionByName(odd))
    want = set()
    for r in docs.unionByName(odd).collect():
        data = np.frombuffer(r.text.encode(), np.uint8)
        x, _, size = langid.windows(data, np.array([0, len(data)]))
        if len(data) and any(c.isalpha() for c in r.text) and ((model.probabilities(x) * size[:, None]).sum(0) / size.sum()).max() >= corpus_pipeline.LEAST_SCORE:
            want.add(r.doc_id)
    assert {r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(odd), DATA).collect()} == want


def test_mixing_stage_repeats_as_the_mix_says(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    times = {r.doc_id: int(r.taken / max(1, r["size"]) + 0.5) for r in mixing.mix(docs).collect()}
    got = Counter(r.doc_id for r in corpus_pipeline.mix_sources(spark, docs, DATA).collect())
    assert got == {i: n for i, n in times.items() if n}


def test_rows_that_repeat_an_id_are_chosen_alike(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(30)
    twice = docs.unionByName(docs.withColumn("text", F.concat(F.lit("other words before "), F.reverse("text"))))
    runs = [sorted((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, twice.repartition(n), DATA).collect()) for n in (1, 4)]
    assert runs[0] == runs[1] and len({i for i, _ in runs[0]}) == len(runs[0])
