"""The n-gram join, the vector codes and the divergence audit against plain loops, and on odd input."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm import brute_components, shingles

from folio.llm import codebook, divergence, ngramjoin

# ---- n-gram join -------------------------------------------------------------------------------


def crowd(rng):
    """Near copies with none to many words changed, a chain that drifts away, short texts around the smallest sizes that can link."""
    rows = []
    base = [f"w{rng.randint(0, 4000)}" for _ in range(140)]
    for i in range(90):
        copy = list(base)
        for _ in range(i % 9):
            copy[rng.randrange(len(copy))] = f"n{i}-{rng.randint(0, 99)}"
        rows.append((1000 + i, " ".join(copy)))
    chain = [f"c{j}" for j in range(200)]
    for i in range(40):
        rows.append((2000 + i, " ".join(chain)))
        chain[i * 4 : i * 4 + 2] = [f"d{i}-{j}" for j in range(2)]
    for n in range(1, 16):
        rows += [(3000 + 2 * n, " ".join(f"s{j}" for j in range(n))), (3001 + 2 * n, " ".join(f"S{j}" for j in range(n + 1)))]
    return rows


@pytest.mark.parametrize(("block", "many"), [(1024, 4), (7, 4), (16, 0)])
def test_join_against_brute_force(spark, docs, odd, monkeypatch, block, many):
    monkeypatch.setattr(ngramjoin, "BLOCK", block)
    monkeypatch.setattr(ngramjoin, "MANY", many)
    rows = [(r.doc_id, r.text) for r in docs.limit(60).collect()] + crowd(random.Random(9))
    rows += [(r.doc_id, r.text) for r in odd.collect() if r.text is None or len(r.text) < 100_000] + [(1000, "another text under one id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({n: F.lit("own") for n in ("ID", "n", "tile", "comp")})
    for percent in (90, 80):
        got = ngramjoin.similar_sets(df, shingle=3, percent=percent).collect()
        want = brute_components(rows, 3, percent)
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter((i, len(shingles(t, 3)), want.get(i)) for i, t in rows)
    assert len({want[i] for i, _ in rows if i and 1000 <= i < 1090}) < 90


def test_linked_sets_share_a_tile_and_pass_the_bound():
    rng = np.random.default_rng(3)
    for percent in (90, 80, 70):
        for n in [1, 2, 5, 9, 10, 11, 20, 37, 100, 333, 2000] * 6:
            whole = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
            least = -(-percent * n // 100)  # a subset of so many links with it; so does a set with as many changed as that allows
            other = np.sort(np.concatenate([whole[rng.permutation(n)[: rng.integers(least, n + 1)]], rng.integers(1 << 63, (1 << 64) - 1, rng.integers(0, max(1, n // 20)), np.uint64)]))
            shared = ngramjoin.overlap(whole, other)
            assert shared == len(set(whole.tolist()) & set(other.tolist()))
            if not ngramjoin.enough(len(whole), len(other), shared, percent):
                continue
            a, b = ngramjoin.signature(whole), ngramjoin.signature(other)
            words = min(len(a), len(b))
            differ = int(np.bitwise_count(ngramjoin.folded(a, words) ^ ngramjoin.folded(b, words)).sum())
            assert (len(whole) + len(other) - differ) // 2 >= shared
            keys, at = ngramjoin.slices(np.concatenate([whole, other]), np.array([0, len(whole), len(whole) + len(other)]), percent)
            assert len(whole) == len(other) == shared or set(keys[: at[1]].tolist()) & set(keys[at[1] :].tolist())


def test_sets_with_empty_parts_share_a_tile(monkeypatch):
    """With far more parts than shingles nearly all parts are empty, and still no pair is missed."""
    bands = ngramjoin.bands
    monkeypatch.setattr(ngramjoin, "bands", lambda percent: (lambda low, d, p: (low, d, np.where(d > 0, 40 * p, 0)))(*bands(percent)))
    rng = np.random.default_rng(1)
    for n in [10, 12, 30] * 20:
        whole = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        keys, at = ngramjoin.slices(np.concatenate([whole, whole[1:]]), np.array([0, n, 2 * n - 1]), 90)
        assert set(keys[: at[1]].tolist()) & set(keys[at[1] :].tolist())


def test_join_on_empty_tables_and_nulls(spark, odd):
    assert ngramjoin.similar_sets(odd.limit(0)).count() == 0
    got = ngramjoin.similar_sets(odd.filter("text IS NULL OR trim(text) = ''")).collect()
    assert got and all(r.n_shingles == 0 and r.component_id == r.doc_id for r in got if r.doc_id != 4)


# ---- vector codes ------------------------------------------------------------------------------


def whole_vector(v):
    """floor(4096 x) of each component, filled up to a multiple of 8; None if the vector takes no part."""
    if v is None or any(c is None or math.isnan(c) or math.isinf(c) for c in v):
        return None
    return [math.floor(Fraction(c) * 4096) for c in v] + [0] * (-len(v) % 8)


def plain_codes(rows):
    """(vec_id, code, error, label_error, digest) of rows (vec_id, vector, label), each length for itself."""
    by_length, out = defaultdict(list), []
    for i, v, label in rows:
        if whole_vector(v) is not None:
            by_length[len(v)].append((i, v, label, whole_vector(v)))
    for some in by_length.values():
        some.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        width = len(some[0][3]) // 8
        part = lambda w, p: w[p * width : (p + 1) * width]  # noqa: B023, E731
        book = [[part(r[3], p) for r in some[:16]] for p in range(8)]
        far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
        best = lambda x, entries: min((far(x, e), k) for k, e in enumerate(entries))
        for _ in range(6):
            for p in range(8):
                took = defaultdict(list)
                for r in some:
                    took[best(part(r[3], p), book[p])[1]].append(part(r[3], p))
                book[p] = [[sum(c) // len(took[k]) for c in zip(*took[k], strict=True)] if k in took else e for k, e in enumerate(book[p])]
        digest = hashlib.sha256(",".join(str(c) for p in book for e in p for c in e).encode()).hexdigest()
        for i, _, label, w in some:
            found = [best(part(w, p), book[p]) for p in range(8)]
            out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label, digest))
    total = Counter()
    for r in out:
        total[r[3]] += r[2]
    most = (1 << 63) - 1
    return Counter((i, code, min(error, most), min(sum(min(r[2], most) for r in out if r[3] == label), most), digest) for i, code, error, label, digest in out)


def vectors(rng, n=200, size=16):
    return [(i, [rng.gauss(0, 0.4) for _ in range(size)], rng.choice([0, 1, 2, None])) for i in range(n)]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_codes_against_plain_loops(spark, kind):
    rng = random.Random(4)
    rows = vectors(rng) + [(300, None, 1), (301, [None] * 16, 1), (302, [float("nan")] * 16, 1), (303, [float("-inf")] + [0.0] * 15, 0), (None, [0.1] * 16, 1), (5, [0.2] * 16, 1), (5, [0.2] * 16, 1)]
    rows += [(400 + i, [rng.gauss(0, 1) for _ in range(5)], 3) for i in range(20)] + [(500, [], 3), (501, [0.25], None)]  # lengths of their own
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").withColumns({n: F.lit("own") for n in ("Code", "error", "dim", "key")}).repartition(5)
    got = codebook.compress(df)
    as_read = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert Counter(map(tuple, got.collect())) == plain_codes(as_read)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_codes_of_vectors_of_any_magnitude(spark):
    rng = random.Random(6)
    rows = vectors(rng, 60, 8) + [(100 + i, [rng.choice([-1, 1]) * 10.0 ** rng.randint(0, 38) for _ in range(8)], 1) for i in range(60)] + [(i, [3e38] * 8, 1) for i in (-1, 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    assert Counter(map(tuple, codebook.compress(df).collect())) == plain_codes(rows)


def test_codes_of_few_rows_and_of_none(spark):
    df = spark.createDataFrame(vectors(random.Random(1), 3), "vec_id long, embedding array<float>, label int")
    assert {r.error for r in codebook.compress(df).collect()} == {0}
    assert codebook.compress(df.limit(0)).count() == 0
    kept = codebook.encode(df.withColumn("Error", F.lit("own")), codebook.train(df))
    assert kept.columns == ["vec_id", "embedding", "label", "code", "error"]


# ---- divergence audit --------------------------------------------------------------------------


def plain_audit(rows, least_docs):
    docs = [tuple(x or "" for x in r) for r in rows]
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate({c: c + 32 for c in range(65, 91)})) for t, _, _ in docs]
    out = []
    for lang in {d[1] for d in docs}:
        own = [(d[2], w) for d, w in zip(docs, words, strict=True) if d[1] == lang]
        held = Counter(t for _, w in own for t in set(w))
        kept = {t for t, n in held.items() if n >= least_docs}
        counts = defaultdict(Counter)
        for source, w in own:
            counts[source].update(t for t in w if t in kept)
        total = sum(counts.values(), Counter())

        def share(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))  # noqa: B023

        for a in counts:
            f = lambda p, q: (p - q) ** 2 // (p + q)
            pair = [(b, sum(f(share(counts[a], t), share(counts[b], t)) for t in kept)) for b in counts if b != a]
            term = [(t, f(share(counts[a], t), share(total, t))) for t in kept if counts[a][t] and share(counts[a], t) > share(total, t)]
            for part, found, most in (("pair", pair, None), ("term", term, 10)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, a, part, item, value, n + 1) for n, (item, value) in enumerate(ranked)]
    return sorted(out)


@pytest.mark.parametrize(("sources", "terms", "held"), [(32, 2048, 400_000), (3, 16, 50)])
def test_audit_against_plain_loops(spark, docs, odd, monkeypatch, sources, terms, held):
    for name, value in (("SOURCES", sources), ("TERMS", terms), ("HELD", held), ("PIECE", 1 << 12)):
        monkeypatch.setattr(divergence, name, value)
    rows = [(r.text, r.lang, r.source) for r in docs.select("text", "lang", "source").union(odd.filter("length(text) < 1000 OR text IS NULL").select("text", "lang", "source")).collect()]
    rows += [(None, None, "only"), ("", "xx", "a"), ("no kept terms here", "xx", "b"), ("Über-Maß ÜBER é", "de", "ÿ"), ("a\x00b\x7fc", "en", "")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumns({n: F.lit("own") for n in ("term", "N", "block", "value")}).repartition(4)
    for least in (10, 2):
        got = sorted(tuple(r) for r in divergence.audit(df, least_docs=least).collect())
        assert got == plain_audit(rows, least)


def test_audit_of_nothing(spark, odd):
    assert divergence.audit(odd.limit(0)).count() == 0


def test_terms_and_exact_shares():
    data = "Ab1c\x00é-Z".encode(), b"", "zÜ".encode()
    at = np.cumsum([0, *map(len, data)])
    found, row = divergence.terms(np.frombuffer(b"".join(data), np.uint8), at)
    assert found.to_pylist() == ["ab", "c", "é", "z", "zÜ"] and row.tolist() == [0, 0, 0, 0, 2]
    rng = random.Random(3)
    for _ in range(300):
        n, v = rng.randint(0, 10 ** rng.randint(0, 15)), rng.randint(1, 10**7)
        c = rng.randint(0, n)
        assert divergence.shares(np.array([[c]]), np.array([n]), v)[0, 0] == 1 + 10**9 * (c + 2) // (n + 2 * v)
