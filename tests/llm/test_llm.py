"""The training-data operators against brute force, round trips and held-out rows, and on odd input."""

from __future__ import annotations

import itertools
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from folio.llm import decontam, graph, html_text, langid, mixing, neardup, pii, quality, queries, sharding, tokencount, topk
from folio.llm.common import word_hashes, words

DATA = "/root/testdata/sf0.001"


# ---- language ID -------------------------------------------------------------------------------


def test_language_held_out(spark):
    rows = queries.op1_language_id(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


def test_language_odd_input(spark, odd):
    model = langid.train(odd.filter("doc_id IS NOT NULL"))
    rows = langid.predict(odd, model).collect()
    assert len(rows) == 12
    for r in rows:
        assert (r.lang_pred == "und") == (r.text is None or not re.search(r"[^\W\d_]", r.text)) and 0 <= r.score <= 1
    empty = langid.train(odd.limit(0))
    assert {r.lang_pred for r in langid.predict(odd, empty).collect()} == {"und"}
    assert langid.predict(odd.limit(0), model).count() == 0


def test_windows_cover_all_bytes():
    data, at = np.arange(1000).astype(np.uint8), np.array([0, 0, 600, 1000])
    x, row, size = langid.windows(data, at)
    assert size.tolist() == [256, 256, 88, 256, 144] and row.tolist() == [1, 1, 1, 2, 2] and (x[2, 88:] == 32).all()


# ---- sharding ----------------------------------------------------------------------------------


def check_shards(rows, shards):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    sizes = [len(by[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(by[s]) == list(range(len(by[s]))) for s in by)


def test_sharding(spark, docs, odd):
    out = sharding.shuffle(docs.repartition(5), 16, block_rows=4)
    rows = out.collect()
    check_shards(rows, 16)
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    rows = sharding.shuffle(odd, 5).collect()
    check_shards(rows, 5)
    assert Counter(r.text for r in rows) == Counter(r.text for r in odd.collect())
    assert sharding.shuffle(odd.limit(0), 3).count() == 0


def test_sharding_shuffles_the_texts(spark, monkeypatch):
    seen, shuffle = [], sharding.shuffle
    monkeypatch.setattr(sharding, "shuffle", lambda df, *how: seen.append(df.columns) or shuffle(df, *how))
    rows = queries.op2_sharding(spark, DATA).collect()
    assert {"doc_id", "text", "lang", "source"} <= set(seen[0])
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert len(rows) == len(texts) and all((r.size, r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id])) for r in rows)


def test_sharding_is_uniform(spark):
    # the first row's shard and the neighbours of a row are as in a uniform shuffle
    seen = Counter()
    base = spark.range(0, 40, 1, 4).cache()
    for seed in range(24):
        rows = sharding.shuffle(base, 4, seed=seed).collect()
        seen.update(r.shard for r in rows if r.id < 10)
    assert all(40 <= seen[s] <= 80 for s in range(4)), seen


def test_communication_matrix():
    sizes = [5, 0, 17, 9]
    m = sharding.communication_matrix(sizes, 4, 1)
    assert m.sum(1).tolist() == sizes and m.sum(0).tolist() == [8, 8, 8, 7]
    rng = np.random.default_rng(0)
    big = [sharding.hypergeometric(rng, 6 * 10**9, 4 * 10**9, 10_000) for _ in range(400)]
    assert abs(np.mean(big) - 6000) < 12 and 30 < np.std(big) < 70
    small = [sharding.hypergeometric(rng, 30, 10**9, 10**8) for _ in range(2000)]
    assert abs(np.mean(small) - 30 * 10**8 / (10**9 + 30)) < 0.2


# ---- PII ---------------------------------------------------------------------------------------

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_spans(text):
    def good(kind, s):
        digits = re.sub("[^0-9]", "", s)
        luhn = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0
        return [True, kind == 1 and all(int(p) <= 255 for p in s.split(".")), 13 <= len(digits) <= 19 and luhn, 9 <= len(digits) <= 15][kind]

    return [[m.span() for m in re.finditer(p, text) if good(k, m.group())] for k, p in enumerate(PATTERNS)]


def test_base_spans_against_patterns():
    rng = random.Random(4)
    for _ in range(4000):
        text = "".join(rng.choice(["a", "b1", "12", "200", ".", ".", " ", "@", "+", "-", "(", ")", "é", "4111 1111 1111 1111"]) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_patterns_are_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1.1." * 80_000, "a@" * 100_000, "+1 (" * 80_000):
        pii.base_spans(text)


def test_field_on_new_rows():
    field = pii.train()
    rows = pii.labelled_rows(200, seed=77)
    got = pii.decode(field, [t for t, _ in rows], [[(0, len(t))] for t, _ in rows])
    right = sum(sorted(g) == sorted((pii.KINDS.index(k), s, e) for s, e, k in spans) for g, (_, spans) in zip(got, rows, strict=True))
    assert right >= 190


def test_long_ranges_are_decoded_in_pieces(monkeypatch):
    """The spans are those of whole ranges, wherever the pieces meet, and a batch never holds more tokens than it may."""
    field, rng = pii.train(), random.Random(5)
    rows = [" ".join(rng.choice([f"{rng.randint(0, 99999)}", f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}", f"{rng.random():.3f}", "anna at example dot com", "and"]) for _ in range(n)) for n in (1, 60, 900, 2500)]
    whole = [[(0, len(t))] for t in rows]
    monkeypatch.setattr(pii, "PIECE", 1 << 20)
    want = [sorted(f) for f in pii.decode(field, rows, whole)]
    monkeypatch.setattr(pii, "TOKENS", 3000)
    seen, viterbi = [], field.viterbi
    field.viterbi = lambda ids, mask: seen.append(mask.size) or viterbi(ids, mask)
    for size in (200, 1024):
        monkeypatch.setattr(pii, "PIECE", size)
        assert [sorted(f) for f in pii.decode(field, rows, whole)] == want
    assert max(seen) <= 3000 and sum(map(len, want)) > 500


def test_pii_odd_input(spark, odd):
    rows = [(20, "mail jo.doe@x.example.com or 10.0.0.7, call (555) 010-1234 now", "en", "a", 1), (21, "write to jo at mail dot com today", "en", "a", 1)]
    more = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in pii.find(odd.select("doc_id", "text", "spans").unionByName(more.select("doc_id", "text", F.lit("x").alias("spans")))).collect()}
    assert out[20].base == "email:5:25,ip:29:37" and out[20].spans == "email:5:25,ip:29:37,phone:44:58"
    assert (out[2].n_email, out[2].spans, out[3].spans, out[6].spans) == (0, "", "", "")
    assert "email" in out[21].spans and out[21].n_email == 0
    assert pii.find(odd.limit(0)).count() == 0


def test_pii_on_any_sign(spark):
    """Digits of other scripts, raised and circled ones, combining marks and wide letters beside triggers."""
    odd = [chr(c) for c in range(0x20, 0x30000, 37) if not 0xD800 <= c <= 0xDFFF] + list("²³¹①⑳٣७Ⅷ𝟘½")
    texts = ["flat of 85² m"] + [f"call 555{c}010{c} 1234 {c}@x.org a dot {c}7" for c in odd] + ["".join(odd[i : i + 9]) + "5" for i in range(0, len(odd), 9)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.find(df).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = [f"{k}:{s}:{e}" for k, spans in zip(pii.KINDS, plain_spans(r.text), strict=True) for s, e in spans]
        assert r.base == ",".join(want) and set(want) <= set(r.spans.split(",")) | {""}


def random_field(rng):
    field = pii.Field()
    field.weights = rng.normal(0, 1, field.weights.shape)
    field.moves = rng.normal(0, 1, field.moves.shape)
    return field


def path_score(field, ids, tags):
    e = field.emissions(ids[None], np.ones((1, len(ids)), bool))[0]
    moves = field.moves + field.barred
    return field.first[tags[0]] + sum(e[i, t] for i, t in enumerate(tags)) + sum(moves[a, b] for a, b in zip(tags, tags[1:], strict=False))


def test_viterbi_against_enumeration():
    rng, k = np.random.default_rng(1), len(pii.TAGS)
    for n in (1, 2, 4):
        field, ids = random_field(rng), rng.integers(0, pii.N_FEATURES - 1, (6, n, 5))
        got = field.viterbi(ids, np.ones((6, n), bool))
        for x, tags in zip(ids, got, strict=True):
            every = [(path_score(field, x, p), p) for p in np.ndindex(*[k] * n)]
            assert path_score(field, x, tuple(tags)) == pytest.approx(max(every)[0]) and tuple(tags) == max(every)[1]


def test_field_gradient_against_enumeration():
    """One small Adam step goes along the sign of the likelihood's gradient, which is taken from all tag sequences."""
    rng, k, n = np.random.default_rng(3), len(pii.TAGS), 3
    ids, tags = rng.integers(0, 30, (2, n, 5)), np.array([[1, 2, 0], [0, 3, 4]])
    mask = np.ones((2, n), bool)

    def likelihood(field):
        total = 0.0
        for x, t in zip(ids, tags, strict=True):
            scores = np.array([path_score(field, x, p) for p in np.ndindex(*[k] * n)])
            total += path_score(field, x, tuple(t)) - np.logaddexp.reduce(scores)
        return total

    field = random_field(rng)
    before = field.weights.copy(), field.moves.copy()
    start = likelihood(field)
    places = [(0, (pii.REACH, int(ids[0, 0, 0]), 1)), (0, (pii.REACH + 1, int(ids[1, 2, 1]), 3)), (1, (1, 2)), (1, (0, 3)), (1, (2, 0))]
    slopes = []
    for which, at in places:
        table = (field.weights, field.moves)[which]
        table[at] += 1e-5
        slopes.append((likelihood(field) - start) / 1e-5)
        table[at] -= 1e-5
    field.train(ids, mask, tags, steps=1, rate=1e-3, decay=0.0)
    moved = [((field.weights, field.moves)[which][at] - before[which][at]) for which, at in places]
    assert all(abs(g) > 1e-4 and np.sign(g) == np.sign(m) for g, m in zip(slopes, moved, strict=True))
    assert likelihood(field) > start


# ---- quality -----------------------------------------------------------------------------------


def test_quality_held_out(spark):
    data = DATA.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    held = F.col("doc_id") % 3 == 0
    rows = quality.grade(docs, quality.train(docs, labels.filter(~held))).join(labels.filter(held), "doc_id").collect()
    share = lambda some: sum(r.selected for r in some) / len(some)
    # some labels are noise: texts without any word that others of their label share
    insults = re.compile(r"\b(?:idiot|moron|scum|clown|worthless|trash|pathetic|stupid|loser|disgusting)\b")
    toxic = [r for r in rows if len(insults.findall(r.text)) > 2]
    assert share([r for r in rows if r.quality == 1 and r.toxic == 0]) >= 0.94
    assert len(toxic) > 50 and share(toxic) <= 0.08 and np.mean([r.expected_grade for r in toxic]) < 0.8
    assert share([r for r in rows if r.quality == 0 and r.toxic == 0]) <= 0.3


def test_quality_odd_input(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (7, 0, None), (None, 1, 1), (8, None, 1), (6, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality.grade(odd, quality.train(odd, labels)).collect()
    assert len(rows) == 12 and all(0 <= r.expected_grade <= 2 and 0 <= r.tail_prob <= 1 for r in rows)
    assert all((r.tail_prob, r.selected) == (0, False) for r in rows if not (r.text or "").strip())
    assert quality.grade(odd, quality.train(odd, labels.limit(0))).count() == 12


def test_thresholds_ascend():
    rng = np.random.default_rng(1)
    rows = [rng.integers(0, 50, 5).astype(np.int32) for _ in range(300)]
    grades = np.array([min(2, int(r.min()) // 6) for r in rows])
    model = quality.fit(rows, grades, np.ones(300))
    assert (np.diff(model.thresholds) > 0).all()
    bounds = np.cumsum([0, *map(len, rows)])
    expected = model.at_least(model.score(np.concatenate(rows), bounds)).sum(1)
    assert expected[grades == 2].mean() > expected[grades == 0].mean() + 1


# ---- near-dedup --------------------------------------------------------------------------------


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: root(i) for i in parent}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_against_brute_force(spark, docs, odd, k):
    rng, rows = random.Random(9), [(r.doc_id, r.text) for r in docs.limit(60).collect()]
    base = [f"w{rng.randint(0, 4000)}" for _ in range(120)]
    for i in range(80):  # a crowded group of copies with single words changed, and a chain that drifts away
        copy = list(base)
        for _ in range(i % 6):
            copy[rng.randrange(len(copy))] = f"n{i}-{rng.randint(0, 99)}"
        rows.append((1000 + i, " ".join(copy)))
    chain = [f"c{j}" for j in range(150)]
    for i in range(30):
        rows.append((2000 + i, " ".join(chain)))
        chain[i * 4 : i * 4 + 3] = [f"d{i}-{j}" for j in range(3)]
    rows += [(r.doc_id, r.text) for r in odd.collect() if r.text is None or len(r.text) < 100_000] + [(1000, "another text under one id"), (3000, "Another TEXT under one id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = neardup.near_duplicates(df, shingle=k).collect()
    want = brute_components(rows, k, 80)
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id == r.component_id)
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((i, len(shingles(t, k))) for i, t in rows)


def test_near_duplicates_empty(spark, odd):
    assert neardup.near_duplicates(odd.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)] + [(500 + i, 501 + i) for i in range(40)] + [(900, 900)] + [(700, 700 + i) for i in range(1, 60)]
    parent = list(range(1000))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for p in pairs for x in p if p[0] != p[1]}


def test_word_hashes_depend_on_the_word_only():
    data = np.frombuffer(b"alpha beta  alpha\tgamma alph a", np.uint8)
    start, end, row = words(data, np.array([0, 11, len(data)]))
    h = word_hashes(data, start, end, block=7)
    assert h[0] == h[2] and len(set(h.tolist())) == 5 and row.tolist() == [0, 0, 1, 1, 1, 1]


# ---- mixing ------------------------------------------------------------------------------------


def test_water_filling():
    assert mixing.water_fill([10, 10, 80], [1, 1, 1], 3) == [30.0, 30.0, 40.0]
    assert sum(mixing.water_fill([1, 5, 994], [5, 2, 1], 3)) == 1000
    assert mixing.water_fill([0, 0], [5, 2], 3) == [0.0, 0.0]
    assert mixing.water_fill([], [], 3) == []


def test_mixing(spark, docs, odd):
    for df in (docs, odd.drop("size")):
        rows = mixing.mix(df, bucket_rows=8).collect()
        by, target = defaultdict(list), {}
        for r in rows:
            assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) and 0 <= r.taken <= 3 * r.size
            by[r.source].append(r)
            target[r.source] = (r.target, r.source_size)
        for s, group in by.items():
            assert sum(r.taken for r in group) == int(target[s][0]) and target[s][1] == sum(r.size for r in group)
            assert target[s][0] <= 3 * target[s][1]
        assert sum(t for t, _ in target.values()) == pytest.approx(sum(r.size for r in rows))
        again = mixing.mix(df.repartition(3), bucket_rows=8).collect()
        assert Counter((r.doc_id, r.size, r.taken) for r in rows) == Counter((r.doc_id, r.size, r.taken) for r in again)
    assert mixing.mix(odd.limit(0)).count() == 0


# ---- decontamination ---------------------------------------------------------------------------


def test_leaks_against_verbatim_search(spark):
    docs, items = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(docs, items).collect()}
    bench = [(r.item_id, r.text) for r in items.collect()]
    want = {(r.doc_id, i) for r in docs.collect() for i, t in bench if t in r.text}
    assert got == want and want


def test_leaks_with_other_values(spark):
    item = "A train leaves the old station with Alice aboard at 40 km per hour and Bob follows it after 3 hours at 60 km per hour so when does Bob meet Alice if both keep 60 km steady?"
    told = item.replace("Alice", "Maria Silva").replace("Bob", "Chen").replace("60", "75").replace("40 km", "55 km")
    mixed = item.replace("Bob follows", "Chen follows").replace("does Bob", "does Ivan").replace("60 km per", "75 km per").replace("60 km steady", "91 km steady").replace("if both", "if they")
    rows = [(1, f"Some lead text here. {told} And more."), (2, f"x {item}"), (3, "A train leaves the old station early."), (4, None), (5, ""), (None, item), (6, " ".join(["The 5 km run"] * 3000)), (7, item.upper()), (2, f"x {item}"), (8, mixed)]
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "too short"), (5, "five small words stand here"), (None, item)], "item_id long, text string")
    docs = spark.createDataFrame([*rows, (9, "before five small words stand here after")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.leaks(docs, items).collect()}
    assert {(1, 1), (2, 1), (9, 5)} <= set(got) and not {k for k in got if k[0] in (3, 4, 5, 6)}
    assert got[1, 1].slots > 0 and got[1, 1].slots_kept == got[1, 1].slots
    kept = sorted(str(r.doc_id) for r in decontam.clean(docs, items).collect())
    assert "None" in kept and "1" not in kept and "3" in kept
    assert decontam.leaks(docs.limit(0), items).count() == 0 and decontam.leaks(docs, items.limit(0)).count() == 0


def test_leaks_of_numbers_names_and_short_items(spark, monkeypatch):
    texts = {1: "Compute 12 + 7 * 3 - 4", 2: "12 15 18 21 24 27 30 33 36 39", 3: "Ask Anna Berg, Carl Dorn, Emil Falk, Gert Holm, Ines Jung and Karl Lind", 4: "Paris or Rome?", 5: "xylem", 6: "Water boils at high heat in open pans"}
    lead, tail = "As John Smith wrote to Mary Jones: ", " (see 5 and 6) he said."
    docs = [(i, lead + t + tail) for i, t in texts.items()] + [(10, "Compute 12 + 8 * 3 - 4"), (11, "Carl Dorn saw Paris, then Rome"), (12, "12 15 18 and 33 36 39"), (13, texts[3].upper().replace(" ", "\n"))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([*texts.items(), (7, "+ - *"), (8, "")], "item_id long, text string")
    want = {(i, i) for i in texts} | {(13, 3)}
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(df, items).collect()} == want
    assert sorted(r.doc_id for r in decontam.clean(df, items).collect()) == [10, 11, 12]
    monkeypatch.setattr(decontam, "MOST_SENT", 0)
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(df, items).collect()} == want


def template_by_rule(text):
    """Tokens as (what they match by, value of a slot or None), and the literal tokens; word by word."""
    found = [(m.group(), m.start(), m.end()) for m in regex.finditer(r"(?:[\p{L}\p{M}\p{N}]|(?<=\p{Nd})[.,](?=\p{Nd}))+", text)]
    out, last = [], 0
    for w, s, e in found:
        gap = regex.sub(r"(?<=\p{Nd})[.,](?=\p{Nd})", "", text[last:s])
        first = not out or re.search(r"[.!?\n]", gap)
        if w[0].isdecimal():
            out.append(("<n>", w))
        elif out and out[-1][0] == "<n>" and w.lower() in decontam.UNITS:
            out.append(("<u>", w))
        elif len(w) > 1 and w[0].isupper() and w[1:].islower():
            if out and out[-1][0] == "<p>" and not first:
                out[-1] = ("<p>", out[-1][1] + " " + w)
            else:
                out.append(("<p>", w))
        else:
            out.append((w.lower(), None))
        last = e
    return out, [(w.lower(), None) for w, *_ in found]


def holds(text, item):
    """Whether the text holds the item, by trying all places and alignments."""
    for mine, its, literally in zip(template_by_rule(text), template_by_rule(item), (False, True), strict=True):
        size = min(decontam.WINDOW, len(its))
        windows = [i for i in range(len(its) - size + 1) if size and (literally or sum(v is None for _, v in its[i : i + size]) >= decontam.LEAST)]
        if not windows:
            continue
        near = max(decontam.NEAR, -(-len(windows) // 2))
        met = [(i, j) for i in windows for j in range(len(mine) - size + 1) if [k for k, _ in its[i : i + size]] == [k for k, _ in mine[j : j + size]]]
        bands = defaultdict(list)
        for i, j in met:
            for half in (0, 1):
                bands[(j - i + half * near) // (2 * near), half].append((i, j))
        for some in bands.values():
            pairs = Counter((its[i + n][1], mine[j + n][1]) for i, j in some for n in range(size) if its[i + n][1] is not None)
            forth, back = defaultdict(list), defaultdict(list)
            for (a, b), c in pairs.items():
                forth[a].append(c)
                if not b[0].isdigit():
                    back[b].append(c)
            total = sum(pairs.values())
            kept = min(sum(map(max, forth.values())), total - sum(sum(x) - max(x) for x in back.values()))
            if kept >= 0.8 * total and len({i for i, _ in some}) >= 0.5 * len(windows):
                return True
    return False


def test_templates_against_brute_force(spark):
    rng = random.Random(12)
    people, places, units = ["Alice", "Bob", "Chen Wu", "Maria Silva", "Ivan", "Zoe", "Łukasz", "Анна", "Ólafur Þór"], ["Paris", "Oslo", "New York"], ["km", "kg", "dollars", "minutes"]
    frames = [
        "{p} buys {n} apples for {n} {u} each", "{p} walks from {c} to {c} in {n} {u} and then {p} rests for {n} {u} before going home", "If {p} has {n} red balls and {q} takes {n} of them, how many are left for {p}?",
        "Compute {n} + {n} * {n} - {n} / {n}", "Is {n} plus {n} equal {n}?", "Capital of {c}?", "{p}, {q} and {p}", "A pump fills the long tank in {n} {u}. {p} opens it at {n}. When will {q} find the tank full of water?",
    ]

    def fill(frame, fixed=None):
        own = fixed or {"p": rng.choice(people), "q": rng.choice(people), "c": rng.choice(places)}
        return re.sub(r"\{(.)\}", lambda m: own[m[1]] if m[1] in own else rng.choice(units) if m[1] == "u" else str(rng.randint(2, 99)), frame)

    items = [fill(f) for f in frames for _ in range(2)]
    docs = []
    for n in range(150):
        text = fill(rng.choice(frames)) if n % 3 else rng.choice(items)
        parts = text.split(" ")
        if n % 5 == 1:  # a word put in, or the text cut
            parts.insert(rng.randrange(len(parts)), "very")
        if n % 7 == 2:
            parts = parts[: len(parts) // 2]
        if n % 11 == 3:  # scattered halves
            parts = parts[: len(parts) // 2] + ["filler"] * 60 + parts[len(parts) // 2 :]
        if n % 4 == 1:  # as typesetters write it
            text = " ".join(parts).replace(", ", " — ").replace(" ", rng.choice(["\u00a0", "\u2009", " "]))
            parts = ["“" + text + "”…"]
        docs.append(rng.choice(["", "some lead words here. ", "Then "]) + " ".join(parts) + rng.choice(["", ". And more of it."]))
    want = {(i, j) for i, d in enumerate(docs) for j, t in enumerate(items) if holds(d, t)}
    df, bench = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(df, bench).collect()}
    assert got == want and len(want) > 60
    told = {i for i, d in enumerate(docs) for j, t in enumerate(items) if (i, j) in got and t not in d}
    assert len(told) > 20


@pytest.mark.parametrize(
    ("item", "text", "held"),
    [
        ("Capital of France?", "He asked: “Capital of France?” again", True), ("Capital of France?", "He asked—capital of\u00a0France…", True), ("Capital of France?", "«Cap\u00adital of\u2009France»", True),
        ("don't stop", "Don’t stop!", True), ("Столица Франции?", "Он спросил: «столица Франции?»", True), ("Ποια είναι η πρωτεύουσα", "ΠΟΙΑ ΕΊΝΑΙ Η ΠΡΩΤΕΎΟΥΣΑ", True), ("Capital of France", "capital of Francés", False),
        ("Łukasz ma pięć czerwonych jabłek i oddaje 3 z nich", "Paweł ma pięć czerwonych jabłek i oddaje 7 z nich", True), ("Анна купила красные яблоки и 12 зелёных груш", "Ольга купила красные яблоки и 40 зелёных груш", True), ("𠀀𠀁 𠀂", "x 𠀀𠀁 – 𠀂 y", True),
    ],
)
def test_signs_of_any_script(spark, item, text, held):
    found = decontam.leaks(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(5, item)], "item_id long, text string"))
    assert found.count() == held


def test_signs_are_code_points():
    rng = random.Random(4)
    texts = ["", "a", "é\u00ad–", "\u200b", "日本𠀀x", "".join(chr(rng.choice([rng.randrange(32, 0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(3000))]
    data = [t.encode() for t in texts]
    point, at = decontam.signs(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    kept = [[ord(c) for c in t if unicodedata.category(c) != "Cf" or ord(c) >= 0x20000] for t in texts]
    assert [point[i:j].tolist() for i, j in itertools.pairwise(at)] == kept
    low = [c for t in kept for c in t if c < 0x20000]
    for c in low:
        assert bool(decontam._is(np.array([c]), decontam._INSIDE)[0]) == (unicodedata.category(chr(c))[0] in "LMN")


def test_first_words_scattered_pieces_and_two_way_slots(spark):
    long = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40)) + " Anna and Bert and Carl and Anna and Bert and Carl end here now with all of this"
    parts = long.split(" ")
    rows = [
        (1, "Bob buys 5 apples for 4 dollars each"), (2, "Is 3 plus 4 equal 7?"), (3, "Capital of France?"), (4, "Compute 12 + 7 * 3 - 4 / 2"), (5, "Bob buys 4 apples for 4 dollars each"),
        (6, " filler ".join(" ".join(parts[i : i + 9]) + " x" * 200 for i in range(0, len(parts), 9))), (7, long.replace("Bert", "Anna").replace("Carl", "Anna")), (8, long.replace("Bert", "Dora").replace("Carl", "Emil")), (9, "Capital of Spain?"),
    ]
    items = [(1, "Alice buys 3 apples for 2 dollars each"), (2, rows[1][1]), (3, rows[2][1]), (4, rows[3][1]), (5, long), (5, "another text under the same id that is as long"), (6, "Anna Bert")]
    got = {(r.doc_id, r.item_id) for r in decontam.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {(1, 1), (2, 2), (3, 3), (4, 4), (5, 1), (8, 5)} <= got and not {(6, 5), (9, 3)} & got


def test_both_ways_of_joining_agree(spark, monkeypatch):
    docs, items = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/benchmark.parquet")
    a = sorted(map(tuple, decontam.leaks(docs, items).collect()))
    monkeypatch.setattr(decontam, "MOST_SENT", 0)
    assert sorted(map(tuple, decontam.leaks(docs, items).collect())) == a


# ---- HTML --------------------------------------------------------------------------------------


class Words(HTMLParser):
    """All text outside script, style and title, with block tags as spaces."""

    def __init__(self):
        super().__init__()
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "title")
        self.out.append(" " if tag in html_text.BLOCKS or tag == "br" else "")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "title")
        self.out.append(" " if tag in html_text.BLOCKS else "")

    def handle_data(self, data):
        self.out.append("" if self.skip else data)


def test_all_visible_words_in_order(spark):
    for r in queries.op8_html_text(spark, DATA).join(spark.read.parquet(f"{DATA}/pages.parquet"), "page_id").collect():
        p = Words()
        p.feed(r.html)
        p.close()
        assert [w for w in r.text.split() if w != "-"] == [w for w in "".join(p.out).split() if w != "-"]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>a  b<br>c<p>d<div>e</div>f", "a b\nc\n\nd\n\ne\nf"),
        ("<ul><li>x<li>y<ol start=3><li>z</ol></ul>", "- x\n- y\n  3. z"),
        ("<table><tr><th>name<th>qty<tr><td>apple<td>10<tr><td rowspan=2>a long cell<td>2<tr><td>3</table>", "name         qty\napple        10\na long cell  2\n             3"),
        ("<p hidden>x</p><div style='DISPLAY : none'>y</div><script>'</p>'</script><template>t</template>z", "z"),
        ("<details><summary>s</summary>t</details><details open>u</details>", "s\nu"),
        ("<pre>\n a\n  b</pre>c", " a\n  b\n\nc"),
        ("1 < 2 &amp;&lt;b&gt; <b>x</b>y", "1 < 2 &<b> xy"),
        ("a<!-- b", "a"), ("</p></div>a</table>b", "ab"), ("", ""), ("<td>a<td>b", "a\nb"), ("<a title='>'>x</a>", "x"),
    ],
)
def test_layout(page, want):
    assert html_text.extract(page) == want


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>a <svg width=1 /> b</p><svg/><math/>c", "a b\n\nc"),
        ("x<svg viewBox='0 0 9 9'/>between<svg></svg>y", "xbetweeny"),
        ("<svg><title>t</title><defs><text>d</text></defs><style>a > b {}</style><text x=1>one</text><text>two<tspan dy=1>three</tspan></text>junk</svg> z", "one two three z"),
        ("<svg><a><text>linked</text></a><metadata>m<x/>n</metadata><path d=M0/><text>in a path</text></path></svg><p>out", "linked in a path\n\nout"),
        ("so <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math>.", "so x=1 2."),
        ("<math><semantics><mi>E</mi><annotation encoding='application/x-tex'>\\\\E</annotation></semantics></math>", "E"),
        ("<svg><foreignObject><p>first<p>second</foreignObject></svg>after", "first\n\nsecond\n\nafter"),
        ("<svg><defs><g><p>a block ends it</p><title>t</title>b", "a block ends it\n\nb"), ("<p>a<svg><desc><p>no</p></desc></svg>b", "ab"),
        ("<svg><text><![CDATA[a > b]]></text></svg>c", "a > b c"), ("<svg hidden><text display='none'>n</text><text>y</text></svg>", "y"),
    ],
)
def test_svg_and_math(page, want):
    assert html_text.extract(page) == want


def test_html_odd_input(spark):
    for bad in ('<a "' * 30_000, "<div>" * 30_000 + "x", "<table><tr><td>" * 300 + "x", "<" * 100_000, "<!--" * 30_000, "<ul><li>" * 5000):
        html_text.extract(bad)
    rows = html_text.visible_text(spark.createDataFrame([(1, None, "own"), (2, "<b>x", "own"), (2, "<b>x", "own")], "page_id long, html string, Text string")).collect()
    assert sorted((r.page_id, r.text) for r in rows if r.text) == [(2, "x"), (2, "x")] and len(rows) == 3


# ---- top-k -------------------------------------------------------------------------------------


def in_long(score):
    return min(max(score, -(1 << 63)), (1 << 63) - 1)


def test_topk_of_vectors_of_any_magnitude(spark):
    """Large vectors take part; scores up to the ends of the long range are exact, beyond them the ends."""
    rng = random.Random(12)
    size = lambda: 10.0 ** rng.uniform(-3, 12) * rng.choice([-1, 1])
    rows = [(i, [size() for _ in range(3)]) for i in range(260)] + [(50, [1.0, 0.0, 0.0]), (1100, [1.0, 0.0, 0.0]), (1, [2.7e9, 1.0, 0.0]), (2, [1e14, 0.0, 0.0]), (1000, [1e300, -1e300, 0.0]), (1001, [1.7e308] * 3), (1050, []), (1051, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    largest = int(float.fromhex("0x1.fffffffffffffp+1023"))
    held = defaultdict(list)
    for i, v in rows:
        held[i].append([int(np.floor(256 * c)) if abs(c) < 1e304 else largest if c > 0 else -largest for c in v])
    want = set()
    for q in (q for q in held if q % 50 == 0):
        scored = sorted((-max(in_long(sum(x * y for x, y in zip(a, b, strict=True))) for a in held[q] for b in held[i]), i) for i in held if i != q and len(held[i][0]) == len(held[q][0]))
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])}
    assert any(2**62 < abs(w[3]) < 2**63 - 1 for w in want)
    for block in (8192, 30):
        got = [tuple(r) for r in topk.search(df, block_rows=block, query_rows=2 if block == 30 else 8192).collect()]
        assert set(got) == want and len(got) == len(want)


def test_topk_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)], 0) for i in range(330)] + [(400, None, 0), (450, [None] * 6, 0), (500, [float("nan")] * 6, 0), (550, [float("inf")] * 6, 0), (None, [0.1] * 6, 0), (600, [0.5, 0.25], 0), (601, [0.1, 0.2], 0), (700, [], 0), (900, [3e38] * 6, 0), (950, [-3e38, 1.0, 0.0, 0.0, 0.0, 0.0], 0), (10, [1e6] * 6, 0)]
    rows += [(801, rows[3][1], 1), (802, rows[3][1], 1), (100, rows[100][1], 2), (850, [0.0] * 6, 0)]  # ties, a repeated row, a zero vector
    rows += [(7, [0.9] * 6, 1), (7, [0.8] * 6, 1), (200, [-0.7] * 6, 1), *[(2000 + i, [0.25] * 6, 0) for i in range(90)]]  # ids of several vectors, a crowd
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    vectors = defaultdict(list)
    for i, v in ((r.vec_id, r.embedding) for r in df.collect()):
        if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v):
            vectors[i].append([int(np.floor(256 * c)) for c in v])
    want = set()
    for q in (q for q in vectors if q % 50 == 0):
        scored = sorted((-max((in_long(sum(x * y for x, y in zip(a, b, strict=True))) for a in vectors[q] for b in some if len(a) == len(b)), default=0), i) for i, some in vectors.items() if i != q and len(some[0]) == len(vectors[q][0]))
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])}
    for size in (8192, 40):
        got = [tuple(r) for r in topk.search(df, block_rows=size, query_rows=3 if size == 40 else 8192).collect()]
        assert set(got) == want and len(got) == len(want)
    assert topk.search(df.limit(0)).count() == 0
    assert topk.search(df, is_query=F.lit(False)).count() == 0


def test_elimination_stops_early():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.integers(-5, 5, (2000, 8)), rng.integers(90, 110, (20, 8))])
    d = np.sqrt(((x[:, None] - x[None, :24]) ** 2).sum(2))
    evaluated = []

    class Watched:
        def __len__(self):
            return len(x)

        def astype(self, kind):
            return x.astype(kind)

        def __getitem__(self, rows):
            evaluated.append(len(rows))
            return x[rows]

    ((ids, got),) = topk.best(x[-1:], d[-1:], np.array([2019]), Watched(), d, np.arange(2020), 5, step=16)
    scores = x[:-1] @ x[-1]
    assert got.tolist() == sorted(scores.tolist(), reverse=True)[:5] and sum(evaluated) < 400 and (scores[ids] == got).all()
    evaluated.clear()
    ((ids, got),) = topk.best(x[-1:], d[-1:], np.array([2019]), Watched(), d, np.arange(2020), 5, floor=got[-1:])
    assert len(got) == 5 and sum(evaluated) < 400


# ---- token counts ------------------------------------------------------------------------------


def test_tree_follows_edits():
    split, counts = tokencount.counter()
    rng = random.Random(6)
    for n in range(1200):
        text = "".join(rng.choice(["ab", "c", " ", "  ", "\n", "'s", "'", "'l", "l", "12", ".", "é", "　"]) for _ in range(rng.randint(0, 600 if n % 9 == 0 else 25)))
        tree = tokencount.TokenTree(text, *tokencount.planted(text, split, counts), split, counts)
        for _ in range(4):
            a = rng.randint(0, len(tree.text))
            b = min(len(tree.text), a + rng.choice([0, 0, 1, 3, 10, 100]))
            new = "".join(rng.choice([" ", "a", "'", "ve", "\n", "7"]) for _ in range(rng.choice([0, 1, 2, 5, 300 if n % 50 == 0 else 3])))
            tree.edit(a, b, new)
            size, count = tokencount.planted(tree.text, split, counts)
            assert [x for s, _ in tree.leaves for x in s] == size.tolist() and tree.tokens == count.sum()
            assert (tree.sums[1] == (len(tree.text), count.sum())).all()


def test_counts_are_the_tokenizers(spark, odd):
    split, counts = tokencount.counter()
    edits = F.expr("CASE WHEN doc_id = 6 THEN array(named_struct('start', 7, 'end', 9, 'text', 'xyz'), named_struct('start', 8, 'end', 9, 'text', 'left out'), named_struct('start', 900000, 'end', 900001, 'text', ' end')) WHEN doc_id = 2 THEN array(named_struct('start', 0, 'end', 0, 'text', 'new')) END")
    rows = odd.select("doc_id", "text", tokencount.edited(F.col("text"), tokencount.trees(F.col("text")), edits).alias("c")).collect()
    for r in rows:
        assert r.c.n_tokens == len(counts.encoding.encode_ordinary(r.text or "")) and r.c.n_tokens_after == len(counts.encoding.encode_ordinary(r.c.text_after))
    edited = next(r.c for r in rows if r.doc_id == 6)
    assert edited.n_edits == 2 and edited.text_after[5:13] == "woxyz wo" and edited.text_after.endswith("word  end") and edited.n_reencoded < 12
    assert next(r.c for r in rows if r.doc_id == 2).text_after == "new"


def test_packed_numbers():
    for x in ([], [0, 255], [256, 1], [70_000]):
        assert tokencount.unpacked(tokencount.packed(np.array(x, np.int64))).tolist() == x
