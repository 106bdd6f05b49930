"""Properties and fixed cases that SQL does not cover."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folio import queries
from folio.functions.text import capital_d, content_words, escape_block, is_complete, join_lines, odd_case, safe_name
from folio.operators import figures, pack, slides, structure, textclean, verify, vocab
from folio.plans.fixtures import frame


def one(spark, make, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(make(*[F.col(c) for c in df.columns]).alias("x")).first()[0]


@pytest.mark.parametrize(
    ("make", "given_", "want"),
    [
        (capital_d, "decisions made. do we? then doi:10", "Decisions made. do we? then doi:10"),
        (capital_d, "x. different", "x. Different"),
        (is_complete, 'He said "yes." ', True),
        (is_complete, "ends in the middle", False),
        (odd_case, "exerCiSeS", True),
        (odd_case, "Normal", False),
        (odd_case, "NASA", False),
        (escape_block, "# no heading", "\\# no heading"),
        (content_words, "# Head\n![a](b) two words <!-- none -->", 2),
    ],
)
def test_text_functions(spark, make, given_, want):
    assert one(spark, make, given_) == want


def test_two_column_functions(spark):
    assert one(spark, join_lines, "cost- ", "effective") == "cost-effective"
    assert one(spark, join_lines, "a", " b") == "a b"
    assert one(spark, safe_name, 'a: "b"/c', "x") == "a_bc"
    assert one(spark, safe_name, "??", "x") == "x"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 900), min_size=1, max_size=30))
def test_chunks_keep_order_and_budget(spark, sizes):
    pages = spark.createDataFrame([(1, i, "w " * n) for i, n in enumerate(sizes)], "book int, page int, text string")
    rows = pack.chunk_numbers(pages.repartition(3), ["book"], "page", budget=1000).orderBy("page").collect()
    chunk, filled, want = 0, 10**9, []
    for n in sizes:
        if not want or filled + n > 1000:
            chunk, filled = chunk + 1, 0
        filled += n
        want.append(chunk)
    assert [r.chunk_no for r in rows] == want


def test_clusters_are_a_partition(spark):
    values = [random.Random(5).uniform(0, 200) for _ in range(200)]
    rows = slides.clusters_1d(spark.createDataFrame([(1, v) for v in values], "k int, v double"), ["k"], "v", 2.0).collect()
    ordered, want = sorted(values), []
    for v in ordered:
        if want and v - want[-1][-1] <= 2.0:
            want[-1].append(v)
        else:
            want.append([v])
    assert [(r.n, round(r.centre, 6)) for r in sorted(rows, key=lambda r: r.cluster)] == [(len(w), round(sum(w) / len(w), 6)) for w in want]


def test_components_against_pairwise(spark):
    rng = random.Random(3)
    boxes = [(s, i, *(lambda x, y: (x, y, x + rng.randint(1, 12), y + rng.randint(1, 12)))(rng.randint(0, 120), rng.randint(0, 120))) for s in (1, 2) for i in range(25)]
    df = figures.boxes(spark.createDataFrame([(s, i, *map(float, b)) for s, i, *b in boxes], "set_id int, box_id long, x0 double, y0 double, x1 double, y1 double"))
    got = sorted((r.set_id, r.n, *r.box) for r in figures.components(df, ["set_id"]).collect())
    want = []
    for s in (1, 2):
        now = [(1, list(b)) for t, _, *b in boxes if t == s]
        merged = True
        while merged:
            merged = False
            for i in range(len(now)):
                for j in range(i + 1, len(now)):
                    (n, a), (m, b) = now[i], now[j]
                    if a[0] - 9 < b[2] and b[0] < a[2] + 9 and a[1] - 9 < b[3] and b[1] < a[3] + 9:
                        now[i] = (n + m, [min(a[0], b[0]), min(a[1], b[1]), max(a[2], b[2]), max(a[3], b[3])])
                        del now[j]
                        merged = True
                        break
                if merged:
                    break
        want += [(s, n, *map(float, b)) for n, b in now]
    assert got == sorted(want)


def test_cleaning_is_idempotent(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    once = textclean.remove_headers(docs, ["source", "lang"])
    assert once.count() == docs.count()
    changed = docs.join(once.select("doc_id", F.col("text").alias("clean")), "doc_id").filter("text <> clean")
    assert 0 < changed.count() < docs.count()


def test_coverage_of_null_and_empty(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "a a b", "a c"), (3, "", "")], "k int, s string, o string")
    rows = {r.k: r for r in verify.coverage(df, ["k"], "s", "o").collect()}
    assert (rows[1].total, rows[1].coverage, rows[1].extra) == (0, 1.0, 1)
    assert (rows[2].total, rows[2].common, rows[2].missing, rows[2].extra) == (3, 1, 2, 1)
    assert 3 not in rows  # no words on either side


def test_capitals_restored_in_all_documents(spark, tmp_path):
    texts = [None, "", "do it. does it? doi:10.1/x. done\ndocument\ndoi 7\n- do not\n1. doing", "x do. dx. den", "doit. doing! doi", "do"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def plain(text):
        for start in (r"(^|\n)(\s*(?:[-*]\s+|\d+\.\s+)?)", r"([.!?] )()"):
            text = re.sub(start + r"d([a-z]{2,})", lambda m: m[0] if m[3].startswith("oi") and len(m[3]) == 2 else f"{m[1]}{m[2]}D{m[3]}", text)
        return text

    got = {r.doc_id: r.text for r in queries.QUERIES["capitals_restored"](spark, str(tmp_path)).collect()}
    assert got == {i: t if t is None else plain(t) for i, t in enumerate(texts)}


def one_edit(a, b):
    letters = set(a + b)
    near = {a[:i] + a[i + 1 :] for i in range(len(a))} | {a[:i] + c + a[j:] for i in range(len(a) + 1) for j in (i, i + 1) for c in letters}
    return a != b and b in near


def test_edits_of_words_with_any_letter(spark, tmp_path):
    often = ["größen", "straße", "niñera", "garçon", "planet", "plänet", "schönes", "häuser2"]
    once = ["grössen", "größem", "strase", "niñerá", "garcon", "plonet", "planets", "schones", "häuser3", "überall"]
    text = " ".join(often * 5 + once)
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    fixes = {w: [k for k in often if one_edit(w, k)] for w in once if len(w) >= 6}
    want = {w: k[0] for w, k in fixes.items() if len(k) == 1}
    got = {r.word: r.fixed for r in queries.QUERIES["edit1_fix"](spark, str(tmp_path)).collect()}
    assert got == want and "plonet" not in got and {"garcon", "größem", "schones"} <= set(got)


def test_split_words_repaired(spark):
    rows = vocab.repair_split_words(frame(spark, "fx_torn"), ["deck_id"], ["pos"]).collect()
    texts = {(r.deck_id, r.pos): r.text for r in rows}
    assert texts[1, 1] == "a hazard in the plant"
    assert texts[1, 3] == "into the hazard zone, rd"
    assert texts[1, 4] == "the system and a system to"
    assert texts[2, 1] == "haza rd alone"


def test_split_words_repaired_in_long_texts(spark):
    long = "a hazard " + "x y " * 52_000 + "the haza rd end"
    rows = spark.createDataFrame([(1, 1, long), (1, 2, None), (1, 3, "")], "deck_id long, pos int, text string")
    got = {r.pos: r.text for r in vocab.repair_split_words(rows, ["deck_id"], ["pos"]).collect()}
    assert got == {1: long.replace("haza rd", "hazard"), 2: None, 3: ""}


def test_offset_needs_votes(spark):
    pages = spark.createDataFrame([(1, i, f"{i - 3}\ntext") for i in range(4, 8)], "doc_id long, page_idx int, text string")
    assert structure.page_offset(pages, ["doc_id"]).count() == 0
