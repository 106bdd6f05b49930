"""Composed flows on small authored input: figures of a page, cleaned chapters, decks, repairs; and operators on odd input."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from folio.operators import figures, incremental, ocr, pack, raster, slides, spatial, stitch, structure, textclean, verify, vocab
from folio.plans import runtime
from folio.sources import deck_writer as w
from folio.sources import decks

BOX = "x0 double, y0 double, x1 double, y1 double"


def boxes(spark, rows, names, column="box"):
    return figures.boxes(spark.createDataFrame(rows, f"{names}, {BOX}"), column)


def page_of_figures(spark):
    items = boxes(spark, [(0, 1, True, 60.0, 60.0, 120.0, 120.0), (0, 2, True, 125.0, 60.0, 180.0, 120.0), (0, 3, True, 60.0, 140.0, 120.0, 180.0), (0, 4, True, 185.0, 80.0, 188.0, 100.0), (0, 5, True, 60.0, 600.0, 70.0, 605.0), (0, 6, True, 50.0, 400.0, 300.0, 440.0)], "page_idx int, box_id int, drawn boolean")
    caps = boxes(spark, [(0, "1.1", "figure", 60.0, 185.0, 180.0, 195.0), (0, "1.2", "figure", 60.0, 700.0, 180.0, 710.0)], "page_idx int, no string, kind string", "caption_box")
    bodies = boxes(spark, [(0, 50.0, 402.0, 300.0, 438.0), (0, 50.0, 210.0, 300.0, 260.0)], f"page_idx int")
    spans = boxes(spark, [(0, 1, 1, "Arial", 8.0, 70.0, 70.0, 100.0, 80.0)], "page_idx int, block_no int, line_no int, font string, size double")
    return items, caps, bodies, spans


def test_object_figures(spark):
    rows = {r.no: r for r in figures.object_figures(*page_of_figures(spark), ["page_idx"]).collect()}
    # boxes 1, 2 and 4 are one cluster; 3 stands 20 points below and joins; 5 is too small and 6 lies on a body text
    assert tuple(rows["1.1"].box) == (60.0, 60.0, 188.0, 180.0) and not rows["1.1"].missing
    assert rows["1.2"].missing and rows["1.2"].box is None
    empty = [d.limit(0) for d in page_of_figures(spark)]
    assert figures.object_figures(*empty, ["page_idx"]).count() == 0


def test_page_figures_in_two_stages(spark):
    ink = [(0, x, y) for x in range(92, 98) for y in range(40, 44)] + [(0, x, y) for x in range(35, 60) for y in range(320, 340)]
    ink += [(0, x, 100) for x in range(30, 60)]  # under the first body text: explained
    rows = {r.no: r for r in raster.page_figures(*page_of_figures(spark), spark.createDataFrame(ink, "page_idx int, gx int, gy int"), ["page_idx"]).collect()}
    assert rows["1.1"].box.x1 == 196.0 and rows["1.1"].box.y1 == 180.0  # grown over the ink beside it
    assert not rows["1.2"].missing and tuple(rows["1.2"].box) == (70.0, 640.0, 120.0, 680.0)  # found by its ink
    assert not rows["1.1"].edge


CHAPTER = [
    (0, 1, "Running head\n# **2**\n## exerCiSeS\n\ndata are cut in the middle of a sentence and it"),
    (1, 2, "Running head\n2\n- I one\n\n- I two\n\ngoes on here. different words follow."),
    (2, 3, "Running head\n# Contents\n\n1.1 First 1.2 Second\n\nA ~~2.1~~ part.\n\n\n\n- Figure 1.1 Cap"),
    (3, None, "Running head\n<!-- Start of picture text -->x1 9 q<!-- End of picture text -->\nThe end."),
]
CLEANED = """<!-- page 1 · printed 1 -->

## Exercises

Data are cut in the middle of a sentence and it goes on here. Different words follow.

<!-- page 2 · printed 2 -->

- one

- two

<!-- page 3 · printed 3 -->

# Contents

- 1.1 First

- 1.2 Second

A 2.1 part.

Figure 1.1 Cap

![Figure 1.1: Flow](figures/figure-1.1.png)

<!-- labels of 1.1: a · b -->

<!-- page 4 · printed 4 -->

The end."""


def chapter_pages(spark, rows=CHAPTER):
    pages = spark.createDataFrame([(1, i, n, t, 800.0, 0) for i, n, t in rows], "doc_id int, page_idx int, printed_no int, text string, height double, page_offset int")
    figs = boxes(spark, [(1, 2, "figure", "1.1", "Flow", "figure-1.1.png", "a · b", None, 10.0, 500.0, 90.0, 600.0)], "doc_id int, page_idx int, kind string, no string, title string, file_name string, labels string, table_md string")
    return textclean.with_links(pages, figs, ["doc_id", "page_idx"])


def test_chapters_are_cleaned_in_order(spark):
    (row,) = textclean.clean_chapters(chapter_pages(spark), ["doc_id"]).collect()
    assert row.md == CLEANED
    (again,) = textclean.clean_chapters(chapter_pages(spark).orderBy(F.desc("page_idx")), ["doc_id"]).collect()
    assert again.md == CLEANED
    assert textclean.clean_chapters(chapter_pages(spark).limit(0), ["doc_id"]).count() == 0
    (blank,) = textclean.clean_chapters(chapter_pages(spark, [(0, None, None)]), ["doc_id"]).collect()
    assert blank.md == "<!-- page 1 · printed 1 -->"


def test_decks_with_all_kinds_of_shapes(spark):
    chart = w.chart_part(["a", "b"], [("sold", [1.50, 2]), ("left", [3, 4])])
    content = w.deck([
        {"shapes": [w.text([(0, "Plan")], 20, "title"), w.text([(0, "One"), (1, "Two")], 100, "body"), w.text([(0, "A note")], 200, box=True), w.table([["k", "v|w"], ["1", "2"]], 300), w.text([(0, "9")], 500, "sldNum")], "notes": ["say this"]},
        {"shapes": [w.chart("rId1", 100), w.picture("rId2", 300), w.picture("rId2", 10, 20, 20)], "links": {"rId1": "ppt/charts/chart1.xml", "rId2": "ppt/media/a.png"}, "parts": {"ppt/charts/chart1.xml": chart}},
        {"shapes": [w.group([w.text([(0, "In")], 10), w.text([(0, "Out")], 50)], 100), w.connector(150), w.text([(0, "Loose")], 300)], "hidden": True},
        {"shapes": [w.chart("rId9", 100)]},
    ])
    files = spark.createDataFrame([("a", content), ("bad", b"no zip"), ("none", None)], "path string, content binary")
    rows = decks.parsed(files)
    assert {r.path for r in rows.filter("error IS NOT NULL").collect()} == {"bad", "none"}
    got = {r.slide_no: r for r in decks.slides(rows).collect()}
    assert [(i.kind, i.level, i.text) for i in got[1]["items"]] == [("item", 0, "One"), ("item", 1, "Two"), ("paragraph", 0, "A note"), ("table", 0, "| k | v\\|w |"), ("table", 0, "| 1 | 2 |")]
    assert (got[1].title, got[1].notes, got[1].flags) == ("Plan", "say this", [])
    assert [i.text for i in got[2]["items"]] == ["| Series | a | b |", "| sold | 1.5 | 2 |", "| left | 3 | 4 |"] and [f.split(" ")[0] for f in got[2].flags] == ["chart", "picture", "no"]
    assert got[3].hidden and got[3].labels == ["In", "Out", "Loose"] and got[3]["items"] == [] and got[3].flags[0].startswith("diagram")
    assert got[4].flags[0].startswith("chart (values not read")


def test_split_words_log_and_fixpoint(spark):
    rows = [(1, 1, "an in ter face and an inter face"), (1, 2, "the interface of inter"), (None, 1, "a haza rd"), (None, 2, "hazard")]
    df = spark.createDataFrame(rows, "deck_id int, pos int, text string")
    fixed, log = vocab.repair_with_log(df, ["deck_id"])
    texts = {(r.deck_id, r.pos): r.text for r in fixed.collect()}
    assert texts[None, 1] == "a hazard"
    assert {(r.deck_id, r.left, r.right) for r in log.collect()} >= {(None, "haza", "rd")}


def test_hyphens_of_a_null_book_and_doubled_forms(spark):
    raw = spark.createDataFrame([(None, "time-\nout and timeo-\nut and timeo-ut, time-out"), (1, "real-\ntime")], "book int, text string")
    pages = spark.createDataFrame([(None, "timeout"), (1, "realtime"), (1, None), (1, "")], "book int, text string")
    got = sorted(str(r.text) for r in textclean.repair_hyphens(pages, raw, ["book"]).collect())
    assert got == ["", "None", "real-time", "time-out"]


def greedy(sizes, budget):
    chunk, filled, out = 0, None, []
    for n in sizes:
        if filled is None or filled + n > budget:
            chunk, filled = chunk + 1, 0
        filled += n
        out.append(chunk)
    return out


@pytest.mark.parametrize("pages", [100_000, 20, 1])
def test_packing_across_ranges(spark, monkeypatch, pages):
    """Books that one range or several hold, with nulls, ties and repeated pages, against one loop."""
    monkeypatch.setattr(pack, "RANGE", pages)
    rng = random.Random(4)
    rows = [(b, p, "w " * rng.choice([0, 3, 40, 200])) for b in ("a", None) for p in range(150)] + [("a", 7, None), ("a", 7, "x y"), ("a", 7, "x y"), ("c", None, "only")]
    df = spark.createDataFrame(rows, "book string, page int, text string").repartition(5)
    got = pack.chunk_numbers(df, ["book"], "page", budget=300).collect()
    for book in ("a", None, "c"):
        mine = sorted(((r.page is not None, r.page or 0, r.n_words), r.chunk_no) for r in got if r.book == book)
        assert [c for _, c in mine] == greedy([k[2] for k, _ in mine], 300)
    assert len(got) == len(rows)
    made = pack.filled_chunks(df, ["book"], "page", budget=300).collect()
    assert sum(len(r.pages) for r in made) == len(rows) and {(r.book, r.chunk_no) for r in made} == {(r.book, r.chunk_no) for r in got}


def test_glossary_of_any_size(spark):
    terms = spark.createDataFrame([(i, [f"term{i}", f"alt{i} two"]) for i in range(3000)] + [(9000, None), (9001, ["", None, "Normalisation (x)"])], "term_id int, source array<string>")
    texts = spark.createDataFrame([(1, "Term17, ALT5 two; aterm9 and normalization (x)"), (2, None), (3, "")], "doc_id int, text string")
    assert {(r.doc_id, r.term_id) for r in pack.glossary_hits(texts, terms, "doc_id").collect()} == {(1, 1), (1, 17), (1, 5), (1, 9001)}


@pytest.mark.parametrize("name", ["glyph", "glyph_run", "page_edges", "gone", "headers", "kind_", "text_sign", "parts"])
def test_columns_with_clashing_names_stay(spark, name):
    rows = [(1, i, f"Head\n- I do {i}\n\n- I see {i}\nfoot", "own") for i in range(6)] + [(1, 9, None, "own")]
    df = spark.createDataFrame(rows, f"book int, pos int, text string, {name} string")
    for out in (textclean.remove_headers(df, ["book"]), textclean.bullet_glyphs(df, ["book"]), vocab.repair_with_log(df, ["book"])[0]):
        assert out.columns == df.columns and {r[name] for r in out.collect()} == {"own"} and out.count() == 7


EMPTY_BOX = "page_idx int, pos int, text string, no string, kind string, bullet_x double, size double, font string, block_no int, line_no int, cluster int, box_id int, conf double, box struct<x0:double,y0:double,x1:double,y1:double>, drawn boolean"


def test_empty_and_null_rows(spark):
    """No rows give no rows; rows of nulls fail nowhere and are in no result but where the docstring says so."""
    nothing = spark.createDataFrame([], EMPTY_BOX)
    nulls = spark.createDataFrame([(None,) * 15] * 2, EMPTY_BOX)
    page = ["page_idx"]
    ways = {
        "captions": lambda d: figures.captions(d, page), "nearest": lambda d: figures.nearest_caption(d.drop("no"), d.withColumnRenamed("box", "caption_box"), page), "assigned": lambda d: figures.assigned(d, d.withColumnRenamed("box", "caption_box"), page).filter("NOT missing"), "labels": lambda d: figures.label_text(d.drop("no"), d, page),
        "overlapping": lambda d: figures.overlapping(d, page), "components": lambda d: figures.components(d, page), "fonts": lambda d: figures.fonts_within(d.drop("no"), d, page).filter("n_lines > 0"), "roles": lambda d: slides.structured(d, page, "block_no").filter("role = 'title'"),
        "clusters": lambda d: slides.clusters_1d(d, page, "size", 1.0), "median": lambda d: slides.upper_median(d, page, "size"), "bullets": lambda d: slides.read_bullets(d, page), "parts": lambda d: ocr.split_lines(d, page).filter("n_words > 2"),
        "reading": lambda d: verify.best_reading(d.withColumn("reading", F.col("pos")), page).filter("sure_words > 0"), "drop_caps": lambda d: slides.drop_caps(d, page, 10.0), "offset": lambda d: structure.page_offset(d, ["block_no"]), "single": lambda d: structure.contents_entries(d, ["block_no"]),
        "hashes": lambda d: incremental.duplicate_files(incremental.content_hashes(d, ["pos"], "text"), "pos").filter("sha1 IS NOT NULL"),
    }
    for name, way in ways.items():
        assert way(nothing).count() == 0, name
        assert way(nulls).count() == 0, name
    kinds = stitch.stitched(nulls.select("page_idx", "pos", "text"), page).collect()
    assert [r.kind for r in kinds] == ["floating", "floating"]


def test_slides_of_a_text_deck_and_what_was_removed(spark):
    rows = [(1, p, k, t, None if k else 20.0 + p, 10.0 + k * 40, 20.0, 40.0 + 0 * p, 100.0) for p in range(8) for k, t in enumerate([f"Course {p}", f"Title {p}", "a"])]
    lines_ = figures.boxes(spark.createDataFrame([(d, p, k, t, b, 40.0, y, 200.0, y + (20 if k == 1 else 10)) for d, p, k, t, b, y, *_ in rows], "deck_id int, page_idx int, pos int, text string, bullet_x double, x0 double, y0 double, x1 double, y1 double"))
    out, removed = slides.text_slides(lines_, ["deck_id"])
    assert {r.text for r in out.collect()} == {f"Title {p}" for p in range(8)} | {"a"}
    assert removed.first().removed == ["Course 0"]


def test_large_initials_are_put_back(spark):
    spans = boxes(spark, [(0, 1, "D", 30.0, 10.0, 10.0, 30.0, 40.0), (0, 2, "atabases and (more) of", 10.0, 31.0, 12.0, 200.0, 22.0), (0, 3, "it goes on", 10.0, 31.0, 25.0, 200.0, 35.0)], "page_idx int, pos int, text string, size double")
    pages = spark.createDataFrame([(0, "x databases\natabases and\n(more) of atabases and (more)", "own"), (1, "atabases and (more)", "own"), (0, None, "own")], "page_idx int, text string, note string")
    got = slides.drop_caps_placed(pages, spans, ["page_idx"], 10.0)
    assert got.columns == pages.columns
    assert sorted(map(str, (r.text for r in got.collect()))) == ["None", "atabases and (more)", "x databases\nDatabases and\n(more) of atabases and (more)"]


def test_tables_laid_by_page_meet_where_they_lie(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    rows = spark.createDataFrame([(p, k, 0.0, 0.0, 9.0, 9.0) for p in (1, 2, None) for k in (1, 2)], f"page_idx int, k int, {BOX}")
    with runtime.in_place(spark):
        left, right = (runtime.laid_by(figures.boxes(rows.withColumnRenamed("k", k), box), ["page_idx"]) for k, box in (("a", "box"), ("b", "other")))
        met = spatial.meeting(left, right, ["page_idx"], F.col("box"), F.col("other"), nulls=True).groupBy("page_idx", "a").agg(F.count(F.lit(1)).alias("n"))
        assert "Exchange" not in met._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, met.collect())) == [(p, a, 2) for p in (1, 2) for a in (1, 2)]
    assert spark.conf.get("spark.sql.adaptive.enabled") == before
