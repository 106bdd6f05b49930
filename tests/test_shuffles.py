"""How often rows are shuffled, and results that stay the same when it is less often."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from folio.operators import figures, ocr, pack, raster, textclean, verify
from folio.plans import check_queries
from folio.sources import package

BOX = "x0 double, y0 double, x1 double, y1 double"


def shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_ink_beside_figures_goes_to_its_tiles_once(spark):
    rng = random.Random(3)
    ink = [(p, rng.randrange(-10, 110), rng.randrange(-10, 110)) for p in (1, 2) for _ in range(400)] * 2 + [(None, 1, 1), (1, None, 1)]
    figs = [(p, f"{n}", x, y, x + rng.randrange(10, 90), y + rng.randrange(10, 90)) for p in (1, 2) for n in range(3) for x, y in [(float(rng.randrange(150)), float(rng.randrange(150)))]]
    cells, boxes = spark.createDataFrame(ink, "page_idx int, gx int, gy int"), figures.boxes(spark.createDataFrame(figs, f"page_idx int, no string, {BOX}"))
    got = raster.outside_ink(boxes, boxes, cells, ["page_idx"], least=1)
    want = {}
    for p, gx, gy in {c for c in ink if None not in c}:
        x, y = gx * 2 + 1, gy * 2 + 1
        mine = [f for f in figs if f[0] == p]
        if not any(a <= x <= c and b <= y <= d for _, _, a, b, c, d in mine):
            for _, no, a, b, c, d in mine:
                if b <= y <= d and (c < x < c + 120 or a - 120 < x < a):
                    want[p, no] = want.get((p, no), 0) + 1
    assert {(r.page_idx, r.no): r.cells for r in got.collect()} == want and want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffles(raster.outside_ink(boxes, boxes, cells, ["page_idx"])) <= 4  # the cells, both kinds of boxes, the sums
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_words_of_a_line_go_to_one_place_once(spark):
    rows = [(1, 1, "b", 1.0, 30.0, 0.0, 40.0, 10.0), (1, 1, "a", 3.0, 0.0, 0.0, 10.0, 10.0), (1, 1, "c", 5.0, 41.0, 0.0, 50.0, 8.0), (1, 2, "d", 2.0, 0.0, 0.0, 5.0, 9.0), (None, 1, "e", 1.0, 0.0, 0.0, 5.0, 9.0)]
    words = figures.boxes(spark.createDataFrame(rows, f"page int, line_no int, text string, conf double, {BOX}"))
    parts = ocr.split_lines(words, ["page"])
    assert shuffles(parts) == 1
    assert sorted(tuple(r) for r in parts.collect()) == [(1, 1, 0, "a", 0.0, 10.0, 1, 3.0), (1, 1, 1, "b c", 30.0, 50.0, 2, 3.0), (1, 2, 0, "d", 0.0, 5.0, 1, 2.0)]


def test_page_numbers_without_a_pattern_for_each_row(spark):
    lines = ["**7** Basics", "Basics 7", "7.1 A section", "75 rows", "1.7", "17", "7.", "7", "# 7", "a7", "7 of 7.7", "v 77"]
    gone = [True, True, False, False, False, False, True, True, True, True, True, False]
    texts = spark.createDataFrame([(t, 7) for t in lines] + [("1**2** x", 12), ("x", None), (None, 7)], "text string, printed_no int")
    cleaned = textclean.remove_page_numbers(texts)
    assert [r.text for r in cleaned.collect()] == ["" if g else t for t, g in zip(lines, gone, strict=True)] + ["", "x", None]
    assert "(?![0-9]" not in cleaned._jdf.queryExecution().optimizedPlan().toString()


def test_a_report_is_one_sum_by_chunk(spark):
    source = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (3, 1), (None, 4)], "chunk int, page_no int")
    answer = spark.createDataFrame([(1, 1), (1, 9), (3, 1), (None, 4)], "chunk int, page_no int")
    issues = verify.unmatched_pages(source, answer, ["chunk"])
    assert sorted(map(tuple, issues.collect())) == [(1, 2, "missing"), (1, 9, "extra_page")]
    chunks = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "chunk int")
    lines = verify.report(chunks, answer, issues, ["chunk"])
    assert sorted(map(tuple, lines.collect()), key=str) == sorted([(1, 2, "- 1: 2 issues\n    - page 2: missing\n    - page 9: extra_page"), (2, 1, "- 2: no answer"), (3, 0, "- 3: complete"), (None, 0, "- : complete")], key=str)
    assert "Join" not in lines._jdf.queryExecution().executedPlan().toString()


def test_equal_pairs_of_keys_are_compared_once(spark, monkeypatch):
    calls = spark.sparkContext.accumulator(0)
    plain = ocr.block_similarity

    def counted(a, b):
        calls.add(1)
        return plain(a, b)

    monkeypatch.setattr(ocr, "block_similarity", counted)
    alike = ocr._alike(0.75).func
    import pyarrow as pa

    assert alike(pa.array(["abcd"] * 50 + ["ab"]), pa.array(["abce"] * 50 + ["xy"])).to_pylist() == [True] * 50 + [False]
    assert calls.value == 2


def counted_pages(spark):
    """(pages, how often a text was worked out, rows): repeated pages, pages that share a place, and null ones among them."""
    rng = random.Random(5)
    rows = [("a", lang, p, "w " * rng.choice([0, 3, 40, 200]) + f"<!-- {p} -->![x](y z) end") for lang in ("x", "y") for p in range(120)]
    rows += [("a", "x", 7, None), ("a", "x", 7, "k l"), ("a", "x", 7, "k l"), ("b", "y", 0, "only"), ("b", "y", 1, "w " * 2000)]
    times = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(text):
        times.add(1)
        return text

    pages = spark.createDataFrame(rows, "source string, lang string, doc_id long, text string").repartition(3)
    return pages.withColumn("text", told("text")), times, rows


def test_texts_of_prompts_are_read_twice(spark):
    pages, times, rows = counted_pages(spark)
    made = pack.filled_chunks(pages, ["source", "lang"], "doc_id", budget=300)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffles(made) <= 3  # texts and numbers by page, pages by chunk, the books' counts
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    made = made.collect()
    assert times.value <= 2 * len(rows)  # three times before, and nine times by package_files
    told = sorted(((r.source, r.lang, p.place, p.text or "", p.words) for r in made for p in r.pages))
    words = lambda t: len((t or "").split("<")[0].split()) + (" end" in (t or ""))
    assert told == sorted((s, la, p, t or "", words(t)) for s, la, p, t in rows)
    for r in made:
        assert sum(p.words for p in r.pages) <= 300 or len(r.pages) == 1
        assert (r.first_page, r.last_page) == (r.pages[0].place, r.pages[-1].place) and 1 <= r.chunk_no <= r.n_chunks


def test_texts_of_a_package_are_read_twice(spark, monkeypatch):
    pages, times, rows = counted_pages(spark)
    monkeypatch.setattr(check_queries, "table", lambda *_: pages)
    files = check_queries.package_files(spark, "").collect()
    assert times.value <= 2 * len(rows)
    n_words = lambda t: len((t or "").split("<")[0].split()) + (" end" in (t or ""))
    chunks, filled = {}, {}
    for s, la, p, n, t in sorted((s, la, p, n_words(t), t or "") for s, la, p, t in rows):
        no, full = filled.get((s, la), (0, 1801))
        no, full = (no + 1, n) if full + n > 1800 else (no, full + n)
        filled[s, la] = no, full
        chunks.setdefault((s, la, no), []).append((p, t))
    prompt = lambda c: f"Pages {c[0][0]}-{c[-1][0]}\n\n" + "\n\n".join(t for _, t in c if t)
    assert sorted(map(tuple, files)) == sorted((f"{la}/{s}/{no}.md", hashlib.sha1(prompt(c).encode()).hexdigest()) for (s, la, no), c in chunks.items())


def test_a_package_that_is_the_same_is_not_staged(spark, tmp_path):
    files = spark.createDataFrame([(f"f/{i}é.md", f"text {i} ü".encode() if i else None) for i in range(300)], "path string, content binary")
    root = f"file://{tmp_path}/p"
    package.write_package(files, root)
    before = (tmp_path / "p").stat().st_mtime_ns
    package.write_package(files.repartition(5), root)
    assert (tmp_path / "p").stat().st_mtime_ns == before  # a staging folder came and went before
    assert package.read_package(spark, root).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism  # one for each 32 files before
    package.write_package(files.filter("path <> 'f/7é.md'"), root)
    assert package.current(root).endswith("/v-2") and package.read_package(spark, root).count() == 298  # an empty file is left out


def test_bridging_stores_no_table_of_runs(spark, monkeypatch):
    monkeypatch.setattr(raster, "checkpointed", None)  # a call fails
    ink = spark.createDataFrame([(p, x, 0) for p in (1, 2) for x in (0, 1, 2, 8, 9)] + [(1, 0, 0), (None, 0, 0), (3, None, 1)], "page int, gx int, gy int")
    figs = [(1, "a", 0.0, 0.0, 2.0, 2.0, 7), (1, "b", 16.0, 0.0, 17.0, 2.0, 8), (2, "a", 0.0, 0.0, 2.0, 2.0, 9), (2, None, 17.0, 0.0, 18.0, 2.0, 1), (2, "c", None, None, None, None, 2), (3, "a", 0.0, 0.0, 1.0, 1.0, 3), (None, "a", 0.0, 0.0, 1.0, 1.0, 4)]
    figs = figures.boxes(spark.createDataFrame(figs, "page int, no string, x0 double, y0 double, x1 double, y1 double, more int"))
    grown = raster.bridged(figs, ink, ["page"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffles(grown) <= 2  # cells by page, figures by page
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {r.more: r.box and tuple(r.box) for r in grown.collect()}
    assert grown.columns == figs.columns and got == {7: (0.0, 0.0, 6.0, 2.0), 8: (16.0, 0.0, 20.0, 2.0), 9: (0.0, 0.0, 6.0, 2.0), 1: (17.0, 0.0, 18.0, 2.0), 2: (None,) * 4, 3: (0.0, 0.0, 1.0, 1.0), 4: (0.0, 0.0, 1.0, 1.0)}


def test_figures_of_pages_come_in_parts_that_leave_nothing(spark, monkeypatch, tmp_path):
    from pathlib import Path

    from folio.plans import derived_queries, runtime

    rows = [(o, 1, 10, 5, 1.0, 2.0, "A", None) for o in range(40)] + [(None, 1, 10, 5, 1.0, 2.0, "A", None)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = runtime.in_parts(spark.read.parquet(f"{tmp_path}/lineitem.parquet"), ["l_orderkey"], 9, "test")
    told = [{r.l_orderkey for r in p.collect()} for p in parts]
    assert len(parts) == 5 and sum(map(len, told)) == 41 and set().union(*told) == {r[0] for r in rows}
    stored = []

    def figures_of(spans, drawings, page, *_):
        return spans, spans, spans, spans

    def found(items, captions, bodies, spans, ink, page, rules, laid):
        kept = runtime.checkpointed(spans.groupBy("page_idx").agg(F.first("box").alias("box")))
        stored.append(Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")))
        assert any(stored[-1].iterdir())
        return kept.select("page_idx", F.lit("1").alias("no"), F.lit("figure").alias("kind"), "box", F.lit(False).alias("missing"), F.lit(False).alias("edge"))

    monkeypatch.setattr(derived_queries.figures, "page_objects", figures_of)
    monkeypatch.setattr(derived_queries.raster, "page_figures", found)
    monkeypatch.setattr(derived_queries, "FIGURE_ROWS", 15)
    got = [r.page_idx for r in derived_queries.page_figures(spark, str(tmp_path)).collect()]
    assert sorted(got) == list(range(40)) and len(stored) == 3 and not any(p.exists() for p in stored)


def test_lines_of_a_slide_go_to_their_table_once(spark):
    from folio.operators import slides

    rows = [(p, n * 10 + k, x, 30.0 * n + k, x + 20.0, 30.0 * n + 10 + k, f"{p} {n} {k}") for p in (1, 2, None) for n in range(4) for k, x in ((0, 40.0 + n), (1, 200.0 - n))]
    rows += [(1, 33, 200.0, 91.0, 220.0, 101.0, "twice"), (1, 33, 200.0, 91.0, 220.0, 101.0, None)]
    lines_ = figures.boxes(spark.createDataFrame(rows, f"page int, pos int, {BOX}, text string"))
    found = slides.table_rows(lines_, ["page"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffles(found) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {(r.page, r.row_no): (r.cells, r.places, r.top) for r in found.collect()}
    want = {(p, n + 1): ([f"{p} {n} 0", f"{p} {n} 1"], [n * 10, n * 10 + 1], -2.0) for p in (1, 2) for n in range(4)}
    want[1, 4] = (["1 3 0", "1 3 1 twice"], [30, 31, 33, 33], -2.0)
    assert got == want


def test_slides_of_decks_come_in_parts_that_leave_nothing(spark, monkeypatch):
    from pathlib import Path

    from folio.plans import runtime, slide_queries
    from test_queries import DATA

    told = lambda: sorted(map(tuple, slide_queries.slide_structures(spark, DATA).collect()))
    whole, shared, made = told(), Path(runtime.shared_dir(spark).removeprefix("file:")), []
    plain = runtime.checkpointed
    monkeypatch.setattr(slide_queries.slide_parts, "checkpointed", lambda df: (plain(df), made.append(spark.sparkContext.getCheckpointDir()))[0])
    monkeypatch.setattr(slide_queries, "SLIDE_ROWS", 3500)
    assert told() == whole and len(set(made)) == 2
    assert shared.exists() and not any(Path(m.removeprefix("file:")).exists() for m in made)


def test_footers_of_decks_come_in_parts_that_leave_nothing(spark, monkeypatch):
    from pathlib import Path

    from folio.plans import derived_queries, runtime
    from test_queries import DATA

    told = lambda: sorted(map(tuple, derived_queries.similar_footers(spark, DATA).collect()))
    whole, made, plain = told(), [], runtime.checkpointed
    monkeypatch.setattr(ocr, "checkpointed", lambda df: (plain(df), made.append(spark.sparkContext.getCheckpointDir()))[0])
    monkeypatch.setattr(derived_queries, "FOOTER_ROWS", 3500)
    assert told() == whole and len(set(made)) == 2
    assert not any(Path(m.removeprefix("file:")).exists() for m in made)
