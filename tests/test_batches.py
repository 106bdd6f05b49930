"""Steps by page that decide many pages at a time: equal to plain loops over each page, and no group of a few rows is a call of its own."""

import random

from pyspark.sql import functions as F

from folio.functions.geometry import rect
from folio.operators import figures, slide_parts, slides, spatial


def calls_by_group(df) -> bool:
    plan = df._jdf.queryExecution().toString()
    return "FlatMapGroups" in plan


def parts_of(nodes, near):
    label = {n: n for n in nodes}
    while True:
        now = {n: min([label[n], *(label[m] for m in nodes if near(n, m))]) for n in nodes}
        if now == label:
            return label
        label = now


def test_connected_pages(spark):
    rng = random.Random(1)
    rows = [(p, rng.randrange(12), rng.randrange(12)) for p in range(40) for _ in range(rng.randrange(1, 9))] + [(99, 5, 5)]
    found = spatial.connected(spark.createDataFrame(rows, "page int, a long, b long"), ["page"], "a", "b")
    assert not calls_by_group(found)
    want = set()
    for p in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == p]
        label = parts_of({x for r in own for x in r}, lambda n, m, own=own: (n, m) in own or (m, n) in own)
        want |= {(p, k, v) for k, v in label.items()}
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(want) and set(got) == want


def test_ink_of_pages(spark):
    rng = random.Random(2)
    cells = {(p, rng.randrange(-8, 12), rng.randrange(-8, 12)) for p in range(30) for _ in range(rng.randrange(1, 15))} | {(31, 10**7, -(10**7)), (31, 0, 0), (31, 3, 0)}
    found = spatial.ink_regions(spark.createDataFrame([*cells, *list(cells)[:20]], "page int, gx int, gy int"), ["page"], (9.0, 3.0), 2.0)
    assert not calls_by_group(found)
    got = {}
    for r in found.collect():
        for x in range(int(r.box.x0 / 2), int(r.box.x1 / 2)):
            got[r.page, r.place, x, int(r.box.y0 / 2)] = r.region
    want = {}
    for p in {c[0] for c in cells}:
        own = sorted(((y, x) for q, x, y in cells if q == p))
        for place, reach in enumerate((5, 3)):  # 9 and 3 points at 2 a cell
            label = parts_of(range(len(own)), lambda i, j, own=own, reach=reach: abs(own[i][0] - own[j][0]) + abs(own[i][1] - own[j][1]) <= reach)
            want |= {(p, place, x, y): label[i] for i, (y, x) in enumerate(own)}
    assert got == want


def test_bullets_of_pages(spark):
    rng = random.Random(3)
    lines = [(p, i, float(rng.randrange(40, 90)), float(rng.randrange(0, 60, 5))) for p in range(30) for i in range(rng.randrange(1, 8))]
    marks = [(p, i, float(rng.randrange(10, 60)), float(rng.randrange(0, 70, 5))) for p in range(30) for i in range(rng.randrange(1, 8))]
    boxed = spark.createDataFrame(lines, "page int, pos int, x double, y double").select("page", "pos", rect(F.col("x"), F.col("y"), F.col("x") + 50, F.col("y") + 10).alias("box"))
    found = slides.matched_bullets(boxed, spark.createDataFrame(marks, "page int, mark int, x double, yc double"), ["page"])
    assert not calls_by_group(found)
    want, taken = set(), set()
    for p, m, x, yc in sorted(marks):
        near = sorted((abs(y + 5 - yc) > 6, a - x, abs(y + 5 - yc), i) for q, i, a, y in lines if q == p and a > x and a - x < 90 and y - 3 <= yc <= y + 13 and (p, i) not in taken)
        if near:
            taken.add((p, near[0][3]))
            want.add((p, m, near[0][3]))
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(want) > 30 and set(got) == want


def test_captions_of_pages(spark):
    rng = random.Random(4)
    boxes = spark.createDataFrame([(p, i, *(float(v) for v in (x, y, x + 40, y + 30))) for p in range(20) for i in range(5) for x, y in [(rng.randrange(0, 90, 10), rng.randrange(0, 300, 10))]], "page int, cluster long, x0 double, y0 double, x1 double, y1 double")
    caps = spark.createDataFrame([(p, f"1.{i}", "figure", *(float(v) for v in (x, y, x + 60, y + 10))) for p in range(20) for i in range(4) for x, y in [(rng.randrange(0, 90, 10), rng.randrange(0, 300, 10))]], "page int, no string, kind string, x0 double, y0 double, x1 double, y1 double")
    clusters, captions = figures.boxes(boxes), figures.boxes(caps, "caption_box")
    found = figures.assigned(clusters, captions, ["page"])
    assert not calls_by_group(found)
    near = {}
    for r in captions.join(clusters, "page").select("page", "no", "cluster", figures.caption_distance(F.col("box"), F.col("caption_box")).alias("d")).filter("d IS NOT NULL").collect():
        near.setdefault((r.page, r.no), []).append((r.d, r.cluster))
    want, taken = {}, set()
    for r in sorted(captions.collect(), key=lambda r: (r.page, r.caption_box.y0, r.caption_box.x0, r.no)):
        d, c = min(((d, c) for d, c in near.get((r.page, r.no), []) if (r.page, c) not in taken), default=(None, None))
        taken.add((r.page, c))
        want[r.page, r.no] = (d, c is None)
    assert {(r.page, r.no): (r.distance, r.missing) for r in found.collect()} == want


def test_title_as_the_query_joins_it(spark):
    """Lines of a title that end with a hyphen: the operator closes them up, the query's SQL sets a space."""
    import inspect

    from folio.plans import slide_queries

    assert "string_agg(trim(text), ' ' ORDER BY pos)" in slide_queries.O["slide_structures"]
    lines = spark.createDataFrame([(1, 0, 0, 30.0, 10.0, 200.0, 40.0, "goes on-", None), (1, 0, 1, 30.0, 45.0, 200.0, 75.0, "goes on-", None), (1, 0, 2, 30.0, 300.0, 200.0, 310.0, "body", None)], "deck_id int, page_idx int, pos int, x0 double, y0 double, x1 double, y1 double, text string, bullet_x double")
    areas = figures.boxes(spark.createDataFrame([], "deck_id int, page_idx int, kind string, x0 double, y0 double, x1 double, y1 double"))
    titles = lambda **how: [r.title for r in slide_parts.slide_structure(figures.boxes(lines), areas, ["deck_id"], **how).collect()]
    assert titles() == ["goes on-goes on-"]
    assert titles(joined=lambda told, line: F.concat_ws(" ", F.nullif(told, F.lit("")), line)) == ["goes on- goes on-"]
    assert "joined=spaced" in inspect.getsource(slide_queries.slide_structures)


def test_files_some_at_a_time(spark):
    """However many decks a batch of Spark's holds, some are written at a time; all are read back."""
    import pyarrow as pa

    from folio.plans import flow_queries
    from folio.sources import decks, pictures

    n = 3 * decks.AT_A_TIME + 5
    rows = [[{"page_idx": 0, "pictures": [{"pos": 1, "p": i, "q": 0}]}] for i in range(n)]
    whole = pa.RecordBatch.from_arrays([pa.array([str(i) for i in range(n)]), pa.array(rows)], names=["path", "s"])
    made = list(flow_queries._files(flow_queries._pictured)([whole]))
    assert [b.num_rows for b in made] == [decks.AT_A_TIME] * 3 + [5]
    files = spark.createDataFrame([(p, bytes(c)) for b in made for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)] + [("broken", b"no deck")], "path string, content binary")
    assert {(r.path, r.width) for r in pictures.embedded(files).collect()} == {(str(i), 30 + i % 9 * 10) for i in range(n)}
    assert {r.path for r in decks.parsed(files).filter("error IS NOT NULL").select("path").distinct().collect()} == {"broken"}


def test_signs_are_not_shuffled(spark):
    """Lines go to their page as texts and come apart there: exchanges of the table's rows and of whole lines only, no window or join over single characters."""
    from folio.plans import scan_queries

    for name in ("char_lines", "false_spaces"):
        plan = scan_queries.Q[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 2 and "posexplode" not in plan and "Join" not in plan, name


def test_characters_of_pages(spark):
    """Characters in any order, two columns, bullets, a page of nothing but a bullet and one without characters with a box: as a plain loop over a page has it."""
    from folio.operators import ocr

    rng, rows = random.Random(5), []
    for p in range(25):
        for y in range(rng.randrange(1, 5)):
            for x in (20.0, 220.0)[: rng.randrange(1, 3)]:
                marked, text = rng.random() < 0.4, rng.choice(["ab cd", "x", "a b", "word of", " "])
                rows += [(p, "•", 10.0, "Symbol", x - 12, y * 20.0, x - 8, y * 20.0 + 10)] if marked else []
                rows += [(p, c, 10.0 if i else None, "Arial", x + 6 * i, y * 20.0 + rng.random(), x + 6 * i + (2 if c == " " and i == 1 else 6), y * 20.0 + 10 + rng.random()) for i, c in enumerate(text)]
    rows += [(98, "•", 10.0, "Symbol", 1.0, 1.0, 5.0, 9.0), (97, None, 10.0, "Arial", 1.0, 1.0, 5.0, 9.0)]
    rng.shuffle(rows)
    chars = spark.createDataFrame(rows, "page int, c string, size double, font string, x0 double, y0 double, x1 double, y1 double").select("page", "c", "size", "font", rect("x0", "y0", "x1", "y1").alias("box"))
    chars = chars.unionByName(chars.filter("page = 98").select(F.lit(96).alias("page"), "c", "size", "font", F.when(F.lit(False), F.col("box")).alias("box")))
    lines, marks = ocr.char_lines(chars, ["page"])
    want, bullets = set(), set()
    for p in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == p and r[1] is not None), key=lambda r: r[7])
        heights = []
        for r in own:
            heights = [*heights[:-1], [*heights[-1], r]] if heights and r[7] - heights[-1][-1][7] <= 3 else [*heights, [r]]
        made = []
        for k, row in enumerate(heights):
            parts = []
            for r in sorted(row, key=lambda r: r[4:5] + r[6:7]):
                parts = [*parts[:-1], [*parts[-1], r]] if parts and r[4] - parts[-1][-1][6] <= 1.6 * max(r[2] or 1, 1) else [*parts, [r]]
            for part in parts:
                kind = lambda r: (r[3], max(r[2] or 1, 1))
                alone = [(i == 0 or kind(part[i - 1]) != kind(r)) and (i + 1 == len(part) or kind(part[i + 1]) != kind(r)) for i, r in enumerate(part)]
                n = 0
                while n < len(part) and (part[n][1] == " " or (part[n][1] == "•" and alone[n])):
                    n += 1
                made.append((k, (part[n] if n < len(part) else part[0])[4], part, alone, n))
        for no, (_, _, part, alone, n) in enumerate(sorted(made, key=lambda m: m[:2]), 1):
            bullets |= {(p, no, r[4], (r[5] + r[7]) / 2) for r in part[:n] if r[1] == "•"}
            rest, one = part[n:], alone[n:]
            wide = [(r[6] - r[4]) / max(r[2] or 1, 1) for r in rest]
            gaps = sorted(w for r, w in zip(rest, wide, strict=True) if r[1] == " ")
            small = lambda i, rest=rest: 0 <= i < len(rest) and rest[i][1].islower()
            text = "".join(r[1] for i, r in enumerate(rest) if not (r[1] == " " and small(i - 1) and small(i + 1) and (wide[i] < 0.72 * gaps[len(gaps) // 2] or one[i])))
            if text.strip():
                seen = [r for r in rest if r[1] != " "]
                want.add((p, no, " ".join(text.split()), max(max(r[2] or 1, 1) for r in rest), min(r[4] for r in seen), min(r[5] for r in rest), max(r[6] for r in rest), max(r[7] for r in rest)))
    assert {(r.page, r.line_no, r.text, r.size, *r.box) for r in lines.collect()} == want and len(want) > 40
    assert {(r.page, r.line_no, r.x, r.yc) for r in marks.collect()} == bullets and len(bullets) > 10


def test_words_compared_some_at_a_time(spark, monkeypatch):
    """Numbers of a few words at a time, whatever a batch holds; a longer row stands alone, and the sums are those of the whole."""
    import pyarrow as pa

    from folio.operators import verify

    rng, sizes, whole = random.Random(6), [], verify._counted
    texts = [[[rng.choice("abcdef") for _ in range(rng.randrange(0, 30))] for _ in range(60)] for _ in range(2)]
    arrays = [pa.array([["x"], *t], pa.list_(pa.string()))[1:] for t in texts]
    want = [pa.array(c).to_pylist() for c in whole(*[pa.array(t, pa.list_(pa.string())) for t in texts])]
    monkeypatch.setattr(verify, "AT_A_TIME", 20)
    monkeypatch.setattr(verify, "_counted", lambda a, b: (sizes.append((len(a), len(a.flatten()) + len(b.flatten()))), whole(a, b))[1])
    got = verify._compared(*arrays)
    assert [c.to_pylist() for c in got.flatten()] == want and sum(n for n, _ in sizes) == 60 and all(n == 1 or w <= 20 for n, w in sizes)


def test_frequent_words_of_pages(spark, monkeypatch):
    """A word that many rows have is not joined by its rows; the result is the same however many count as many."""
    from folio.operators import verify

    words = spark.createDataFrame([(p, w, 95.0) for p in range(20) for w in ["word", "Word1", "odd", "other", None, "!"]], "page int, text string, conf double")
    vocabulary = spark.createDataFrame([("word",), ("other",), ("word",)], "word string")
    found = lambda: sorted(tuple(r) for r in verify.ocr_accepted(words, vocabulary, ["page"]).collect())
    rare = found()
    monkeypatch.setattr(verify, "FREQUENT", 15)
    assert found() == rare == [(p, 95.0, 6, 3, True) for p in range(20)]


def test_books_are_not_worked_out_twice(spark):
    """The plan of a book's chapters reads what was kept: no page text is cut into lines in it, and its size is bounded."""
    from folio.operators import book
    from folio.plans import flow_queries

    pages, bookmarks, documents, _ = flow_queries._books(spark, "/root/testdata/sf0.001")
    plan = book.book_chapters(pages, bookmarks, documents, ["book_id"])._jdf.queryExecution().executedPlan().toString()
    assert "conversations.parquet" not in plan and plan.count("Join") <= 4


def test_images_compared_after_one_exchange(spark):
    """Both renderings' cells go to their image once: no join, and one exchange of cells."""
    from folio.operators import raster

    ink = spark.createDataFrame([(i, x, y) for i in range(6) for x in range(9) for y in range(12)] + [(9, 1, 1)], "page int, gx int, gy int")
    found = raster.same_image(ink, ink.filter("page <> 3 OR gx < 2").filter("page <> 9").withColumn("gx", F.col("gx") + 7), ["page"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert {r.page: r.same for r in found.collect()} == {i: i != 3 for i in range(6)} | {9: False}
