"""Books from pages to the files of a package."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import book
from folio.sources import package

PAGES = "book_id int, page_idx int, text string, height double"
MARKS = "book_id int, pos int, level int, title string, page int"
DOCUMENTS = "book_id int, n_pages int, name string"
FIGURES = "book_id int, page_idx int, kind string, no string, title string, file_name string, box struct<x0:double,y0:double,x1:double,y1:double>, labels string, table_md string"
TERMS = "term_id int, source array<string>, target string"
TEMPLATE = "{range} ({no}/{count}) {images}|{outline}|{terms}|{note}|{text}"


def files(spark, pages, marks=(), documents=(), figures=(), terms=(), **more):
    df = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    found = book.book_files(df(pages, PAGES), df(marks, MARKS), df(documents, DOCUMENTS), df(figures, FIGURES), df(terms, TERMS), ["book_id"], TEMPLATE, **more)
    assert found.columns == ["path", "content"]
    return found


def told(found):
    rows = found.collect()
    out = {r.path: r.content for r in rows}
    assert len(out) == len(rows)
    return out


def pages_of(book_id, texts, numbered=True):
    """Pages under a running header, with their printed numbers, which begin at 1 on the second page."""
    return [(book_id, i, f"The Book\n{t}\n{i}" if numbered and i else t, 800.0) for i, t in enumerate(texts)]


TEXTS = ["Front", "The first chapter is about high-\nlevel plans.", "It ends right in the very middle of", "a sentence. The highlevel view stays.", "Second one.", "More of it.", "Third begins.", "And ends."]
MARKED = [(1, 0, 1, "Chapter 1: Plans", 2), (1, 1, 2, "A section", 3), (1, 2, 1, "Chapter 2: Views?", 5), (1, 3, 1, "Chapter 3", 7)]


def test_files_of_a_book(spark):
    shown = [(1, 4, "figure", "2.1", "A view", "fig-2-1.png", (0.0, 10.0, 90.0, 90.0), "in, out", None)]
    got = told(files(spark, pages_of(1, TEXTS), MARKED, [(1, 8, "My: book")], shown, [(1, ["view"], "LOOK")], first_note="First.", last_note="Last.", budget=12))
    stems = ["01_Plans", "02_Views", "03_Chapter_3"]
    chapters = {f"My_book/{s}/{s}.md" for s in stems}
    assert chapters | {f"My_book/{s}/instructions.txt" for s in stems} | {"My_book/index.md"} <= set(got)
    assert got["My_book/01_Plans/01_Plans.md"] == (
        "# Chapter 1: Plans\n\n> Source: My: book, pages 2–4 (printed 1–3), figures and tables: 0\n\n<!-- page 2 · printed 1 -->\n\nThe first chapter is about high-\nlevel plans.\n\n<!-- page 3 · printed 2 -->\n\n"
        "It ends right in the very middle of a sentence. The high-level view stays.\n\n<!-- page 4 · printed 3 -->\n")  # fmt: skip
    second = got["My_book/02_Views/02_Views.md"]
    assert second.startswith("# Chapter 2: Views?\n\n> Source: My: book, pages 5–6 (printed 4–5), figures and tables: 1\n\n<!-- page 5 · printed 4 -->\n\n![Figure 2.1: A view](figures/fig-2-1.png)\n\n<!-- labels of 2.1: in, out -->\n\nThe Book\nSecond one.")  # a line runs from three pages on
    parts = {p: c for p, c in got.items() if "02_Views/parts/" in p}
    assert set(parts) == {"My_book/02_Views/parts/02_Views_01.txt"} and "fig-2-1.png" in parts["My_book/02_Views/parts/02_Views_01.txt"] and "First.Last." in parts["My_book/02_Views/parts/02_Views_01.txt"] and "- view -> LOOK" in parts["My_book/02_Views/parts/02_Views_01.txt"]
    assert got["My_book/02_Views/instructions.txt"].startswith("Chapter 2: Views?\nGive the 1 parts of 02_Views ")
    index = got["My_book/index.md"].split("\n")
    assert index[:4] == ["# My: book", "", "Chapters by: bookmarks", ""] and [x[:40] for x in index[4:7]] == [f"- [Chapter {i + 1}: {t}]({s}/{s}.md)"[:40] for i, (t, s) in enumerate(zip(["Plans", "Views?", "Chapter 3"], stems))]
    assert "pages 5–6, words " in index[5] and index[5].endswith(", figures 1, parts 1")


def test_three_ways_to_chapters_and_names_that_come_out_equal(spark):
    contents = ["Contents\nChapter 1 Plans 1\nChapter 2 Views 4\nChapter 2 Views 6", *TEXTS[1:]]
    rows = pages_of(1, TEXTS) + pages_of(2, contents) + pages_of(3, ["Only this", "and that."], False)
    got = told(files(spark, rows, MARKED, [(1, 8, "Book"), (2, 8, "book"), (3, 2, "Book_2")]))
    ways = {p.split("/")[0]: c.split("\n")[2] for p, c in got.items() if p.endswith("index.md")}
    assert ways == {"Book": "Chapters by: bookmarks", "book_2": "Chapters by: contents", "Book_2_3": "Chapters by: whole"}
    assert {p for p in got if p.startswith("book_2/") and p.endswith("s.md")} == {"book_2/01_Plans/01_Plans.md", "book_2/02_Views/02_Views.md"}
    assert "> Source: Book_2, pages 1–2, figures" in next(c for p, c in got.items() if p.startswith("Book_2_3/") and p.count("/") == 2 and p.endswith(".md"))
    # two chapters of one number and title, of which one lies within the other
    same = [(1, 0, 1, "Chapter 1: Plans", 2), (1, 1, 1, "Chapter 1: Plans", 5)]
    got = told(files(spark, pages_of(1, TEXTS), same, [(1, 8, "B")]))
    assert {"B/01_Plans/01_Plans.md", "B/01_Plans_2/01_Plans_2.md"} <= set(got) and "Second one." in got["B/01_Plans_2/01_Plans_2.md"]


def test_a_package_of_books_is_written_once(spark, tmp_path):
    root = str(tmp_path / "p")
    found = files(spark, pages_of(1, TEXTS), MARKED, [(1, 8, "B")])
    package.write_package(found, root)
    read = {r.path: bytes(r.content).decode() for r in package.read_package(spark, root).collect()}
    assert read == told(found) and package.current(root).endswith("/v-1")
    package.write_package(files(spark, list(reversed(pages_of(1, TEXTS))), MARKED, [(1, 8, "B")]), root)  # pages in another order make the same files
    assert package.current(root).endswith("/v-1")


def test_odd_books(spark):
    assert told(files(spark, [])) == {}
    # null and empty pages, a page of no chapter, a null book, a null name, a very long page
    rows = [(1, 0, None, None), (1, 1, "", 800.0), (1, 2, "word " * 50_000, 800.0), (1, 9, "no chapter's", 800.0), (None, 0, "no book", 800.0)]
    got = told(files(spark, rows, [], [(1, 3, None), (None, 1, "none")]))
    assert {p.split("/")[0] for p in got} == {"book"} and "Chapters by: whole" in got["book/index.md"]
    chapter = next(c for p, c in got.items() if p.count("/") == 2 and p.endswith(".md"))
    assert chapter.count("word") == 50_000 and "no chapter's" not in chapter
