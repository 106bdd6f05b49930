"""Small authored layouts, as rows that both engines read: frames for Spark, common table expressions for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DUCK = {"long": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "array<string>": "VARCHAR[]"}

FIXTURES: dict[str, tuple[str, list[tuple]]] = {
    "fx_document": ("doc_id long, n_pages int", [(1, 60), (2, 40), (3, 30), (4, 90)]),
    "fx_bookmark": (
        "doc_id long, pos int, level int, title string, page int",
        [(1, 1, 1, "Preface", 1), (1, 2, 1, "Chapter 1 Basics", 5), (1, 3, 2, "Appendix inside", 9), (1, 4, 1, "Chapter 2  Data   models", 15), (1, 5, 2, "2.1 Rows", 16), (1, 6, 1, "Chapter 3", 25), (1, 7, 1, "Appendix A Tools", 40), (1, 8, 1, "Appendix", 45), (1, 9, 1, "Appendix A Again", 48), (1, 10, 1, "Glossary", 50), (1, 11, 1, "Index", 55),
         (2, 1, 1, "Part 1", 1), (2, 2, 2, "Chapter 1. First", 1), (2, 3, 2, "Chapter 2: Second", 10), (2, 4, 1, "Part 2", 20), (2, 5, 2, "Chapter 3 – Third", 20), (3, 1, 1, "Chapter 1 Alone", 2)],
    ),
    "fx_toc_entry": (
        "doc_id long, pos int, kind string, no string, title string, printed_page int",
        [(1, 1, "part", "", "Part 1", 1), (1, 2, "chapter", "1", "Basics", 3), (1, 3, "chapter", "2", "Models", 12), (1, 4, "part", "", "Part 2", 13), (1, 5, "part", "", "Part 3", 20), (1, 6, "chapter", "3", "Queries", 21), (1, 7, "chapter", "1", "Basics again", 30), (1, 8, "appendix", "A", "Tools", 33), (1, 9, "glossary", "", "Glossary", 38), (1, 10, "end", "", "Index", 42),
         (2, 1, "chapter", "1", "Lone", 5)],
    ),
    "fx_offset": ("doc_id long, page_offset int", [(1, 10), (2, 3)]),
    "fx_page": (
        "doc_id long, page_idx int, text string",
        [(1, 0, "Title\nof the book"), (1, 1, "Contents\nChapter 1 Basics 1\nChapter 2\nData models\n5\nPart 2\n9\nGlossary 12\nIndex\n14"), (1, 2, "1 Basics\nSome text.\nMore text."), (1, 3, "Basics 2\nA line.\nAnother."), (1, 4, "3 Basics\nWords here.\nAnd there 1999"), (1, 5, "Basics\n4\nTail of page"), (1, 6, "5 Models\nText\nText"), (1, 7, "Models 6\nText\nText"), (1, 8, "7"), (2, 0, "12\nno votes here")],
    ),
    "fx_span": (
        "doc_id long, page_idx int, block_no int, line_no int, span_no int, font string, size double, text string",
        [(1, 0, 0, 0, 0, "Times", 10.5, "Body text of ten and a half"), (1, 0, 0, 1, 0, "Times", 10.2, " more body "), (1, 0, 1, 0, 0, "Arial", 18.0, "A heading"), (1, 1, 0, 0, 0, "Times", 11.5, "body in twelve"), (2, 0, 0, 0, 0, "A", 9.0, "abcd"), (2, 0, 0, 1, 0, "B", 9.0, "efgh")],
    ),
    "fx_box": (
        "set_id long, box_id long, pos int, x0 double, y0 double, x1 double, y1 double",
        [(1, 1, 1, 0, 0, 10, 10), (1, 2, 2, 15, 0, 25, 10), (1, 3, 3, 33, 0, 40, 10), (1, 4, 4, 60, 60, 70, 70), (1, 5, 5, 79, 60, 90, 70), (1, 6, 6, 60, 62, 71, 71), (2, 7, 1, 0, 0, 100, 10), (2, 8, 2, 0, 30, 10, 100), (2, 9, 3, 50, 15, 60, 25), (2, 10, 4, 12, 20, 20, 28), (3, 11, 1, 0, 0, 10, 10), (3, 12, 2, 1, 0, 11, 10), (3, 13, 3, 4, 0, 14, 10), (3, 14, 4, 0, 0, 10, 10)],
    ),
    "fx_line": (
        "doc_id long, page_idx int, pos int, x0 double, y0 double, x1 double, y1 double, text string",
        [(1, 0, 1, 50, 120, 300, 132, "Figure 1.1 A first picture"), (1, 0, 2, 50, 300, 300, 312, "As the next one shows, see"), (1, 0, 3, 50, 314, 300, 326, "Figure 1.2 below for more"), (1, 0, 4, 50, 400, 300, 412, "Figure 1.2 The second."), (1, 0, 5, 50, 500, 300, 512, "Table 1.3 (continued)"), (1, 0, 6, 50, 600, 300, 612, "Figure 1.4, which is a mention"), (1, 0, 7, 60, 60, 90, 70, "Start"), (1, 0, 8, 160, 60, 190, 70, "End"), (1, 0, 9, 60, 62, 61, 63, " ")],
    ),
    "fx_caption": (
        "page_idx int, no string, kind string, x0 double, y0 double, x1 double, y1 double",
        [(0, "1.1", "figure", 50, 120, 300, 132), (0, "1.2", "figure", 50, 400, 300, 412), (0, "1.3", "table", 320, 80, 400, 100), (0, "1.9", "figure", 50, 700, 300, 712)],
    ),
    "fx_cluster": (
        "page_idx int, cluster long, x0 double, y0 double, x1 double, y1 double",
        [(0, 1, 50, 20, 300, 110), (0, 2, 50, 200, 300, 390), (0, 3, 50, 420, 300, 480), (0, 4, 320, 101, 400, 180), (0, 5, 450, 550, 500, 600)],
    ),
    "fx_cell": (
        "page_idx int, table_id int, row_no int, col_no int, x0 double, y0 double, x1 double, y1 double",
        [(0, 1, r, c, c * 100, r * 20, c * 100 + 100, r * 20 + 20) for r in range(3) for c in range(2)],
    ),
    "fx_word": (
        "page_idx int, pos int, x0 double, y0 double, x1 double, y1 double, text string, conf double",
        [(0, 1, 5, 4, 40, 12, "Role", 96), (0, 2, 105, 4, 140, 12, "What", 95), (0, 3, 142, 4.2, 160, 12, "it", 94), (0, 4, 162, 4, 190, 12, "does", 93), (0, 5, 5, 24, 40, 32, "Editor", 97), (0, 6, 105, 24, 140, 32, "reads", 92), (0, 7, 141, 24, 150, 32, "off-", 91), (0, 8, 151, 24, 180, 32, "site", 95), (0, 9, 105, 32, 150, 38, "and", 90), (0, 10, 151, 32, 190, 38, "cuts|pastes", 91), (0, 11, 5, 44, 40, 52, "Author", 98), (0, 12, 41, 44, 60, 52, "team", 97), (0, 13, 105, 44, 140, 52, "writes", 95), (0, 14, 141, 44, 160, 52, "first", 96), (0, 15, 161, 44, 190, 52, "drafts", 95), (0, 16, 105, 54, 140, 59, "daily", 80), (0, 17, 300, 44, 340, 52, "outside", 95), (1, 1, 0, 0, 1, 1, "xqz", 99), (1, 2, 0, 0, 1, 1, "vvv", 98), (2, 1, 0, 0, 1, 1, "the", 60), (2, 2, 0, 0, 1, 1, "that", 70)],
    ),
    "fx_paragraph": (
        "doc_id long, pos int, text string",
        [(1, 1, "# Chapter one"), (1, 2, "In most places there are now fewer natural"), (1, 3, "| a | b |"), (1, 4, "###### History of it"), (1, 5, "A box with its own end."), (1, 6, "resources, and they change."), (1, 7, "The language for all of this is called Unified Modeling"), (1, 8, "![x](y.png)"), (1, 9, "Figure 2.1 A caption"), (1, 10, "of testing"), (1, 11, "Language, or UML."), (1, 12, "- an item that is not text"), (1, 13, "A longer paragraph that ends nowhere at all"), (1, 14, "## Next"), (1, 15, "goes not back over a heading."), (1, 16, "https://example.com/a"), (2, 1, "Whole."), (2, 2, "Also whole.")],
    ),
    "fx_bullet": ("doc_id long, pos int, text string", [(1, 1, "- I understand this"), (1, 2, ""), (1, 3, "- I know that"), (1, 4, "Text."), (1, 5, "- I think alone"), (1, 6, "More."), (2, 1, "- I a"), (2, 2, "- plain"), (2, 3, "- I b"), (2, 4, "- I c")]),
    "fx_raw": (
        "doc_id long, page_idx int, text string",
        [(1, 0, "A service-\ncentric view and devel-\nopment of real-\ntime systems."), (1, 1, "By Addison-\nWesley; DIF-\nFERENCE and the DIFFERENCE. A life-\ntime. The up-\nfront cost, up-front.")],
    ),
    "fx_clean": ("doc_id long, page_idx int, text string", [(1, 0, "A servicecentric view and development of realtime systems."), (1, 1, "By AddisonWesley; DIFFERENCE and the DIFFERENCE. A lifetime. The upfront cost, up-front.")]),
    "fx_numbered": ("doc_id long, page_idx int, printed_no int, text string", [(1, 0, 12, "12 Basics\nText 12\nmiddle\nlast\nfoot 12"), (1, 1, 13, "No number\nhere"), (1, 2, None, "7\nkept")]),
    "fx_term": ("term_id int, source array<string>, target string, forbidden array<string>", [(1, ["the"], "T", ["idiot"]), (2, ["normalisation", "and"], "U", ["ththat", "moron"]), (3, ["zzz", "with by"], "V", None), (4, ["(x)", "des"], "W", ["qu"])]),
    "fx_answer": (
        "chunk_no int, source_text string, answer_text string",
        [(1, "Head\n<!-- page 3 -->One two three.\n![p](img/a.png)\n<!-- page 4 -->" + "word " * 50 + "\n<!-- page 5 -->Lost page.\n<!-- page 6 -->six", "# page 3\n## A\nEins zwei a.png\n## C\n**Note:** x **Note:** y **bold**\n# page 4\n## A\nkurz\n## C\nIn the next section we see.\n# page 9\nextra\n# page 6\nno parts\n# no number\nz"),
         (2, "<!-- page 1 -->ok", "# page 1\n## A\nok\n## C\n**fine** text\n# page 1\nmore")],
    ),
    "fx_slide": ("deck_id long, slide_no int, hidden boolean, title string, items array<string>", [(1, 1, False, "Intro", ["a", "b"]), (1, 2, True, "", ["The plan", "c"]), (1, 3, False, None, ["x"]), (2, 1, False, "Only", ["y"]), (2, 2, True, "Hid", ["z"])]),
    "fx_rendered": ("deck_id long, slide_no int, title string", [(1, 1, "Intro!"), (1, 2, "The  plan"), (1, 3, "Third"), (2, 1, "Only")]),
    "fx_slide_line": (
        "deck_id long, page_idx int, pos int, x0 double, y0 double, x1 double, y1 double, text string, bullet_x double",
        [(1, 0, 1, 40, 100, 90, 112, "Name", None), (1, 0, 2, 150, 101, 200, 113, "Meaning", None), (1, 0, 3, 40, 130, 90, 142, "Row", None), (1, 0, 4, 150, 130, 220, 142, "cost-", None), (1, 0, 5, 151, 146, 220, 158, "effective", None), (1, 0, 6, 41, 165, 90, 177, "Col", None), (1, 0, 7, 150, 164, 220, 176, "down", None), (1, 0, 8, 40, 195, 90, 207, "Key", None), (1, 0, 9, 150, 195, 220, 207, "id", None), (1, 1, 1, 60, 100, 200, 110, "first", 40), (1, 1, 2, 80, 120, 200, 130, "second", 62), (1, 1, 3, 60, 140, 200, 150, "third", 41), (1, 1, 4, 82, 160, 200, 170, "fourth", 60), (1, 1, 5, 90, 180, 200, 190, "plain", None), (1, 1, 6, 90, 500, 200, 510, "Page 2 of 9", None), (1, 0, 10, 90, 500, 200, 510, "Page 1 of 9", None)],
    ),
    "fx_mark": ("deck_id long, page_idx int, mark int, x double, yc double", [(1, 1, 1, 40, 105), (1, 1, 2, 62, 125), (1, 1, 3, 41, 145), (1, 1, 4, 300, 145), (1, 1, 5, 50, 105)]),
    "fx_manifest": ("path string, version string, sha1 string", [("a/x.pdf", "2", "s1"), ("a/y.pdf", "2", "s2"), ("a/z.pdf", "1", "s3"), ("a/gone.pdf", "2", "s9")]),
    "fx_file": ("path string, sha1 string, modified int", [("a/x.pdf", "s1", 5), ("a/y.pdf", "s2b", 7), ("a/z.pdf", "s3", 3), ("a/new.pptx", "s4", 9), ("a/new.pdf", "s5", 9), ("b/new.odp", "s6", 1), ("b/new.ppt", "s7", 1), ("b/~$new.ppt", "s8", 1), ("b/.hidden.pdf", "s8", 1), ("b/note.txt", "s8", 1)]),
    "fx_output": ("path string, modified int", [("a/x.pdf", 6), ("a/y.pdf", 6), ("a/z.pdf", 3)]),
    "fx_torn": ("deck_id long, pos int, text string", [(1, 1, "a haza rd in the plant"), (1, 2, "every hazard counts in to day"), (1, 3, "into the haza rd zone, rd"), (2, 1, "haza rd alone"), (1, 4, "the sys tem and a system to")]),
    "fx_reading": ("page_idx int, reading int, text string, conf double", [(0, 1, "a", 85), (0, 1, "b", 70), (0, 2, "a", 90), (0, 2, "c", 60), (1, 1, "x", 95), (1, 2, "x", 95), (2, 1, "p", 10)]),
    "fx_scan": ("doc_id long, page_idx int, text string, has_image boolean", [(1, 0, "", True), (1, 1, None, True), (1, 2, "short", True), (1, 3, "x", True), (1, 4, "a text that is much longer than that", True), (2, 0, "a text that is much longer than that", True), (2, 1, "", False)]),
}


def frame(spark: SparkSession, name: str) -> DataFrame:
    schema, rows = FIXTURES[name]
    kinds = [c.rsplit(" ", 1)[1] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(float(v) if k == "double" and v is not None else v for v, k in zip(r, kinds, strict=True)) for r in rows], schema)


def _literal(v, kind: str) -> str:
    if v is None:
        return f"NULL::{kind}"
    if isinstance(v, list):
        return f"[{', '.join(_literal(x, 'VARCHAR') for x in v)}]::{kind}"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + f"'::{kind}"
    return f"{str(v).lower() if isinstance(v, bool) else v}::{kind}"


def cte(*names: str) -> str:
    """The fixtures as expressions to stand behind WITH."""
    out = []
    for name in names:
        schema, rows = FIXTURES[name]
        cols = [c.rsplit(" ", 1) for c in schema.split(", ")]
        selects = " UNION ALL ".join("SELECT " + ", ".join(f"{_literal(v, DUCK[k])} AS {c}" for v, (c, k) in zip(r, cols, strict=True)) for r in rows)
        out.append(f"{name} AS ({selects})")
    return ", ".join(out)
