"""Registered queries of composed flows: cleaned chapters, prompts, decks and their packages, reports; and of the repairs that belong to them."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import functions as F

from folio.functions.text import bare, escape_block, heading_case, join_lines, table_cell, without_picture_noise
from folio.operators import book, figures, incremental, pack, slides, textclean, verify, vocab
from folio.plans import fixtures
from folio.plans.derived import cte, frame
from folio.plans.derived_queries import FOOTERS, KEY, PAGES, boxed
from folio.plans.runtime import kept
from folio.plans.text_queries import table
from folio.sources import deck_writer, decks, pictures

Q: dict = {}
O: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            O[f.__name__] = sql
        return f

    return add


# ---- text ----------------------------------------------------------------------------------------


@query(r"SELECT conv_id, turn, regexp_replace(regexp_replace('**' || text || '** <u>#`>', '\*\*|__|~~|</?u>|[#>`]', '', 'g'), '^\s+|\s+$', '', 'g') AS plain FROM conversations")
def plain_lines(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", bare(F.concat(F.lit("**"), "text", F.lit("** <u>#`>"))).alias("plain"))


@query(r"""WITH l AS (SELECT doc_id, n_chars, unnest(string_split(text, chr(10))) AS s, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents), m AS (SELECT doc_id, line_no::INTEGER AS line_no, ['# ', '1. ', '- ', '| '][(n_chars + line_no) % 4 + 1] || trim(s) AS s FROM l)
SELECT doc_id, line_no, CASE WHEN regexp_matches(s, '^(#|>|\d+[.)]\s|[-+*]\s)') THEN '\' || regexp_replace(s, '\s+$', '') ELSE regexp_replace(s, '\s+$', '') END AS line, regexp_replace(replace(s, '|', '\|'), '\s+$', '') AS cell FROM m""")
def escaped_lines(spark, sf):
    """All lines of the documents, behind signs that markdown would read."""
    lines_ = table(spark, sf, "documents").select("doc_id", "n_chars", F.posexplode(F.split("text", "\n")).alias("line_no", "s"))
    mark = F.element_at(F.array(*map(F.lit, ("# ", "1. ", "- ", "| "))), ((F.col("n_chars") + F.col("line_no")) % 4 + 1).cast("int"))
    rows = lines_.select("doc_id", "line_no", F.concat(mark, F.trim("s")).alias("s"))
    return rows.select("doc_id", "line_no", escape_block(F.col("s")).alias("line"), table_cell(F.col("s")).alias("cell"))


@query(rf"""WITH {cte('dx_stack')}, n AS (SELECT page_idx, pos, text || CASE WHEN pos % 2 = 0 THEN 'ab-' ELSE '  ' END AS a, lead(text) OVER (PARTITION BY page_idx ORDER BY pos) AS b FROM dx_stack)
SELECT page_idx, pos, CASE WHEN pos % 2 = 0 AND regexp_matches(b, '^\p{{L}}') THEN a || b ELSE rtrim(a) || ' ' || b END AS joined FROM n WHERE b IS NOT NULL""")
def joined_lines(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("page_idx").orderBy("pos")
    rows = frame(spark, sf, "dx_stack").select("page_idx", "pos", F.concat("text", F.when(F.col("pos") % 2 == 0, "ab-").otherwise("  ")).alias("a"), F.lead("text").over(w).alias("b"))
    return rows.filter("b IS NOT NULL").select("page_idx", "pos", join_lines(F.col("a"), F.col("b")).alias("joined"))


@query(rf"""WITH {cte('dx_odd')}, p AS (SELECT o, pos, CASE WHEN pos % 2 = 0 THEN '## ' ELSE '' END || text AS t FROM dx_odd),
w AS (SELECT o, pos, t, list_transform(regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]+'), lambda x: CASE WHEN length(x) >= 4 AND upper(x) <> x AND regexp_full_match(x, '[A-Za-z]+') AND (regexp_matches(x, '^[a-z].*[A-Z]') OR len(regexp_extract_all(x, '[a-z][A-Z]')) >= 2) THEN upper(x[1]) || lower(x[2:]) ELSE x END) AS parts FROM p)
SELECT o, pos, CASE WHEN pos % 2 = 0 THEN array_to_string(parts, '') ELSE t END AS line FROM w""")
def heading_words(spark, sf):
    """Words of odd case, in headings only."""
    t = F.concat(F.when(F.col("pos") % 2 == 0, "## ").otherwise(""), "text")
    return frame(spark, sf, "dx_odd").select("o", "pos", heading_case(t).alias("line"))


NOISE = r"""n AS (SELECT o, pos, CASE q % 4 WHEN 0 THEN 'the plan of ' || text WHEN 1 THEN 'x1 9 ' || flag || ' q' WHEN 2 THEN text || '<br>A B C D' ELSE '' END AS inner_text FROM dx_item JOIN dx_odd USING (o, pos)),
k AS (SELECT o, pos, inner_text, list_filter(string_split_regex(inner_text, '<br>|\s+'), lambda x: x <> '') AS t FROM n)"""


@query(rf"""WITH {cte('dx_item', 'dx_odd')}, {NOISE}
SELECT o, pos, 'Before' || chr(10) || CASE WHEN len(t) > 0 AND 2 * len(list_filter(t, lambda x: regexp_matches(x, '^\p{{L}}[\p{{Ll}}''’-]{{2,}}[.,;:]?$'))) >= len(t) THEN inner_text ELSE '' END || chr(10) || 'after' AS text FROM k""")
def picture_text(spark, sf):
    """Text read within pictures stays if half of its tokens are words."""
    n = F.col("q") % 4
    inner = F.when(n == 0, F.concat(F.lit("the plan of "), "text")).when(n == 1, F.concat(F.lit("x1 9 "), "flag", F.lit(" q"))).when(n == 2, F.concat("text", F.lit("<br>A B C D"))).otherwise("")
    rows = frame(spark, sf, "dx_item").join(frame(spark, sf, "dx_odd"), ["o", "pos"])
    whole = F.concat(F.lit("Before\n<!-- Start of picture text -->"), inner, F.lit("<!-- End of picture text -->\nafter"))
    return rows.select("o", "pos", without_picture_noise(whole).alias("text"))


def _chapters(spark, sf):
    """Each conversation as a chapter: its turns are pages of two lines, of which the first is the chapter's running header."""
    turns = table(spark, sf, "conversations")
    pages = turns.select("conv_id", F.col("turn").cast("int").alias("page_idx"), F.when(F.col("turn") % 3 != 2, F.col("turn").cast("int") + 1).alias("printed_no"), F.concat(F.lit("Talk "), F.col("conv_id").cast("string"), F.lit("\n"), "text").alias("text"), F.lit(800.0).alias("height"), F.lit(0).alias("page_offset"))
    figs = turns.filter("turn % 2 = 1").select("conv_id", F.col("turn").cast("int").alias("page_idx"), F.lit("figure").alias("kind"), F.concat(F.lit("1."), F.col("turn").cast("string")).alias("no"), F.lit("A part").alias("title"), F.concat(F.lit("figure-1."), F.col("turn").cast("string"), F.lit(".png")).alias("file_name"),
                                               F.struct(*[F.lit(v).alias(n) for n, v in (("x0", 0.0), ("y0", 500.0), ("x1", 90.0), ("y1", 600.0))]).alias("box"), F.lit("").alias("labels"), F.lit(None).cast("string").alias("table_md"))
    return textclean.with_links(pages, figs, ["conv_id", "page_idx"])


@query(r"""SELECT conv_id, turn::INTEGER AS page_idx, '<!-- page ' || (turn + 1) || ' · printed ' || (turn + 1) || ' -->' AS before, CASE WHEN turn % 2 = 1 THEN '![Figure 1.' || turn || ': A part](figures/figure-1.' || turn || '.png)' ELSE '' END AS after FROM conversations""")
def page_links(spark, sf):
    """A page's marker, and the links of its figures before or after the text by the half of the page they stand in."""
    return _chapters(spark, sf).select("conv_id", "page_idx", "before", "after")


@query()
def chapters_cleaned(spark, sf):
    """Every cleaning step in its fixed order, for each conversation as a chapter; tests compare it with plain Python."""
    return textclean.clean_chapters(_chapters(spark, sf), ["conv_id"])


STUDY = "p. {range} ({no}/{count}) {images}\n{outline}\n{terms}\n{note}\n{text}"


@query(rf"""WITH RECURSIVE {fixtures.cte('fx_term')}, t AS (SELECT conv_id, turn, '<!-- page ' || (turn + 1) || ' -->' || chr(10) || '## Turn ' || turn || chr(10) || text || CASE WHEN turn % 2 = 1 THEN chr(10) || '![f](a/f' || turn || '.png)' ELSE '' END || chr(10) || chr(10) AS text FROM conversations),
s AS (SELECT conv_id, turn, text, len(regexp_extract_all(regexp_replace(text, '!\[[^\]]*\]\([^)]*\)|<!--.*?-->', '', 'g'), '\S+')) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM t),
k AS (SELECT conv_id, turn, text, n, i, n AS filled, 1 AS chunk_no FROM s WHERE i = 1 UNION ALL SELECT s.conv_id, s.turn, s.text, s.n, s.i, CASE WHEN k.filled + s.n > 90 THEN s.n ELSE k.filled + s.n END, k.chunk_no + (k.filled + s.n > 90)::INTEGER FROM k JOIN s ON s.conv_id = k.conv_id AND s.i = k.i + 1),
c AS (SELECT conv_id, chunk_no, string_agg(text, '' ORDER BY turn) AS body, min(turn) + 1 AS first_page, max(turn) + 1 AS last_page, count(*) AS pages FROM k GROUP BY ALL), m AS (SELECT conv_id, max(chunk_no) AS n_chunks, max(turn) AS last FROM k GROUP BY 1),
whole AS (SELECT conv_id, string_agg(text, '' ORDER BY turn) AS md FROM t GROUP BY 1), o AS (SELECT conv_id, string_agg('- Turn ' || turn, chr(10) ORDER BY turn) AS outline FROM t GROUP BY 1),
v AS (SELECT term_id, target, source, unnest(source) AS variant FROM fx_term), p AS (SELECT *, '(?i)(^|[^A-Za-z])' || replace(regexp_replace(variant, '([.\\+*?\[\](){{}}^$|])', '\\\1', 'g'), 'isation', 'i[sz]ation') AS pattern FROM v),
h AS (SELECT DISTINCT conv_id, term_id, array_to_string(source, ' / ') AS source, target FROM whole JOIN p ON regexp_matches(md, pattern)), g AS (SELECT conv_id, string_agg('- ' || source || ' -> ' || target, chr(10) ORDER BY term_id) AS terms FROM h GROUP BY 1),
i AS (SELECT *, list_transform(regexp_extract_all(body, '!\[[^\]]*\]\([^)]+\)'), lambda x: regexp_extract(x, '([^/]+)\)$', 1)) AS images FROM c)
SELECT i.conv_id, chunk_no, n_chunks, first_page::INTEGER AS first_page, last_page::INTEGER AS last_page, len(images)::INTEGER AS n_images, 'p. page ' || first_page || CASE WHEN pages > 1 THEN ' – page ' || last_page ELSE '' END || ' (' || chunk_no || '/' || n_chunks || ') ' || CASE WHEN len(images) > 0 THEN 'Pictures of these pages: ' || array_to_string(images, ', ') ELSE '' END || chr(10) || outline || chr(10) || coalesce(terms, '-') || chr(10)
  || CASE WHEN chunk_no = 1 THEN 'First.' ELSE '' END || CASE WHEN chunk_no = n_chunks THEN 'Last.' ELSE '' END || chr(10) || regexp_replace(body, '^\s+|\s+$', '', 'g') AS prompt
FROM i JOIN m USING (conv_id) JOIN o USING (conv_id) LEFT JOIN g USING (conv_id)""")
def study_prompts(spark, sf):
    """Chapters with page markers (conversations), packed and put into a template with pictures, outline, terms and notes."""
    page = F.concat(F.lit("<!-- page "), (F.col("turn") + 1).cast("string"), F.lit(" -->\n## Turn "), F.col("turn").cast("string"), F.lit("\n"), "text", F.when(F.col("turn") % 2 == 1, F.concat(F.lit("\n![f](a/f"), F.col("turn").cast("string"), F.lit(".png)"))).otherwise(""), F.lit("\n\n"))
    chapters = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", page.alias("t")))), lambda p: p["t"]), "").alias("md"))
    return pack.study_prompts(chapters, "conv_id", STUDY, fixtures.frame(spark, "fx_term"), "First.", "Last.", budget=90)


def _books(spark, sf):
    """Five conversations as a book: a page of contents, then a page a turn with its printed number; every third book has bookmarks, every third neither
    these nor contents."""
    from pyspark.sql import Window

    turns = table(spark, sf, "conversations").select("conv_id", "turn", "text").withColumn("book_id", F.floor(F.col("conv_id") / 5))
    n = F.row_number().over(Window.partitionBy("book_id").orderBy("conv_id", "turn", "text"))
    body = turns.withColumn("page_idx", n)
    starts = body.groupBy("book_id", "conv_id").agg(F.min("page_idx").alias("start")).withColumn("no", (F.col("conv_id") % 5 + 1).cast("string"))
    entry = F.concat(F.lit("Chapter "), "no", F.lit(" Talk "), F.col("conv_id").cast("string"), F.lit(" of it "), F.col("start").cast("string"))
    contents = starts.groupBy("book_id").agg(F.array_sort(F.collect_list(F.struct("start", entry.alias("e")))).alias("l"))
    front = contents.select("book_id", F.lit(0).alias("page_idx"), F.when(F.col("book_id") % 3 != 2, F.concat(F.lit("Contents\n"), F.array_join(F.transform("l", lambda x: x["e"]), "\n"))).otherwise("A book").alias("text"))
    pages = front.unionByName(body.select("book_id", "page_idx", F.concat(F.lit("Talks\n"), "text", F.lit("\n"), F.col("page_idx").cast("string")).alias("text"))).withColumn("height", F.lit(800.0))
    bookmarks = starts.filter("book_id % 3 = 0").select("book_id", F.col("start").alias("pos"), F.lit(1).alias("level"), F.concat(F.lit("Chapter "), "no", F.lit(": Talk "), F.col("conv_id").cast("string")).alias("title"), (F.col("start") + 1).alias("page"))
    documents = pages.groupBy("book_id").agg(F.count(F.lit(1)).cast("int").alias("n_pages")).withColumn("name", F.concat(F.lit("Talks, volume "), (F.floor(F.col("book_id") / 2)).cast("string")))
    box = F.struct(*[F.lit(v).alias(k) for k, v in (("x0", 0.0), ("y0", 500.0), ("x1", 90.0), ("y1", 600.0))])
    figs = body.filter("turn % 2 = 1").select("book_id", "page_idx", F.lit("figure").alias("kind"), F.col("page_idx").cast("string").alias("no"), F.lit("A part").alias("title"), F.concat(F.lit("figure-"), F.col("page_idx").cast("string"), F.lit(".png")).alias("file_name"), box.alias("box"), F.lit("").alias("labels"), F.lit(None).cast("string").alias("table_md"))
    return pages, bookmarks, documents, figs


@query()
def book_package(spark, sf):
    """All files of the packages of books, from their pages: chapters, study prompts, instructions and an index; held by tests/test_book.py."""
    pages, bookmarks, documents, figs = (kept(t, "book-input") for t in _books(spark, sf))  # as a decoded book would lie there
    return book.book_files(pages, bookmarks, documents, figs, fixtures.frame(spark, "fx_term"), ["book_id"], STUDY, budget=90)


@query(f"WITH {cte('dx_item')}, n AS (SELECT o, count(*) AS n_chunks FROM dx_item WHERE q > 25 GROUP BY 1), c AS (SELECT DISTINCT o FROM dx_item) SELECT o, 'Chapter ' || o || ' (c' || o || '): ' || n_chunks || ' parts' AS instructions FROM c JOIN n USING (o)")
def chunk_instructions(spark, sf):
    items = frame(spark, sf, "dx_item")
    text = F.col("o").cast("string")
    chapters = items.select("o", F.concat(F.lit("Chapter "), text).alias("label"), F.lit("").alias("title"), F.concat(F.lit("c"), text).alias("name")).distinct()
    return pack.instructions(chapters, items.filter("q > 25").groupBy("o").agg(F.count(F.lit(1)).alias("n_chunks")), ["o"], "{label}{title} ({name}): {count} parts")


# ---- vocabulary ----------------------------------------------------------------------------------


WORDS = r"""v AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS word FROM documents) GROUP BY 1), known AS (SELECT word, n FROM v WHERE n >= 5)"""


@query(rf"""WITH {WORDS}, rare AS (SELECT word FROM v WHERE n < 5 AND length(word) >= 4), c AS (SELECT word, unnest(range(1, length(word))) AS cut FROM rare), p AS (SELECT DISTINCT substr(word, 1, 1) AS first, substr(word, 2) AS second FROM rare),
odd AS (SELECT first, second FROM p WHERE first NOT IN (SELECT word FROM known)), cuts AS (SELECT first, second, first || second AS w, unnest(range(1, length(first || second))) AS cut FROM odd),
b AS (SELECT first, second, l.word AS "left", r.word AS "right", row_number() OVER (PARTITION BY first, second ORDER BY least(l.n, r.n) DESC, cut) AS i FROM cuts JOIN known l ON l.word = substr(w, 1, cut) JOIN known r ON r.word = substr(w, cut + 1) WHERE (length(l.word) > 1 OR l.word IN ('a', 'i')) AND (length(r.word) > 1 OR r.word IN ('a', 'i')))
SELECT first, second, "left", "right" FROM b WHERE i = 1""")
def shifted_gaps(spark, sf):
    """Rare words with a space behind their first letter, cut anew where both parts are known."""
    v = vocab.vocabulary(table(spark, sf, "documents"), [])
    rare = v.filter((F.col("n") < 5) & (F.length("word") >= 4))
    pairs = rare.select(F.substring("word", 1, 1).alias("first"), F.expr("substring(word, 2)").alias("second")).distinct()
    return vocab.shifted_gaps(pairs, v.filter("n >= 5"))


@query(rf"""WITH {WORDS}, w AS (SELECT DISTINCT 'İ' || substr(word, 2) AS word FROM v WHERE word[1] = 'i'), f AS (SELECT word, 'I' || substr(word, 2) AS fixed FROM w) SELECT word, fixed FROM f WHERE lower(fixed) IN (SELECT word FROM known)""")
def plain_i_words(spark, sf):
    v = vocab.vocabulary(table(spark, sf, "documents"), [])
    words = v.filter(F.col("word").startswith("i")).select(F.concat(F.lit("İ"), F.expr("substring(word, 2)")).alias("word"))
    return vocab.plain_i(words, v.filter("n >= 5"))


@query()
def split_word_log(spark, sf):
    """What split_word_repair joined, round by round."""
    return vocab.repair_with_log(fixtures.frame(spark, "fx_torn"), ["deck_id"])[1]


# ---- figures -------------------------------------------------------------------------------------


@query(f"""WITH {cte('dx_stack', 'dx_figure')}, s AS (SELECT page_idx, pos // 2 AS block_no, pos % 2 AS line_no, 'F' || (pos % 3) || ' ' || round_even(size, 0)::INTEGER AS font, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y FROM dx_stack),
m AS (SELECT f.page_idx, no, count(DISTINCT (block_no, line_no)) AS n_lines, array_to_string(list_sort(list_distinct(list(font))), ',') AS fonts FROM dx_figure f JOIN s ON s.page_idx = f.page_idx AND x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 GROUP BY ALL)
SELECT f.page_idx, f.no, coalesce(n_lines, 0) AS n_lines, coalesce(fonts, '') AS fonts FROM dx_figure f LEFT JOIN m ON m.page_idx = f.page_idx AND m.no = f.no""")
def figure_fonts(spark, sf):
    spans = boxed(spark, sf, "dx_stack").withColumn("block_no", F.floor(F.col("pos") / 2)).withColumn("line_no", F.col("pos") % 2).withColumn("font", F.concat(F.lit("F"), (F.col("pos") % 3).cast("string")))
    return figures.fonts_within(spans, boxed(spark, sf, "dx_figure"), ["page_idx"]).withColumn("fonts", F.array_join("fonts", ","))


@query(f"""WITH {cte('dx_box')}, p AS (SELECT set_id, box_id AS cluster, x0, y0, x1, y1, pos % 2 = 0 AS drawn, pos % 3 AS n_lines FROM dx_box WHERE pos > 1), f AS (SELECT set_id, 'A' AS no, x0 + 80 AS x0, y0 + 80 AS y0, x1 + 80 AS x1, y1 + 80 AS y1, 1 AS n_lines, 'F1' AS font FROM dx_box WHERE pos = 1),
c AS (SELECT p.set_id, cluster, no, greatest(0, greatest(p.x0, f.x0) - least(p.x1, f.x1), greatest(p.y0, f.y0) - least(p.y1, f.y1)) AS gap, drawn, p.n_lines AS k FROM p JOIN f ON f.set_id = p.set_id)
SELECT set_id, cluster, no FROM c WHERE gap >= 30 AND gap < 90 AND (drawn OR k > 1) AND (k = 0 OR cluster % 2 = 1)""")
def far_parts(spark, sf):
    """Parts that share a font with the figure's text, or have none."""
    rows = boxed(spark, sf, "dx_box")
    parts = rows.filter("pos > 1").select("set_id", F.col("box_id").alias("cluster"), "box", (F.col("pos") % 2 == 0).alias("drawn"), (F.col("pos") % 3).alias("n_lines"), F.array(F.when(F.col("box_id") % 2 == 1, "F1").otherwise("F2")).alias("fonts"))
    b = F.col("box")
    figs = rows.filter("pos = 1").select("set_id", F.lit("A").alias("no"), F.struct(*[(b[c] + 80).alias(c) for c in ("x0", "y0", "x1", "y1")]).alias("box"), F.lit(1).alias("n_lines"), F.array(F.lit("F1")).alias("fonts"))
    return figures.far_parts(parts, figs, figs.select("set_id", "no", F.col("box").alias("caption_box")), ["set_id"])


# ---- decks ---------------------------------------------------------------------------------------


ROUND = r"""t AS (SELECT conv_id, turn + 1 AS slide_no, role, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS l FROM conversations)"""


def _files(write):
    """(path, rows) to (path, content): files written some at a time."""

    def made(batches):
        for b in decks.slices(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), write(b.column(1))], names=["path", "content"])

    return made


def _written(turns: pa.Array) -> pa.Array:
    """array<struct<turn, role, text>> to a deck: a slide a turn, with its lines as items, a table, a hidden mark on every fifth, and notes."""
    out = []
    for rows in turns.to_pylist():
        made = []
        for r in rows:
            told = [x for x in r["text"].split("\n") if x.strip()]
            shapes = [deck_writer.text([(i % 2, x) for i, x in enumerate(told)], 200, "body"), deck_writer.text([(0, r["role"])], 20, "title"), deck_writer.table([["lines", "a|b"], [str(len(told)), ""]], 400)]
            made.append({"shapes": shapes, "hidden": r["turn"] % 5 == 4, "notes": [f"turn {r['turn']}", "end"]})
        out.append(deck_writer.deck(made))
    return pa.array(out, pa.binary())


@query(rf"""WITH {ROUND} SELECT conv_id, slide_no::INTEGER AS slide_no, (slide_no - 1) % 5 = 4 AS hidden, role AS title, array_to_string(list_transform(l, lambda x, i: 'item ' || ((i - 1) % 2) || ' ' || x) || ['table 0 | lines | a\|b |', 'table 0 | ' || len(l) || ' |  |'], chr(10)) AS items, '' AS flags, 'turn ' || (slide_no - 1) || chr(10) || 'end' AS notes FROM t""")
def deck_round_trip(spark, sf):
    """Conversations written as .pptx decks and read back: titles, items with levels, tables, hidden slides and notes."""
    talks = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    files = talks.select(F.col("conv_id").cast("string").alias("path"), "t").mapInArrow(_files(_written), "path string, content binary")
    read = decks.slides(decks.parsed(files))
    items = F.transform("items", lambda x: F.concat_ws(" ", x["kind"], x["level"].cast("string"), x["text"]))
    return read.select(F.col("path").cast("long").alias("conv_id"), "slide_no", "hidden", "title", F.array_join(items, "\n").alias("items"), F.array_join("flags", ",").alias("flags"), "notes")


def png_head(n: int, wide: int, high: int) -> bytes:
    """The beginning of a picture of that size, and a number for what it shows."""
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", wide, high) + struct.pack(">I", n)


def _pictured(slides_: pa.Array) -> pa.Array:
    """array<struct<page_idx, pictures array<struct<pos, p, q>>>> to a deck: a slide a page, with its pictures."""
    out = []
    for rows in slides_.to_pylist():
        made = []
        for r in rows:
            names = {f"r{x['pos']}": f"ppt/media/s{r['page_idx']}-{x['pos']}.png" for x in r["pictures"]}
            parts = {names[f"r{x['pos']}"]: png_head(x["p"] % 9, 30 + x["p"] % 9 * 10, 40 + x["p"] % 9) for x in r["pictures"]}
            made.append({"shapes": [deck_writer.picture(k, 100) for k in names], "links": names, "parts": parts})
        out.append(deck_writer.deck(made))
    return pa.array(out, pa.binary())


@query(f"""WITH {cte('dx_item')}, i AS (SELECT floor(o / 20)::BIGINT AS deck_id, o, pos, p % 9 AS n FROM dx_item), s AS (SELECT *, dense_rank() OVER (PARTITION BY deck_id ORDER BY o) AS slide_no FROM i), k AS (SELECT deck_id, n, min((slide_no, pos)) AS first, count(*) AS times FROM s WHERE least(30 + n * 10, 40 + n) >= 48 GROUP BY ALL)
SELECT deck_id, first[1]::INTEGER AS slide_no, (first[2] - 1)::INTEGER AS place, (30 + n * 10)::INTEGER AS width, (40 + n)::INTEGER AS height, times AS n FROM k""")
def deck_pictures(spark, sf):
    """Pictures of decks written with them and read back: equal ones once, small ones not at all."""
    items = frame(spark, sf, "dx_item").select(F.floor(F.col("o") / 20).alias("deck_id"), F.col("o").alias("page_idx"), "pos", "p", "q")
    pages = items.groupBy("deck_id", "page_idx").agg(F.array_sort(F.collect_list(F.struct("pos", "p", "q"))).alias("pictures"))
    decks_ = pages.groupBy("deck_id").agg(F.array_sort(F.collect_list(F.struct("page_idx", "pictures"))).alias("s"))
    files = decks_.select(F.col("deck_id").cast("string").alias("path"), "s").mapInArrow(_files(_pictured), "path string, content binary")
    return pictures.once(pictures.embedded(files)).select(F.col("path").cast("long").alias("deck_id"), "slide_no", "place", "width", "height", "n")


@query(f"""WITH {cte('dx_box')}, i AS (SELECT set_id, box_id, (x1 - x0) * (y1 - y0) / (60.0 * 30) AS share FROM dx_box), r AS (SELECT *, row_number() OVER (PARTITION BY set_id ORDER BY share DESC, box_id) AS k FROM i WHERE share > 0.3) SELECT set_id, box_id FROM r WHERE k = 1""")
def page_images(spark, sf):
    return pictures.page_image(boxed(spark, sf, "dx_box"), ["set_id"], 60.0, 30.0, "box_id")


@query(f"""WITH {cte('dx_line')}, k AS (SELECT *, regexp_replace({KEY}, '\\s+', ' ', 'g') AS footer, y0 > 0.88 * 540 OR y0 < 0.08 * 540 AS edge FROM dx_line), d AS (SELECT deck_id, count(DISTINCT page_idx) AS slides FROM dx_line GROUP BY 1),
f AS (SELECT k.deck_id, footer FROM k JOIN d USING (deck_id) WHERE edge AND footer <> '' GROUP BY k.deck_id, footer, slides HAVING count(DISTINCT page_idx) >= greatest(2, slides // 2)),
s AS (SELECT k.*, y1 - y0 AS h, y0 < 0.28 * 540 AS top FROM k LEFT JOIN f ON f.deck_id = k.deck_id AND f.footer = k.footer WHERE f.footer IS NULL OR NOT edge), m AS (SELECT deck_id, page_idx, list_sort(list(h))[count(*) // 2 + 1] AS median FROM s GROUP BY ALL),
r AS (SELECT s.*, median, row_number() OVER (PARTITION BY s.deck_id, s.page_idx ORDER BY CASE WHEN top THEN h END DESC NULLS LAST, y0, pos) AS i FROM s JOIN m ON m.deck_id = s.deck_id AND m.page_idx = s.page_idx)
SELECT deck_id, page_idx, pos, CASE WHEN i = 1 AND top AND h >= 1.15 * median AND bullet_x IS NULL THEN 'title' WHEN bullet_x IS NOT NULL THEN 'item' ELSE 'paragraph' END AS role, text FROM r""")
def text_slides(spark, sf):
    """Decks with a text layer, without the lines that repeat at the edges."""
    return slides.text_slides(boxed(spark, sf, "dx_line"), ["deck_id"])[0].drop("level")


@query(f"""WITH {cte('dx_slide', 'dx_rendered')}, s AS (SELECT deck_id, count(*) AS n, sum((NOT hidden)::INTEGER) AS shown FROM dx_slide GROUP BY 1), r AS (SELECT deck_id, count(*) AS pages FROM dx_rendered GROUP BY 1)
SELECT deck_id, CASE WHEN deck_id % 4 <> 0 THEN CASE WHEN deck_id % 5 <> 0 AND (pages = n OR pages = shown) THEN 'presentation and pdf' ELSE 'presentation and rendering' END WHEN deck_id % 5 <> 0 THEN CASE WHEN deck_id % 3 = 0 THEN 'pdf' ELSE 'pdf of images' END END AS way FROM s LEFT JOIN r USING (deck_id)""")
def deck_ways(spark, sf):
    """How each deck is read, by what files it has and whether their pages fit."""
    s = frame(spark, sf, "dx_slide").groupBy("deck_id").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(~F.col("hidden"), 1)).alias("shown"))
    rows = s.join(frame(spark, sf, "dx_rendered").groupBy("deck_id").agg(F.count(F.lit(1)).alias("pages")), "deck_id", "left")
    some = lambda n: F.when(F.col("deck_id") % n != 0, "file")
    return rows.select("deck_id", incremental.reading_way(some(4), some(5), F.col("n"), F.col("shown"), F.col("pages"), F.col("deck_id") % 3 == 0).alias("way"))


@query(f"""WITH {cte('dx_slide')}, s AS (SELECT *, slide_no % 3 = 0 AS t, slide_no % 4 = 0 AS nn, slide_no % 2 = 0 AS image, CASE WHEN slide_no % 6 <> 0 THEN slide_no * 5 END AS rate, CASE WHEN slide_no % 5 = 0 THEN ['chart', 'a|b'] ELSE [] END AS flags FROM dx_slide),
l AS (SELECT *, '| ' || slide_no || ' | ' || CASE WHEN coalesce(trim(title), '') = '' THEN '–' ELSE trim(title) END || ' | ' || CASE WHEN t THEN 'yes' ELSE '' END || ' | ' || CASE WHEN nn THEN 'yes' ELSE '' END || ' | ' || coalesce(rate || ' %', '–') || ' | ' || CASE WHEN len(flags) > 0 THEN 'chart; a\\|b' ELSE '–' END || ' |' AS line FROM s)
SELECT deck_id, count(*) AS n_slides, count(*) FILTER (WHERE image) AS n_images, count(*) FILTER (WHERE len(flags) > 0) AS n_flagged, count(*) FILTER (WHERE hidden) AS n_hidden, '| # | Title | Table | Notes | Coverage | Flags |' || chr(10) || '|---|---|---|---|---|---|' || chr(10) || string_agg(line, chr(10) ORDER BY slide_no) AS index_md FROM l GROUP BY 1""")
def deck_packages(spark, sf):
    """The index of each deck's package."""
    n = F.col("slide_no")
    rows = frame(spark, sf, "dx_slide").select("deck_id", "slide_no", "title", "hidden", (n % 3 == 0).alias("has_table"), (n % 4 == 0).alias("has_notes"), (n % 2 == 0).alias("image"), F.when(n % 6 != 0, n * 0.05).alias("rate"), F.when(n % 5 == 0, F.array(F.lit("chart"), F.lit("a|b"))).otherwise(F.array().cast("array<string>")).alias("flags"))
    return slides.deck_index(rows, ["deck_id"])


@query(f"""WITH {cte('dx_box')}, w AS (SELECT set_id, box_id % 2 AS line_no, x0, x1, y0, y1, ['©', 'Part', '%', '12 x', 'ab', '-'][pos % 6 + 1] AS text FROM dx_box),
r AS (SELECT *, row_number() OVER (PARTITION BY set_id, line_no ORDER BY x0, x1, text) AS i, max(y1) OVER l - min(y0) OVER l AS h FROM w WINDOW l AS (PARTITION BY set_id, line_no)),
p AS (SELECT a.set_id, a.line_no, a.x0 AS bullet_x, b.x0 AS x0, a.text AS mark, b.text AS next, b.x0 - a.x1 AS apart, a.h FROM r a JOIN r b ON b.set_id = a.set_id AND b.line_no = a.line_no AND a.i = 1 AND b.i = 2),
t AS (SELECT set_id, line_no, string_agg(text, ' ' ORDER BY i) AS text FROM r WHERE i > 1 GROUP BY ALL)
SELECT set_id, line_no, bullet_x, text, x0 FROM p JOIN t USING (set_id, line_no) WHERE (mark IN ('©', '-') OR (mark = '%' AND apart >= 0.5 * greatest(8, h))) AND regexp_matches(next, '^[\\p{{Lu}}\\p{{N}}]')""")
def read_bullets(spark, sf):
    """Lines whose bullet OCR took for a sign."""
    text = F.element_at(F.array(*map(F.lit, ("©", "Part", "%", "12 x", "ab", "-"))), F.col("pos") % 6 + 1)
    return slides.read_bullets(boxed(spark, sf, "dx_box").select("set_id", (F.col("box_id") % 2).alias("line_no"), "box", text.alias("text")), ["set_id", "line_no"])


@query(f"""WITH {cte('dx_figure', 'dx_ink')}, l AS (SELECT page_idx, no AS line_no, x0 + 40 AS x0, y0 + 20 AS y0, y0 + 34 AS y1, 14.0 AS h FROM dx_figure), k AS (SELECT l.*, gx, gy FROM l JOIN (SELECT DISTINCT * FROM dx_ink) i ON i.page_idx = l.page_idx AND gx * 2 >= greatest(0, x0 - 4.5 * h) AND gx * 2 < greatest(0, x0 - 0.3 * h) AND gy * 2 >= (y0 + y1) / 2 - 0.5 * h AND gy * 2 < (y0 + y1) / 2 + 0.5 * h),
b AS (SELECT page_idx, line_no, x0, h, min(gx) AS a, max(gx) AS z, count(DISTINCT gx) AS n, count(DISTINCT gy) AS high FROM k GROUP BY ALL)
SELECT page_idx, line_no, (a * 2)::DOUBLE AS bullet_x FROM b WHERE z - a + 1 = n AND n * 2 <= 0.8 * h AND high * 2 <= 0.8 * h AND greatest(0, x0 - 0.3 * h) - (z + 1) * 2 >= 0.2 * h""")
def blob_bullets(spark, sf):
    """Lines with one small dark blob to their left."""
    b = F.col("box")
    box = F.struct((b["x0"] + 40).alias("x0"), (b["y0"] + 20).alias("y0"), (b["x1"] + 40).alias("x1"), (b["y0"] + 34).alias("y1"))
    lines_ = boxed(spark, sf, "dx_figure").select("page_idx", F.col("no").alias("line_no"), box.alias("box"))
    return slides.blob_bullets(lines_, frame(spark, sf, "dx_ink"), ["page_idx"])


@query(f"""WITH {cte('dx_item')}, b AS (SELECT o, max(q) * 10 AS height, count(*) FILTER (WHERE flag = 'A') AS before, count(*) FILTER (WHERE flag <> 'R') AS after FROM dx_item GROUP BY 1) SELECT o, height >= 108 AND before < 8 AND after > before AS again FROM b""")
def bands_reread(spark, sf):
    """Which reading of a band of a page counts."""
    items = frame(spark, sf, "dx_item")
    bands = items.groupBy("o").agg((F.max("q") * 10.0).alias("bottom")).withColumn("top", F.lit(0.0))
    return slides.reread(bands, items.filter("flag = 'A'"), items.filter("flag <> 'R'"), ["o"], 540.0)


@query(f"""WITH {cte('dx_item')}, r AS (SELECT o, pos, q % 5 >= 3 AND p % 8 >= 0.75 * 6 AS t, s % 10 AS n, q AS c FROM dx_item), k AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY t DESC, n DESC, c DESC, pos) AS i FROM r) SELECT o, pos AS reading FROM k WHERE i = 1""")
def best_structures(spark, sf):
    """Of several readings the one with a table, then with more words, then the surer."""
    rows = frame(spark, sf, "dx_item").select("o", F.col("pos").alias("reading"), (F.col("q") % 5).alias("n_rows"), F.lit(6).alias("n_cells"), (F.col("p") % 8).alias("n_filled"), (F.col("s") % 10).alias("n_words"), F.col("q").alias("confidence"))
    return slides.best_structure(rows, ["o"])


# ---- checks --------------------------------------------------------------------------------------


@query(rf"""WITH c AS (SELECT conv_id, turn, text AS s, substr(text, 1, 200) || ' extra repaired' AS o, 'repaired' AS e, turn % 2 = 0 AS deck, conv_id % 3 = 0 AS chart FROM conversations),
t AS (SELECT *, regexp_extract_all(lower(s), '[\p{{L}}\p{{N}}]+') AS a, regexp_extract_all(lower(o), '[\p{{L}}\p{{N}}]+') AS b FROM c),
m AS (SELECT conv_id, turn, sum(greatest(x - y, 0))::BIGINT AS m, sum(greatest(y - x, 0))::BIGINT AS e FROM (SELECT conv_id, turn, w, sum(i) AS x, sum(j) AS y FROM (SELECT conv_id, turn, unnest(a) AS w, 1 AS i, 0 AS j FROM t UNION ALL SELECT conv_id, turn, unnest(b), 0, 1 FROM t) WHERE w <> 'repaired' GROUP BY ALL) GROUP BY ALL),
k AS (SELECT t.conv_id, t.turn, deck, chart, CASE WHEN deck THEN len(list_distinct(a)) ELSE len(a) END AS total, CASE WHEN deck THEN len(list_filter(list_distinct(a), lambda x: NOT list_contains(b, x) AND x <> 'repaired')) ELSE coalesce(m.m, 0) END AS missing, CASE WHEN deck THEN len(list_filter(list_distinct(b), lambda x: NOT list_contains(a, x) AND x <> 'repaired')) ELSE coalesce(m.e, 0) END AS extra FROM t LEFT JOIN m ON m.conv_id = t.conv_id AND m.turn = t.turn),
r AS (SELECT *, CASE WHEN total > 0 THEN 1 - missing / total ELSE 1.0 END::DOUBLE AS rate FROM k)
SELECT conv_id, turn, total::BIGINT AS total, missing::BIGINT AS missing, extra::BIGINT AS extra, rate, CASE WHEN NOT deck AND missing + extra > 0 THEN 'texts differ' WHEN deck AND total > 0 AND rate < 0.95 AND NOT chart THEN 'deck and page differ' END AS flag FROM r""")
def slide_coverage(spark, sf):
    """Words of slides compared as their way of reading asks, less those that repairs changed on purpose."""
    rows = table(spark, sf, "conversations").select("conv_id", "turn", F.col("text").alias("s"), F.concat(F.substring("text", 1, 200), F.lit(" extra repaired")).alias("o"), F.lit("repaired").alias("e"), (F.col("turn") % 2 == 0).alias("deck"), F.when(F.col("conv_id") % 3 == 0, F.array(F.lit("chart 1"))).otherwise(F.array().cast("array<string>")).alias("flags"))
    return verify.slide_coverage(rows, ["conv_id", "turn"], "s", "o", "e", "deck", "flags")


@query(f"""WITH {cte('dx_answer')}, {PAGES}, i AS (SELECT chunk_no, page_no, 'missing' AS code FROM (SELECT * FROM src EXCEPT SELECT * FROM ans) UNION ALL SELECT chunk_no, page_no, 'extra_page' FROM (SELECT * FROM ans EXCEPT SELECT * FROM src)),
g AS (SELECT chunk_no, count(*) AS n, string_agg(chr(10) || '    - page ' || page_no || ': ' || code, '' ORDER BY page_no, code) AS l FROM i WHERE chunk_no % 9 <> 0 GROUP BY 1)
SELECT chunk_no, CASE WHEN chunk_no % 9 = 0 THEN 1 ELSE coalesce(n, 0) END AS n_issues, '- ' || chunk_no || CASE WHEN chunk_no % 9 = 0 THEN ': no answer' WHEN n IS NULL THEN ': complete' ELSE ': ' || n || ' issues' || l END AS line FROM dx_answer LEFT JOIN g USING (chunk_no)""")
def answer_report(spark, sf):
    """One line a chunk; the counts summed are what a run exits with."""
    chunks = frame(spark, sf, "dx_answer")
    answers = chunks.filter("chunk_no % 9 <> 0")
    source, got = verify.source_pages(answers, ["chunk_no"]), verify.answer_pages(answers, ["chunk_no"])
    issues = verify.unmatched_pages(source, got, ["chunk_no"])
    return verify.report(chunks, answers, issues, ["chunk_no"])


@query("""WITH a AS (SELECT conv_id, turn, trim(text) AS t FROM conversations WHERE role = 'assistant') SELECT conv_id, regexp_replace(string_agg(t, chr(10) || chr(10) || '---PAGE---' || chr(10) || chr(10) ORDER BY turn, t), '(\\s*---PAGE---\\s*){2,}', chr(10) || chr(10) || '---PAGE---' || chr(10) || chr(10), 'g') AS md FROM a WHERE t <> '' GROUP BY 1""")
def merged_answers(spark, sf):
    """A conversation's answers as one text."""
    return verify.merged_answers(table(spark, sf, "conversations").filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("answer_text")), ["conv_id"], "turn")
