"""Registered queries of layout operators over layouts drawn from the tables, with SQL that computes them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from folio.functions.geometry import rect
from folio.functions.text import odd_case
from folio.operators import figures, incremental, ocr, raster, slides, structure, textclean, verify, vocab
from folio.plans.derived import cte, frame
from folio.plans.runtime import freed, in_parts, in_place, laid_by, shared_dir

Q: dict = {}
O: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            O[f.__name__] = sql
        return f

    return add


def boxed(spark, sf, name, column="box", lineitem=None):
    return figures.boxes(frame(spark, sf, name, lineitem), column)


KEY = "regexp_replace(lower(trim(text)), '[0-9]+', '#', 'g')"


@query(f"""WITH {cte('dx_line')}, k AS (SELECT deck_id, page_idx, regexp_replace({KEY}, '\\s+', ' ', 'g') AS footer FROM dx_line WHERE y0 > 0.88 * height OR y0 < 0.08 * height),
n AS (SELECT deck_id, footer, count(DISTINCT page_idx) AS n_slides FROM k WHERE footer <> '' GROUP BY ALL), d AS (SELECT deck_id, count(DISTINCT page_idx) AS slides FROM dx_line GROUP BY 1)
SELECT deck_id, footer, n_slides FROM n JOIN d USING (deck_id) WHERE n_slides >= greatest(2, slides // 2)""")
def slide_footers(spark, sf):
    return slides.repeated_lines(frame(spark, sf, "dx_line").withColumn("y", F.col("y0")), ["deck_id"])


@query(f"""WITH {cte('dx_line')}, s AS (SELECT deck_id, bullet_x, CASE WHEN bullet_x - lag(bullet_x) OVER w <= 10 THEN 0 ELSE 1 END AS step FROM dx_line WHERE bullet_x IS NOT NULL WINDOW w AS (PARTITION BY deck_id ORDER BY bullet_x)),
g AS (SELECT deck_id, bullet_x, sum(step) OVER (PARTITION BY deck_id ORDER BY bullet_x RANGE UNBOUNDED PRECEDING) AS c FROM s), c AS (SELECT deck_id, c, sum(bullet_x) / count(*) AS centre, count(*) AS n FROM g GROUP BY ALL),
b AS (SELECT *, n >= greatest(2, 0.01 * sum(n) OVER (PARTITION BY deck_id)) AS big FROM c), k AS (SELECT *, bool_or(big) OVER (PARTITION BY deck_id) AS any_big FROM b),
kept AS (SELECT deck_id, centre, row_number() OVER (PARTITION BY deck_id ORDER BY centre) - 1 AS i FROM k WHERE big OR NOT any_big),
near AS (SELECT l.deck_id, page_idx, pos, i, row_number() OVER (PARTITION BY l.deck_id, page_idx, pos ORDER BY abs(centre - bullet_x), i) AS r FROM dx_line l JOIN kept k ON k.deck_id = l.deck_id WHERE bullet_x IS NOT NULL)
SELECT l.deck_id, l.page_idx, l.pos, i::INTEGER AS level FROM dx_line l LEFT JOIN near n ON n.deck_id = l.deck_id AND n.page_idx = l.page_idx AND n.pos = l.pos AND r = 1""")
def bullet_levels(spark, sf):
    return slides.bullet_levels(boxed(spark, sf, "dx_line"), ["deck_id"]).select("deck_id", "page_idx", "pos", "level")


@query(f"WITH {cte('dx_render')} SELECT slide_no, bool_or(fill <= 0.005) AS blank FROM dx_render GROUP BY 1")
def blank_renders(spark, sf):
    return raster.blank(frame(spark, sf, "dx_render"), ["slide_no"])


@query(f"WITH {cte('dx_render')} SELECT slide_no, min(rank) AS rank FROM dx_render WHERE fill > 0.005 GROUP BY 1")
def first_images(spark, sf):
    return verify.first_image(frame(spark, sf, "dx_render"), ["slide_no"])


@query(f"WITH {cte('dx_render')} SELECT slide_no, rank, q % 3 = 0 OR q % 4 = 1 AS image FROM dx_render")
def images_needed(spark, sf):
    flags = F.array(F.when(F.col("q") % 3 == 0, "chart: 2").otherwise("a chart"), F.when(F.col("q") % 4 == 1, "drawing").otherwise("hidden"))
    return frame(spark, sf, "dx_render").select("slide_no", "rank", verify.needs_image(flags, ["chart", "drawing"]).alias("image"))


@query(f"""WITH {cte('dx_reading')}, s AS (SELECT page_idx, reading, sum((conf >= 80)::INTEGER)::BIGINT AS sure_words, avg(conf) AS confidence FROM dx_reading GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY page_idx ORDER BY sure_words DESC NULLS LAST, confidence DESC NULLS LAST, reading) AS i FROM s) SELECT page_idx, reading, sure_words, confidence FROM r WHERE i = 1""")
def best_reading(spark, sf):
    return verify.best_reading(frame(spark, sf, "dx_reading"), ["page_idx"])


FOOTERS = f"""k AS (SELECT *, {KEY} AS footer FROM dx_line), d AS (SELECT deck_id, count(DISTINCT page_idx) AS pages FROM dx_line GROUP BY 1),
ends AS (SELECT k.deck_id, footer FROM k JOIN d USING (deck_id) WHERE length(footer) >= 6 GROUP BY k.deck_id, footer, pages HAVING count(DISTINCT page_idx) >= greatest(2, 0.3 * pages)),
banded AS (SELECT k.*, e.footer IS NOT NULL AS is_footer, coalesce(sum((e.footer IS NOT NULL)::INTEGER) OVER (PARTITION BY k.deck_id, page_idx ORDER BY y0 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::INTEGER AS slide FROM k LEFT JOIN ends e ON e.deck_id = k.deck_id AND e.footer = k.footer)"""


@query(f"WITH {cte('dx_line')}, {FOOTERS} SELECT deck_id, page_idx, pos, slide, is_footer FROM banded")
def slide_bands(spark, sf):
    return ocr.slide_bands(frame(spark, sf, "dx_line"), ["deck_id", "page_idx"]).select("deck_id", "page_idx", "pos", "slide", "is_footer")


@query(f"""WITH {cte('dx_line')}, {FOOTERS}, s AS (SELECT *, y1 - y0 AS h, min(y0) OVER w AS top, max(y1) OVER w - min(y0) OVER w AS span FROM banded WHERE NOT is_footer WINDOW w AS (PARTITION BY deck_id, page_idx, slide)),
m AS (SELECT deck_id, page_idx, slide, list_sort(list(h))[count(*) // 2 + 1] AS median FROM s GROUP BY ALL),
high AS (SELECT s.*, median, y0 - top <= 0.28 * span AND bullet_x IS NULL AND coalesce(confidence, 100) >= 80 AS high FROM s JOIN m USING (deck_id, page_idx, slide)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY deck_id, page_idx, slide ORDER BY CASE WHEN high THEN h END DESC NULLS LAST, y0, pos) AS i FROM high)
SELECT deck_id, page_idx, slide, pos, CASE WHEN i = 1 AND high AND h >= 1.15 * median THEN 'title' WHEN bullet_x IS NOT NULL THEN 'item' ELSE 'paragraph' END AS role, text FROM ranked""")
def image_slides(spark, sf):
    """Pages of images of slides: parted at repeated footers, titles and items found."""
    return slides.image_slides(boxed(spark, sf, "dx_line"), ["deck_id", "page_idx"]).drop("level")


#: Rows of lineitem whose decks similar_footers works on at a time.
FOOTER_ROWS = 6_000_000


@query()
def similar_footers(spark, sf):
    """Compared with Python's own matching blocks in tests/test_layouts.py. Decks come in parts: what a part stored and shuffled is removed once its lines are written."""
    path, rows = f"{shared_dir(spark)}/folio-footers-{uuid.uuid4().hex}", spark.read.parquet(f"{sf}/lineitem.parquet")
    for lineitem in in_parts(rows.withColumn("deck", F.floor(F.col("l_orderkey") / 20)), ["deck"], FOOTER_ROWS, "decks"):
        with freed(spark):
            schema = _footers_of(spark, sf, lineitem, path)
    return spark.read.schema(schema).parquet(path)


def _footers_of(spark, sf, lineitem, path):
    found = ocr.similar_footers(frame(spark, sf, "dx_foot", lineitem), ["deck_id"])
    found.write.mode("append").option("compression", "zstd").parquet(path)
    return found.schema


@query(f"""WITH {cte('dx_line')}, l AS (SELECT *, len(regexp_extract_all(text, '\\p{{L}}')) AS n FROM dx_line)
SELECT deck_id, page_idx, pos FROM l WHERE n >= 2 AND x0 >= 0.06 * page_width AND x1 <= 0.92 * page_width AND NOT (n <= 4 AND confidence < 80)""")
def ocr_clean_lines(spark, sf):
    return ocr.clean_lines(frame(spark, sf, "dx_line")).select("deck_id", "page_idx", "pos")


@query(f"""WITH {cte('dx_box')}, w AS (SELECT set_id, box_id % 2 AS line_no, 'w' || (box_id % 5) AS text, y0 AS conf, x0, x1, y1 - y0 AS h FROM dx_box), m AS (SELECT set_id, line_no, list_sort(list(h))[count(*) // 2 + 1] AS median FROM w GROUP BY ALL),
s AS (SELECT w.*, CASE WHEN x0 - lag(x1) OVER (PARTITION BY w.set_id, w.line_no ORDER BY x0, x1) > 1.6 * median THEN 1 ELSE 0 END AS new FROM w JOIN m ON m.set_id = w.set_id AND m.line_no = w.line_no),
p AS (SELECT *, sum(new) OVER (PARTITION BY set_id, line_no ORDER BY x0, x1)::INTEGER AS part FROM s)
SELECT set_id, line_no, part, string_agg(text, ' ' ORDER BY x0, text) AS text, min(x0) AS x0, max(x1) AS x1, count(*) AS n_words, avg(conf) AS confidence FROM p GROUP BY ALL""")
def ocr_line_parts(spark, sf):
    words = boxed(spark, sf, "dx_box").select("set_id", (F.col("box_id") % 2).alias("line_no"), F.concat(F.lit("w"), (F.col("box_id") % 5).cast("string")).alias("text"), F.col("box.y0").alias("conf"), "box")
    return ocr.split_lines(words, ["set_id"])


@query(f"""WITH {cte('dx_slide', 'dx_rendered')} SELECT s.deck_id, s.slide_no, coalesce(CASE WHEN trim(s.title) <> '' THEN s.title END, r.title) AS title,
array_to_string(list_filter([item, 'more'], lambda i: coalesce(trim(s.title), '') <> '' OR coalesce(i <> r.title, true)), ',') AS items FROM dx_slide s LEFT JOIN dx_rendered r ON r.deck_id = s.deck_id AND r.slide_no = s.slide_no""")
def deck_titles(spark, sf):
    decks = frame(spark, sf, "dx_slide").withColumn("items", F.array("item", F.lit("more")))
    return slides.deck_titles(decks, frame(spark, sf, "dx_rendered"), ["deck_id"]).withColumn("items", F.array_join("items", ","))


@query(f"""WITH {cte('dx_slide', 'dx_rendered')}, c AS (SELECT *, count(*) OVER d AS n, sum((NOT hidden)::INTEGER) OVER d AS shown, sum((NOT hidden)::INTEGER) OVER (PARTITION BY deck_id ORDER BY slide_no) AS k FROM dx_slide WINDOW d AS (PARTITION BY deck_id)),
r AS (SELECT deck_id, count(*) AS pages FROM dx_rendered GROUP BY 1), m AS (SELECT deck_id, slide_no, CASE WHEN pages = n THEN slide_no WHEN pages = shown AND NOT hidden THEN k END::INTEGER AS page_no FROM c JOIN r USING (deck_id)) SELECT * FROM m WHERE page_no IS NOT NULL""")
def visible_match(spark, sf):
    return slides.visible_match(frame(spark, sf, "dx_slide"), frame(spark, sf, "dx_rendered"), ["deck_id"])


PAGES = """src AS (SELECT DISTINCT chunk_no, unnest(regexp_extract_all(source_text, '<!-- page ([0-9]+) -->', 1))::INTEGER AS page_no FROM dx_answer),
blocks AS (SELECT chunk_no, unnest(regexp_extract_all(chr(10) || answer_text, '\\n# [^\\n]*(?:\\n(?:[^#\\n]|#[^ ])[^\\n]*)*')) AS b FROM dx_answer),
ans AS (SELECT DISTINCT chunk_no, regexp_extract(b, 'page\\s*([0-9]+)', 1)::INTEGER AS page_no FROM blocks WHERE regexp_matches(b, 'page\\s*[0-9]'))"""


@query(f"WITH {cte('dx_answer')}, {PAGES} SELECT * FROM src EXCEPT SELECT * FROM ans")
def missing_pages(spark, sf):
    rows = frame(spark, sf, "dx_answer")
    return verify.missing_pages(verify.source_pages(rows, ["chunk_no"]), verify.answer_pages(rows, ["chunk_no"]), ["chunk_no"])


@query(f"WITH {cte('dx_answer')}, {PAGES} SELECT * FROM ans EXCEPT SELECT * FROM src")
def extra_pages(spark, sf):
    rows = frame(spark, sf, "dx_answer")
    return verify.extra_pages(verify.source_pages(rows, ["chunk_no"]), verify.answer_pages(rows, ["chunk_no"]), ["chunk_no"])


@query(rf"""WITH {cte('dx_numbered')}, l AS (SELECT doc_id, page_idx, printed_no, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM dx_numbered),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY i) AS up, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY i DESC) AS down, trim(regexp_replace(line, '\*\*|__|~~|</?u>|[#>`]', '', 'g')) AS b FROM l WHERE trim(line) <> ''),
gone AS (SELECT doc_id, page_idx, i FROM f WHERE (up <= 2 OR down <= 2) AND length(b) <= 100 AND (regexp_matches(b, '^' || printed_no || '($|[^0-9.]|\.($|[^0-9]))') OR regexp_matches(b, '(^|[^0-9.])' || printed_no || '$')))
SELECT doc_id, page_idx, printed_no, coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS text FROM l LEFT JOIN gone g USING (doc_id, page_idx, i) GROUP BY ALL""")
def page_number_lines(spark, sf):
    return textclean.remove_page_numbers(frame(spark, sf, "dx_numbered"))


CAPTIONS = rf"""head AS (SELECT '^\s*(Figure|Fig\.|Table|FIGURE|FIG\.|TABLE|figure|fig\.|table)\s+((?:[0-9]+|[A-Z])(?:\.[0-9]+)+)\s*(.*)$' AS r),
c AS (SELECT l.*, regexp_extract(text, r, 1) AS word, regexp_extract(text, r, 2) AS no, regexp_extract(text, r, 3) AS rest, regexp_matches(text, r) AS hit, lag(text) OVER w AS b, lag(x0) OVER w AS lx, lag(regexp_matches(text, r)) OVER w AS bhit FROM dx_caption_line l, head WINDOW w AS (PARTITION BY doc_id, page_idx ORDER BY pos)),
caps AS (SELECT doc_id, page_idx, pos, CASE WHEN lower(word)[1] = 't' THEN 'table' ELSE 'figure' END AS kind, no, trim(regexp_replace(rest, '\s+', ' ', 'g')) AS title FROM c WHERE hit AND NOT (regexp_matches(rest, '^\p{{Ll}}') OR (regexp_matches(rest, '^[(,;]') AND NOT regexp_matches(rest, '^\((?:[a-z]\)|[Cc]ontinued)')))
  AND NOT coalesce(NOT regexp_matches(b, '[.:!?]\s*$') AND abs(lx - x0) < 4 AND NOT bhit, false))"""


@query(f"WITH {cte('dx_caption_line')}, {CAPTIONS} SELECT * FROM caps")
def caption_lines(spark, sf):
    return figures.captions(boxed(spark, sf, "dx_caption_line"), ["doc_id", "page_idx"]).drop("caption_box")


@query(f"""WITH {cte('dx_caption_line')}, {CAPTIONS}, m AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '(?:Figure|Table)\\s+(?:[0-9]+|[A-Z])\\.[0-9]+')) AS m FROM dx_caption_line)
SELECT DISTINCT doc_id, lower(regexp_extract(m, '^[A-Za-z]+')) AS kind, regexp_extract(m, '\\S+$') AS no FROM m WHERE NOT EXISTS (SELECT 1 FROM caps WHERE caps.doc_id = m.doc_id AND caps.kind = lower(regexp_extract(m, '^[A-Za-z]+')) AND caps.no = regexp_extract(m, '\\S+$'))""")
def unseen_mentions(spark, sf):
    lines_ = boxed(spark, sf, "dx_caption_line")
    return figures.unseen_mentions(lines_, figures.captions(lines_, ["doc_id", "page_idx"]), ["doc_id"])


IOU = "greatest(0, least(k.x1, b.x1) - greatest(k.x0, b.x0)) * greatest(0, least(k.y1, b.y1) - greatest(k.y0, b.y0))"


@query(f"""WITH RECURSIVE {cte('dx_box')}, r AS (SELECT set_id, pos, [{{'pos': pos, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}] AS kept FROM dx_box WHERE pos = 1
UNION ALL SELECT b.set_id, b.pos, CASE WHEN len(list_filter(kept, lambda k: {IOU} > 0.7 * ((k.x1 - k.x0) * (k.y1 - k.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - {IOU}))) > 0 THEN kept ELSE list_append(kept, {{'pos': b.pos, 'x0': b.x0, 'y0': b.y0, 'x1': b.x1, 'y1': b.y1}}) END
  FROM r JOIN dx_box b ON b.set_id = r.set_id AND b.pos = r.pos + 1)
SELECT set_id, unnest(list_transform(kept, lambda k: k.pos)) AS pos FROM (SELECT set_id, arg_max(kept, pos) AS kept FROM r GROUP BY 1)""")
def iou_dedup(spark, sf):
    return figures.without_repeats(boxed(spark, sf, "dx_box"), ["set_id"]).select("set_id", "pos")


def join_sql(a: str, b: str) -> str:
    """Two lines as one, in SQL: a hyphen within a word closes up."""
    return rf"CASE WHEN rtrim({a}) = '' THEN trim({b}) WHEN regexp_matches(rtrim({a}), '\p{{L}}-$') AND regexp_matches(trim({b}), '^\p{{L}}') THEN rtrim({a}) || trim({b}) ELSE rtrim({a}) || ' ' || trim({b}) END"


#: Labels of the lines s (page_idx, i, x0, y0, x1, y1, c, text): r (page_idx, r, x, n).
LABEL_SQL = f"""f AS (SELECT page_idx, 0::BIGINT AS i, []::STRUCT(top DOUBLE, l DOUBLE, h DOUBLE, c DOUBLE, b DOUBLE, t VARCHAR)[] AS g FROM s GROUP BY 1
  UNION ALL SELECT page_idx, i, CASE WHEN hit IS NULL THEN list_append(g, {{'top': y0, 'l': x0, 'h': y1 - y0, 'c': c, 'b': y1, 't': trim(text)}}) ELSE list_transform(g, lambda x, n: CASE WHEN n = hit THEN {{'top': x.top, 'l': x.l, 'h': x.h, 'c': c, 'b': y1, 't': {join_sql('x.t', 'text')}}} ELSE x END) END
    FROM (SELECT s.*, g, list_filter(range(1, len(g) + 1), lambda n: abs(g[n].c - s.c) < 20 AND s.y0 >= g[n].b AND s.y0 - g[n].b < 0.7 * (s.y1 - s.y0))[1] AS hit FROM f JOIN s ON s.page_idx = f.page_idx AND s.i = f.i + 1)),
e AS (SELECT page_idx, arg_max(g, i) AS g FROM f GROUP BY 1), l AS (SELECT page_idx, unnest(g) AS x, generate_subscripts(g, 1) AS n FROM e),
r AS (SELECT page_idx, n, x, x.top AS top, 1 AS r FROM l WHERE n = 1 UNION ALL SELECT l.page_idx, l.n, l.x, CASE WHEN abs(l.x.top - r.top) < 0.6 * greatest(l.x.h, 1) THEN r.top ELSE l.x.top END, CASE WHEN abs(l.x.top - r.top) < 0.6 * greatest(l.x.h, 1) THEN r.r ELSE r.r + 1 END FROM r JOIN l ON l.page_idx = r.page_idx AND l.n = r.n + 1)"""


@query(f"""WITH RECURSIVE {cte('dx_stack')}, s AS (SELECT page_idx, row_number() OVER (PARTITION BY page_idx ORDER BY y0, x0, pos) AS i, x0, y0, x1, y1, (x0 + x1) / 2 AS c, text FROM dx_stack),
{LABEL_SQL}
SELECT page_idx, row_number() OVER (PARTITION BY page_idx ORDER BY r, x.l, n)::INTEGER AS no, x.t AS label FROM r""")
def label_groups(spark, sf):
    return slides.label_groups(boxed(spark, sf, "dx_stack"), ["page_idx"])


@query(f"""WITH {cte('dx_line')}, s AS (SELECT *, y1 - y0 AS h, y0 < 0.28 * 540 AS top FROM dx_line), m AS (SELECT deck_id, page_idx, list_sort(list(h))[count(*) // 2 + 1] AS median FROM s GROUP BY ALL),
r AS (SELECT s.*, median, row_number() OVER (PARTITION BY s.deck_id, s.page_idx ORDER BY CASE WHEN top THEN h END DESC NULLS LAST, y0, pos) AS i FROM s JOIN m ON m.deck_id = s.deck_id AND m.page_idx = s.page_idx)
SELECT deck_id, page_idx, pos, CASE WHEN i = 1 AND top AND h >= 1.15 * median AND bullet_x IS NULL THEN 'title' WHEN bullet_x IS NOT NULL THEN 'item' ELSE 'paragraph' END AS role FROM r""")
def slide_roles(spark, sf):
    return slides.structured(boxed(spark, sf, "dx_line"), ["deck_id"]).select("deck_id", "page_idx", "pos", "role")


@query(f"""WITH {cte('dx_stack')}, c AS (SELECT page_idx, trim(text) AS capital, x1 AS cx1, y0 AS cy0, y1 AS cy1 FROM dx_stack WHERE regexp_full_match(trim(text), '\\p{{Lu}}') AND size > 20),
n AS (SELECT s.page_idx, capital, pos, row_number() OVER (PARTITION BY s.page_idx, capital ORDER BY y0, x0, pos) AS i FROM dx_stack s JOIN c ON c.page_idx = s.page_idx AND regexp_matches(text, '^\\p{{Ll}}') AND x0 >= cx1 - 2 AND x0 - cx1 < 20 AND y0 < cy1 AND y1 > cy0)
SELECT page_idx, capital, pos FROM n WHERE i = 1""")
def drop_caps(spark, sf):
    return slides.drop_caps(boxed(spark, sf, "dx_stack"), ["page_idx"], 10.0)


@query(f"""WITH {cte('dx_figure', 'dx_ink')}, i AS (SELECT f.page_idx, no, min(gx * 2) AS a, min(gy * 2) AS b, max(gx * 2 + 2) AS c, max(gy * 2 + 2) AS d FROM dx_figure f JOIN dx_ink k ON k.page_idx = f.page_idx AND gx * 2 + 2 > x0 AND gx * 2 < x1 AND gy * 2 + 2 > y0 AND gy * 2 < y1 GROUP BY ALL)
SELECT f.page_idx, f.no, coalesce(greatest(x0, a), x0) AS x0, coalesce(greatest(y0, b), y0) AS y0, coalesce(least(x1, c), x1) AS x1, coalesce(least(y1, d), y1) AS y1 FROM dx_figure f LEFT JOIN i ON i.page_idx = f.page_idx AND i.no = f.no""")
def ink_shrink(spark, sf):
    cut = raster.shrink_to_ink(boxed(spark, sf, "dx_figure"), frame(spark, sf, "dx_ink"), ["page_idx"])
    return cut.select("page_idx", "no", "box.x0", "box.y0", "box.x1", "box.y1")


RUNS = """rows AS (SELECT DISTINCT f.page_idx, no, (y0 + y1) / 2 AS middle, gy FROM dx_figure f JOIN dx_ink k ON k.page_idx = f.page_idx AND gx * 2 + 2 > x0 AND gx * 2 < x1 AND gy * 2 >= y0 AND gy * 2 < y1),
gaps AS (SELECT *, lead(gy) OVER (PARTITION BY page_idx, no ORDER BY gy) AS after FROM rows), runs AS (SELECT page_idx, no, middle, ((gy + 1) * 2)::DOUBLE AS top, ((after - gy - 1) * 2)::DOUBLE AS height FROM gaps WHERE (after - gy - 1) * 2 >= 3)"""


@query(f"WITH {cte('dx_figure', 'dx_ink')}, {RUNS} SELECT page_idx, no, top, height FROM runs")
def blank_row_runs(spark, sf):
    return raster.blank_rows(boxed(spark, sf, "dx_figure"), frame(spark, sf, "dx_ink"), ["page_idx"])


@query(f"""WITH {cte('dx_figure', 'dx_ink')}, {RUNS}, best AS (SELECT page_idx, no, top + height / 2 AS y, row_number() OVER (PARTITION BY page_idx, no ORDER BY -least(height, 12), abs(top + height / 2 - middle), top + height / 2) AS i FROM runs)
SELECT page_idx, no, y FROM best WHERE i = 1""")
def figure_split_rows(spark, sf):
    figs = boxed(spark, sf, "dx_figure")
    return raster.split_at(figs, raster.blank_rows(figs, frame(spark, sf, "dx_ink"), ["page_idx"]), ["page_idx"])


@query(f"""WITH {cte('dx_figure', 'dx_ink')}, ink AS (SELECT DISTINCT page_idx, gx, gy, (gx + 0.5) * 2 AS x, (gy + 0.5) * 2 AS y FROM dx_ink),
free AS (SELECT * FROM ink i WHERE NOT EXISTS (SELECT 1 FROM dx_figure f WHERE f.page_idx = i.page_idx AND x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1))
SELECT f.page_idx, no, count(*) AS cells FROM free i JOIN dx_figure f ON f.page_idx = i.page_idx AND y BETWEEN y0 AND y1 AND ((x > x1 AND x < x1 + 120) OR (x < x0 AND x > x0 - 120)) GROUP BY ALL HAVING count(*) >= 3""")
def outside_ink(spark, sf):
    figs = boxed(spark, sf, "dx_figure")
    return raster.outside_ink(figs, figs, frame(spark, sf, "dx_ink"), ["page_idx"], least=3)


@query(f"""WITH {cte('dx_ink')}, a AS (SELECT DISTINCT page_idx, gx - min(gx) OVER w AS gx, gy - min(gy) OVER w AS gy FROM dx_ink WINDOW w AS (PARTITION BY page_idx)),
b AS (SELECT DISTINCT page_idx, gx - min(gx) OVER w AS gx, gy - min(gy) OVER w AS gy FROM dx_ink WHERE gx % 23 <> 0 WINDOW w AS (PARTITION BY page_idx)),
f AS (SELECT coalesce(a.page_idx, b.page_idx) AS page_idx, coalesce(a.gx, b.gx) AS gx, coalesce(a.gy, b.gy) AS gy, a.gx IS NULL OR b.gx IS NULL AS odd, CASE WHEN a.gx IS NULL THEN 0 ELSE a.gx + 1 END AS ax, CASE WHEN a.gx IS NULL THEN 0 ELSE a.gy + 1 END AS ay, CASE WHEN b.gx IS NULL THEN 0 ELSE b.gx + 1 END AS bx, CASE WHEN b.gx IS NULL THEN 0 ELSE b.gy + 1 END AS by_ FROM a FULL JOIN b ON a.page_idx = b.page_idx AND a.gx = b.gx AND a.gy = b.gy)
SELECT page_idx, sum(odd::INTEGER) < 0.01 * greatest(100, (max(gx) + 1) * (max(gy) + 1)) AND abs(max(ax) - max(bx)) <= greatest(0.02 * greatest(max(ax), max(bx)), 4) AND abs(max(ay) - max(by_)) <= greatest(0.02 * greatest(max(ay), max(by_)), 4) AS same FROM f GROUP BY 1""")
def same_image(spark, sf):
    ink = frame(spark, sf, "dx_ink")
    return raster.same_image(ink, ink.filter("gx % 23 <> 0").withColumn("gx", F.col("gx") + 7), ["page_idx"])


@query(f"""WITH {cte('dx_box', 'dx_figure')}, u AS (SELECT DISTINCT b.* FROM dx_box b JOIN dx_figure f ON f.page_idx = b.set_id AND b.x1 - b.x0 < 60 AND b.y1 - b.y0 < 60 AND b.y0 >= f.y0 + 5 AND b.y0 - f.y0 - 5 <= 45 AND b.x0 < f.x1 AND b.x1 > f.x0),
out AS (SELECT set_id, box_id FROM u b WHERE NOT EXISTS (SELECT 1 FROM dx_box k WHERE k.set_id = b.set_id AND k.box_id <> b.box_id AND greatest(0, greatest(k.x0, b.x0) - least(k.x1, b.x1), greatest(k.y0, b.y0) - least(k.y1, b.y1)) < 6))
SELECT set_id, box_id AS cluster FROM dx_box b WHERE NOT EXISTS (SELECT 1 FROM out o WHERE o.set_id = b.set_id AND o.box_id = b.box_id)""")
def icons_removed(spark, sf):
    clusters = boxed(spark, sf, "dx_box").withColumnRenamed("box_id", "cluster")
    caps = figures.boxes(frame(spark, sf, "dx_figure").withColumn("y1", F.col("y0") + 5).withColumnRenamed("page_idx", "set_id"), "caption_box")
    return raster.without_icons(clusters, caps, ["set_id"]).select("set_id", "cluster")


@query(f"""WITH {cte('dx_box')}, o AS (SELECT *, x1 - x0 AS w, y1 - y0 - 12 AS h, pos % 3 = 0 AS r FROM dx_box), n AS (SELECT *, w * h / (160.0 * 120) AS share FROM o)
SELECT set_id, box_id, CASE WHEN r THEN 'raster' WHEN h < 4 OR w < 4 THEN 'line' ELSE 'shape' END AS kind FROM n WHERE (r AND share >= 0.02 AND share < 0.9) OR (NOT r AND share <= 0.8 AND NOT (h < 4 AND w > 64) AND NOT (w < 4 AND h < 4))""")
def visual_regions(spark, sf):
    objects = figures.boxes(frame(spark, sf, "dx_box").withColumn("y1", F.col("y1") - 12).withColumn("kind", F.when(F.col("pos") % 3 == 0, "raster").otherwise("drawing")))
    return slides.visual_regions(objects, 160.0, 120.0).select("set_id", "box_id", "kind")


@query(f"WITH {cte('dx_item')}, t AS (SELECT floor(o / 10)::BIGINT AS doc_id, '1.' || pos AS no, '| ' || (p % 50) || ' |' AS table_md FROM dx_item) SELECT doc_id, table_md, count(*) AS n, min(no) AS first FROM t GROUP BY ALL HAVING count(*) > 1")
def shared_tables(spark, sf):
    rows = frame(spark, sf, "dx_item").select(F.floor(F.col("o") / 10).alias("doc_id"), F.concat(F.lit("1."), F.col("pos").cast("string")).alias("no"), F.concat(F.lit("| "), (F.col("p") % 50).cast("string"), F.lit(" |")).alias("table_md"))
    return verify.shared_tables(rows, ["doc_id"])


@query(rf"""WITH {cte('dx_file')}, f AS (SELECT path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, regexp_extract(path, '[^/]*$') AS name FROM dx_file), e AS (SELECT *, lower(regexp_extract(name, '\.([^.]+)$', 1)) AS ext, regexp_replace(name, '\.[^.]+$', '') AS stem, list_position(['pptx', 'ppsx', 'ppt', 'pps', 'odp'], ext) AS place FROM f WHERE name NOT LIKE '~$%' AND name NOT LIKE '.%')
SELECT folder, stem, arg_min(path, place) FILTER (WHERE place > 0) AS pres_path, min(path) FILTER (WHERE ext = 'pdf') AS pdf_path FROM e WHERE place > 0 OR ext = 'pdf' GROUP BY ALL""")
def deck_discovery(spark, sf):
    return incremental.decks(frame(spark, sf, "dx_file"))


@query(f"""WITH {cte('dx_item')}, g AS (SELECT DISTINCT ['•', 'o', 'x', 'ab', '-', 'é'][p % 6 + 1] AS glyph, ['Arial', 'CourierNew', 'Wingdings', 'Symbol'][s % 4 + 1] AS font FROM dx_item)
SELECT glyph, font, length(glyph) = 1 AND (font IN ('Wingdings', 'Symbol') OR glyph IN ('•', '-') OR (glyph = 'o' AND font = 'CourierNew')) AS bullet FROM g""")
def bullet_signs(spark, sf):
    of = lambda n, *v: F.element_at(F.array(*map(F.lit, v)), F.col(n) % len(v) + 1)
    rows = frame(spark, sf, "dx_item").select(of("p", "•", "o", "x", "ab", "-", "é").alias("glyph"), of("s", "Arial", "CourierNew", "Wingdings", "Symbol").alias("font")).distinct()
    return rows.select("glyph", "font", ocr.is_bullet(F.col("glyph"), F.col("font")).alias("bullet"))


@query(f"""WITH {cte('dx_box', 'dx_figure')}, t AS (SELECT f.page_idx, f.no, 'w' || (box_id % 4) AS text, round_even(b.y0 / 8, 0) AS r, b.x0 AS x FROM dx_box b JOIN dx_figure f ON f.page_idx = b.set_id AND (b.x0 + b.x1) / 2 BETWEEN f.x0 AND f.x1 AND (b.y0 + b.y1) / 2 BETWEEN f.y0 AND f.y1),
k AS (SELECT *, row_number() OVER (PARTITION BY page_idx, no, text ORDER BY r, x) AS k FROM t) SELECT page_idx, no, string_agg(text, ' · ' ORDER BY r, x, text) AS labels FROM k WHERE k = 1 GROUP BY ALL""")
def figure_labels(spark, sf):
    lines_ = boxed(spark, sf, "dx_box").select(F.col("set_id").alias("page_idx"), F.concat(F.lit("w"), (F.col("box_id") % 4).cast("string")).alias("text"), "box")
    return figures.label_text(lines_, boxed(spark, sf, "dx_figure"), ["page_idx"])


@query(f"""WITH {cte('dx_item')}, a AS (SELECT o, pos, 1 AS way FROM dx_item WHERE flag = 'A'), b AS (SELECT o, pos, 2 AS way FROM dx_item WHERE flag = 'N'), c AS (SELECT o, pos, 3 AS way FROM dx_item)
SELECT * FROM a UNION ALL SELECT * FROM b WHERE o NOT IN (SELECT o FROM a) UNION ALL SELECT * FROM c WHERE o NOT IN (SELECT o FROM a UNION SELECT o FROM b)""")
def chapters_first_found(spark, sf):
    """The first of three ways that gives a book any rows."""
    rows = frame(spark, sf, "dx_item").select("o", "pos", "flag")
    way = lambda n, df: df.select("o", "pos", F.lit(n).alias("way"))
    return structure.first_found(way(1, rows.filter("flag = 'A'")), way(2, rows.filter("flag = 'N'")), way(3, rows), book=["o"])


@query(rf"""WITH {cte('dx_odd')}, l AS (SELECT text FROM dx_odd UNION ALL SELECT unnest(string_split(text, chr(10))) FROM documents), w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z]+')) AS word FROM l)
SELECT word FROM w WHERE length(word) >= 4 AND upper(word) <> word AND (regexp_matches(word, '^[a-z].*[A-Z]') OR len(regexp_extract_all(word, '[a-z][A-Z]')) >= 2)""")
def odd_case_words(spark, sf):
    """Words of the documents, and of headings that hold some of odd case."""
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("text").unionByName(frame(spark, sf, "dx_odd").select("text"))
    return texts.select(F.explode(F.regexp_extract_all("text", F.lit("([A-Za-z]+)"), F.lit(1))).alias("word")).distinct().filter(odd_case(F.col("word")))


@query(f"""WITH {cte('dx_torn')}, w AS (SELECT deck_id, o, pos, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS i FROM dx_torn), known AS (SELECT deck_id, word, count(*) AS n FROM w GROUP BY ALL),
n AS (SELECT deck_id, word AS l, lead(word) OVER (PARTITION BY deck_id, o, pos ORDER BY i) AS r FROM w), p AS (SELECT deck_id, l, r, count(*) AS n FROM n WHERE r IS NOT NULL GROUP BY ALL),
torn AS (SELECT p.* FROM p JOIN known k ON k.deck_id = p.deck_id AND k.word = l || r), sides AS (SELECT deck_id, word, sum(n) AS n FROM (SELECT deck_id, l AS word, n FROM torn UNION ALL SELECT deck_id, r, n FROM torn) GROUP BY ALL),
only_ AS (SELECT k.deck_id, k.word FROM known k JOIN sides s ON s.deck_id = k.deck_id AND s.word = k.word AND s.n = k.n)
SELECT deck_id, l AS "left", r AS "right", l || r AS joined FROM torn t WHERE EXISTS (SELECT 1 FROM only_ o WHERE o.deck_id = t.deck_id AND o.word IN (l, r))""")
def split_word_pairs(spark, sf):
    return vocab.split_words(frame(spark, sf, "dx_torn"), ["deck_id"])


@query(f"""WITH {cte('dx_hyphen')}, parts AS (SELECT doc_id, a, b, a || b AS joined, a || '-' || b AS hyphened, count(*) AS times FROM dx_hyphen GROUP BY ALL), inl AS (SELECT DISTINCT doc_id, lower(c || '-' || d) AS low FROM dx_hyphen), whole AS (SELECT DISTINCT doc_id, b AS w FROM dx_hyphen UNION SELECT doc_id, a || d FROM dx_hyphen),
good AS (SELECT * FROM parts p WHERE lower(joined) <> 'lifetime' AND ((regexp_matches(b, '^[A-Z]') AND NOT EXISTS (SELECT 1 FROM whole w WHERE w.doc_id = p.doc_id AND w.w = joined)) OR EXISTS (SELECT 1 FROM inl i WHERE i.doc_id = p.doc_id AND i.low = lower(hyphened)) OR lower(a) IN ('real', 'time', 'so') OR lower(b) IN ('time', 'based', 'called'))),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, joined ORDER BY times DESC, hyphened) AS i FROM good) SELECT doc_id, joined, hyphened FROM r WHERE i = 1""")
def hyphen_compounds(spark, sf):
    raw = frame(spark, sf, "dx_hyphen").select("doc_id", F.concat("a", F.lit("-\n"), "b", F.lit(" and "), "c", F.lit("-"), "d", F.lit(" "), "a", "d", F.lit(".")).alias("text"))
    return textclean.hyphen_compounds(raw, ["doc_id"])


def _rows_sql(name: str, source: str) -> str:
    """A page's lines in rows at one height, as a fold in SQL."""
    same = "(abs(r.fy0 - o.y0) < 3 OR least(r.fy1, o.y1) - greatest(r.fy0, o.y0) > 0.5 * greatest(1, least(r.fy1 - r.fy0, o.y1 - o.y0)))"
    return f"""{name}_o AS (SELECT *, row_number() OVER (PARTITION BY page_idx ORDER BY y0, x0, pos) AS i FROM {source}),
{name} AS (SELECT *, y0 AS fy0, y1 AS fy1, 0 AS n FROM {name}_o WHERE i = 1 UNION ALL SELECT o.*, CASE WHEN {same} THEN r.fy0 ELSE o.y0 END, CASE WHEN {same} THEN r.fy1 ELSE o.y1 END, CASE WHEN {same} THEN r.n ELSE r.n + 1 END FROM {name} r JOIN {name}_o o ON o.page_idx = r.page_idx AND o.i = r.i + 1)"""


def table_sql() -> str:
    """The tables of the lines of plain (page_idx, pos, x0, y0, x1, y1, text): cell (page_idx, r, k, t), rs, size, and pc, the lines that each is made of."""
    return f"""{_rows_sql('v', 'plain')},
g AS (SELECT *, coalesce(lead(x0) OVER (PARTITION BY page_idx, n ORDER BY x0) - x1 > 8, true) AS clear FROM v), wide AS (SELECT page_idx, n, min(y0) AS top FROM g GROUP BY ALL HAVING count(*) >= 2 AND bool_and(clear)),
enough AS (SELECT page_idx, arg_min(top, n) - 2 AS top FROM wide GROUP BY 1 HAVING count(*) >= 3), xs AS (SELECT v.page_idx, v.x0 FROM v JOIN wide w ON w.page_idx = v.page_idx AND w.n = v.n JOIN enough e ON e.page_idx = v.page_idx),
st AS (SELECT *, CASE WHEN x0 - lag(x0) OVER (PARTITION BY page_idx ORDER BY x0) <= 15 THEN 0 ELSE 1 END AS step FROM xs), cl AS (SELECT page_idx, x0, sum(step) OVER (PARTITION BY page_idx ORDER BY x0 RANGE UNBOUNDED PRECEDING) AS c FROM st),
col AS (SELECT page_idx, list_sort(list(m)) AS cols FROM (SELECT page_idx, c, avg(x0) AS m FROM cl GROUP BY ALL) GROUP BY 1 HAVING count(*) >= 2),
near AS (SELECT p.*, cols, list_sort(list_transform(range(1, len(cols) + 1), lambda k: {{'d': abs(cols[k] - p.x0), 'k': k}}))[1] AS near FROM plain p JOIN col ON col.page_idx = p.page_idx JOIN enough e ON e.page_idx = p.page_idx WHERE y0 >= top),
kept AS (SELECT page_idx, pos, x0, y0, x1, y1, text, near.k AS k, len(cols) AS n_cols FROM near WHERE near.d < 15), {_rows_sql('h', 'kept')},
lv AS (SELECT page_idx, n, arg_min(y0, i) AS y, bool_or(k = 1) AS f FROM h GROUP BY ALL), sp AS (SELECT *, y - lag(y) OVER w AS step, lag(f) OVER w AS above FROM lv WINDOW w AS (PARTITION BY page_idx ORDER BY n)),
q AS (SELECT page_idx, list_sort(list(step) FILTER (WHERE step IS NOT NULL)) AS steps, bool_and(f) AS every FROM sp GROUP BY 1), u AS (SELECT page_idx, steps[len(steps) // 4 + 1] AS usual, coalesce(every AND list_max(steps) < 1.3 * steps[len(steps) // 4 + 1], false) AS even FROM q),
nw AS (SELECT sp.page_idx, n, sum(CASE WHEN above IS NULL THEN 1 WHEN NOT f THEN 0 WHEN even OR NOT above THEN 1 WHEN step > 1.3 * usual THEN 1 ELSE 0 END) OVER (PARTITION BY sp.page_idx ORDER BY n) AS r FROM sp JOIN u ON u.page_idx = sp.page_idx),
pc AS (SELECT h.page_idx, r, k, text, row_number() OVER (PARTITION BY h.page_idx, r, k ORDER BY h.n, y0, x0, pos) AS j FROM h JOIN nw ON nw.page_idx = h.page_idx AND nw.n = h.n),
jn AS (SELECT page_idx, r, k, j, trim(text) AS t FROM pc WHERE j = 1 UNION ALL SELECT p.page_idx, p.r, p.k, p.j, {join_sql('jn.t', 'p.text')} FROM jn JOIN pc p ON p.page_idx = jn.page_idx AND p.r = jn.r AND p.k = jn.k AND p.j = jn.j + 1),
cell AS (SELECT page_idx, r, k, arg_max(t, j) AS t FROM jn GROUP BY ALL), size AS (SELECT page_idx, max(n_cols) AS n_cols FROM kept GROUP BY 1), rs AS (SELECT DISTINCT page_idx, r FROM nw)"""


@query(f"""WITH RECURSIVE {cte('dx_grid')}, plain AS (SELECT page_idx, pos, x0, y0, x1, y1, text FROM dx_grid WHERE bullet_x IS NULL), {table_sql()},
line AS (SELECT rs.page_idx, rs.r, '| ' || string_agg(coalesce(replace(t, '|', '\\|'), ''), ' | ' ORDER BY c.k) || ' |' AS line FROM rs JOIN size s ON s.page_idx = rs.page_idx JOIN LATERAL (SELECT unnest(range(1, s.n_cols + 1)) AS k) c ON true LEFT JOIN cell x ON x.page_idx = rs.page_idx AND x.r = rs.r AND x.k = c.k GROUP BY ALL)
SELECT page_idx, row_number() OVER (PARTITION BY page_idx ORDER BY r)::INTEGER AS row_no, line FROM line QUALIFY count(*) OVER (PARTITION BY page_idx) >= 3""")
def slide_table(spark, sf):
    """Tables of terms: wrapped meanings and terms, rows without a term, bullets between the rows."""
    found = slides.slide_tables(boxed(spark, sf, "dx_grid"), ["page_idx"])
    return found.select("page_idx", "row_no", slides.table_rows_markdown(F.col("cells")).alias("line"))


#: Cells within so many steps (along plus across) are of one part, for each gap of the ladder.
REACHES = "(VALUES (0, 9), (1, 7), (2, 5), (3, 5), (4, 3)) g(place, reach)"
CUT = "a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1"


@query(f"""WITH RECURSIVE {cte('dx_part', 'dx_ink')}, c AS (SELECT DISTINCT page_idx, gx, gy FROM dx_ink),
r AS (SELECT f.page_idx, place, reach, no, gx, gy FROM dx_part f JOIN c ON c.page_idx = f.page_idx AND gx * 2 < x1 AND gx * 2 + 2 > x0 AND gy * 2 < y1 AND gy * 2 + 2 > y0, {REACHES}
  UNION SELECT r.page_idx, place, reach, no, c.gx, c.gy FROM r JOIN c ON c.page_idx = r.page_idx AND abs(c.gx - r.gx) + abs(c.gy - r.gy) <= reach),
n AS (SELECT page_idx, place, gx, gy, count(*) AS n FROM r GROUP BY ALL), p AS (SELECT page_idx, coalesce(min(place) FILTER (WHERE most = 1), 4) AS place FROM (SELECT page_idx, place, max(n) AS most FROM n GROUP BY ALL) GROUP BY 1),
hull AS (SELECT r.page_idx, no, min(r.gx) * 2 AS a, min(r.gy) * 2 AS b, max(r.gx) * 2 + 2 AS c, max(r.gy) * 2 + 2 AS d FROM r JOIN n ON n.page_idx = r.page_idx AND n.place = r.place AND n.gx = r.gx AND n.gy = r.gy AND n.n = 1 JOIN p ON p.page_idx = r.page_idx AND p.place = r.place GROUP BY ALL),
w AS (SELECT f.page_idx, f.no, least(x0, a)::DOUBLE AS x0, least(y0, b)::DOUBLE AS y0, greatest(x1, c)::DOUBLE AS x1, greatest(y1, d)::DOUBLE AS y1 FROM dx_part f JOIN hull h ON h.page_idx = f.page_idx AND h.no = f.no),
free AS (SELECT * FROM w a WHERE NOT EXISTS (SELECT 1 FROM dx_part b WHERE b.page_idx = a.page_idx AND b.no <> a.no AND {CUT})), good AS (SELECT * FROM free a WHERE NOT EXISTS (SELECT 1 FROM free b WHERE b.page_idx = a.page_idx AND b.no < a.no AND {CUT}))
SELECT f.page_idx, f.no, coalesce(g.x0, f.x0) AS x0, coalesce(g.y0, f.y0) AS y0, coalesce(g.x1, f.x1) AS x1, coalesce(g.y1, f.y1) AS y1 FROM dx_part f LEFT JOIN good g ON g.page_idx = f.page_idx AND g.no = f.no""")
def ink_bridged(spark, sf):
    """Two figures a page grow over their ink, by the widest gap that keeps them apart."""
    found = raster.bridged(boxed(spark, sf, "dx_part"), frame(spark, sf, "dx_ink"), ["page_idx"])
    return found.select("page_idx", "no", "box.x0", "box.y0", "box.x1", "box.y1")


@query(f"""WITH {cte('dx_word')}, t AS (SELECT page_idx, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS word, pos % 3 = 0 AS t FROM dx_word), c AS (SELECT page_idx, word, count(*) FILTER (WHERE t) AS in_table, count(*) FILTER (WHERE NOT t) AS in_figure FROM t GROUP BY ALL)
SELECT * FROM c WHERE in_table > in_figure""")
def table_words_outside(spark, sf):
    """A third of a page's words as a table, the others as the figure that should hold them."""
    words = frame(spark, sf, "dx_word")
    told = lambda rows, name: rows.groupBy("page_idx").agg(F.array_join(F.array_sort(F.collect_list("text")), " ").alias(name))
    return verify.words_outside(told(words.filter("pos % 3 = 0"), "table_md"), told(words.filter("pos % 3 <> 0"), "text"), ["page_idx"])


@query(f"""WITH {cte('dx_block_span')}, s AS (SELECT *, length(trim(text)) AS n, font = 'Times' AND abs(size - 10) < 1 AS body FROM dx_block_span), b AS (SELECT page_idx, block_no, max(x1) - min(x0) AS wide, sum(n) AS n, coalesce(sum(n) FILTER (WHERE body), 0) AS n_body FROM s GROUP BY ALL),
l AS (SELECT page_idx, block_no, count(*) AS lines, avg(w) AS w FROM (SELECT page_idx, block_no, line_no, max(x1) - min(x0) AS w FROM s GROUP BY ALL) GROUP BY ALL)
SELECT page_idx, block_no FROM b JOIN l USING (page_idx, block_no) WHERE n > 0 AND n_body >= 0.2 * n AND lines >= 2 AND wide > 0.4 * 595 AND w >= 0.6 * wide""")
def body_paragraphs(spark, sf):
    spans = boxed(spark, sf, "dx_block_span")
    b = F.col("box")
    blocks = spans.groupBy("page_idx", "block_no").agg(rect(F.min(b["x0"]), F.min(b["y0"]), F.max(b["x1"]), F.max(b["y1"])).alias("box"))
    return figures.body_paragraphs(spans, blocks, ["page_idx"], "Times", 10.0, 595.0)


@query(f"""WITH {cte('dx_rule', 'dx_note')} SELECT r.page_idx, min(r.y0) AS y FROM dx_rule r JOIN dx_note n ON n.page_idx = r.page_idx AND r.y1 - r.y0 < 1.5 AND r.x1 - r.x0 > 40 AND r.x1 - r.x0 < 0.45 * 595 AND r.y0 > 0.6 * 842
AND n.y0 - r.y1 > 0 AND n.y0 - r.y1 < 20 AND abs(n.x0 - r.x0) < 6 AND size < 9.5 AND regexp_matches(text, '^[0-9]{{1,3}} ?[A-Za-z]') GROUP BY 1""")
def footnote_rules(spark, sf):
    return figures.footnote_rules(boxed(spark, sf, "dx_rule"), boxed(spark, sf, "dx_note"), ["page_idx"], 10.0, 595.0, 842.0)


#: Rows of lineitem whose pages page_figures works on at a time.
FIGURE_ROWS = 2_000_000


@query()
def page_figures(spark, sf):
    """Pages' figures end to end: text and drawings told apart, captions assembled, objects, then ink. Held by tests/test_flows.py and tests/test_figures.py.

    Some fifty tables are stored on the way, so pages come in parts: what a part stored is removed once its figures are written."""
    page, path = ["page_idx"], f"{shared_dir(spark)}/folio-figures-{uuid.uuid4().hex}"
    for lineitem in in_parts(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_orderkey"], FIGURE_ROWS, "lines"):
        with freed(spark), in_place(spark):
            schema = _figures_of(spark, sf, lineitem, page, path)
    return spark.read.schema(schema).parquet(path)


def _figures_of(spark, sf, lineitem, page, path):
    spans, drawings, ink = (laid_by(df, page) for df in (boxed(spark, sf, "dx_figure_span", lineitem=lineitem), boxed(spark, sf, "dx_figure_drawing", lineitem=lineitem), frame(spark, sf, "dx_figure_ink", lineitem)))
    items, caps, bodies, rules = figures.page_objects(spans, drawings, page, "Times", 10.0, 595.0, 842.0)
    found = raster.page_figures(items, caps, bodies, spans, ink, page, rules=rules, laid=True)
    found = found.select("page_idx", "no", "kind", "box.x0", "box.y0", "box.x1", "box.y1", "missing", "edge")
    found.write.mode("append").parquet(path)
    return found.schema
