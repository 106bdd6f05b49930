"""Registered queries of structure, geometry, figures and slides over layouts drawn from the tables; two are on authored rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.functions.geometry import gap, iou, minus
from folio.operators import figures, slides, structure
from folio.plans.derived import cte, frame
from folio.plans.fixtures import frame as authored
from folio.plans.text_queries import table

Q: dict = {}
O: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            O[f.__name__] = sql
        return f

    return add


def _flat(df, box="box"):
    return df.select(*[c for c in df.columns if c != box], *[F.col(box)[x].alias(x) for x in ("x0", "y0", "x1", "y1")])


@query(f"""WITH {cte('dx_span')}, s AS (SELECT doc_id, font, round_even(size, 0)::INTEGER AS size, length(trim(text)) AS n, row_number() OVER (ORDER BY doc_id, page_idx, block_no, line_no, span_no) AS i FROM dx_span),
g AS (SELECT doc_id, font, size, sum(n)::BIGINT AS n_chars, min(i) AS i FROM s GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n_chars DESC, i) AS k FROM g)
SELECT doc_id, font, size, n_chars FROM r WHERE k = 1""")
def body_mode(spark, sf):
    return structure.body_mode(frame(spark, sf, "dx_span"), ["doc_id"])


OFFSET = r"""l AS (SELECT doc_id, page_idx, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS f FROM {pages}),
e AS (SELECT doc_id, page_idx, unnest(list_concat(f[1:2], f[greatest(3, len(f) - 1):len(f)])) AS line, generate_subscripts(list_concat(f[1:2], f[greatest(3, len(f) - 1):len(f)]), 1) AS i FROM l),
w AS (SELECT doc_id, page_idx, i, unnest(regexp_extract_all(line, '\S+')) AS w, generate_subscripts(regexp_extract_all(line, '\S+'), 1) AS k FROM e),
v AS (SELECT *, page_idx - w::INTEGER + 1 AS page_offset FROM w WHERE regexp_full_match(w, '[0-9]{{1,4}}') AND w::INTEGER BETWEEN 1 AND 5000),
c AS (SELECT doc_id, page_offset, count(*) AS votes, min((page_idx, i, k)) AS seen FROM v GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY votes DESC, seen) AS n FROM c)"""


@query(f"WITH {cte('dx_page')}, {OFFSET.format(pages='dx_page')} SELECT doc_id, page_offset, votes FROM r WHERE n = 1 AND votes >= 5")
def page_offset_vote(spark, sf):
    return structure.page_offset(frame(spark, sf, "dx_page"), ["doc_id"])


@query("""SELECT * FROM (VALUES (1::BIGINT, 'chapter', '1', 'Basics', 4, 13), (1, 'chapter', '2', 'Data models', 14, 23), (1, 'appendix', 'A', 'Tools', 39, 43), (1, 'appendix', 'B', 'Appendix B', 44, 46), (1, 'glossary', '99', 'Glossary', 49, 53),
(2, 'chapter', '1', 'First', 0, 8), (2, 'chapter', '2', 'Second', 9, 18), (2, 'chapter', '3', 'Third', 19, 39)) t(doc_id, kind, no, title, first_page, last_page) UNION ALL SELECT 1, 'chapter', '3', 'Chapter 3', 24, 38""")
def chapter_bounds_bookmarks(spark, sf):
    return structure.chapters_from_bookmarks(authored(spark, "fx_bookmark"), authored(spark, "fx_document"), ["doc_id"])


@query("""SELECT * FROM (VALUES (1::BIGINT, 1, 'chapter', '1', 'Basics', 1), (1, 2, 'chapter', '2', 'Data models', 5), (1, 3, 'part', '', 'Part 2', 9), (1, 4, 'glossary', '', 'Glossary', 12), (1, 5, 'end', '', 'Index', 14)) t(doc_id, pos, kind, no, title, printed_page)""")
def contents_entries(spark, sf):
    return structure.contents_entries(authored(spark, "fx_page"), ["doc_id"])


@query(f"""WITH {cte('dx_toc_entry', 'dx_offset', 'dx_document')},
first_ AS (SELECT *, row_number() OVER (PARTITION BY doc_id, kind, CASE WHEN kind IN ('glossary', 'end') THEN '' ELSE no END ORDER BY pos) AS k FROM dx_toc_entry WHERE kind <> 'part'),
ch AS (SELECT * FROM first_ WHERE k = 1 AND kind = 'chapter'), books AS (SELECT doc_id, max(printed_page) AS last_start FROM ch GROUP BY 1 HAVING count(*) >= 2),
b AS (SELECT doc_id, kind, no, title, printed_page FROM first_ JOIN books USING (doc_id) WHERE k = 1 AND (kind <> 'appendix' OR printed_page > last_start)
  UNION ALL SELECT doc_id, kind, no, title, printed_page FROM dx_toc_entry p JOIN books USING (doc_id) WHERE kind = 'part' AND NOT EXISTS (SELECT 1 FROM ch WHERE ch.doc_id = p.doc_id AND p.printed_page - ch.printed_page BETWEEN 0 AND 2))
SELECT b.doc_id, kind, CASE WHEN kind = 'glossary' THEN '99' ELSE no END AS no, title, greatest(0, least(n_pages - 1, printed_page - 1 + page_offset))::INTEGER AS first_page,
  coalesce(greatest(0, least(n_pages - 1, (SELECT min(x.printed_page) FROM b x WHERE x.doc_id = b.doc_id AND x.printed_page > b.printed_page) - 2 + page_offset)), n_pages - 1)::INTEGER AS last_page
FROM b JOIN dx_offset USING (doc_id) JOIN dx_document USING (doc_id) WHERE kind IN ('chapter', 'appendix', 'glossary')""")
def chapter_bounds_contents(spark, sf):
    return structure.chapters_from_contents(frame(spark, sf, "dx_toc_entry"), frame(spark, sf, "dx_offset"), frame(spark, sf, "dx_document"), ["doc_id"])


PAIRS = "pair AS (SELECT a.set_id, a.box_id AS a_id, b.box_id AS b_id, a.x0 AS ax0, a.y0 AS ay0, a.x1 AS ax1, a.y1 AS ay1, b.x0 AS bx0, b.y0 AS by0, b.x1 AS bx1, b.y1 AS by1 FROM dx_box a JOIN dx_box b ON a.set_id = b.set_id AND a.box_id < b.box_id)"


@query(f"""WITH {cte('dx_box')}, {PAIRS}, m AS (SELECT *, greatest(0, least(ax1, bx1) - greatest(ax0, bx0)) * greatest(0, least(ay1, by1) - greatest(ay0, by0)) AS i FROM pair)
SELECT set_id, a_id, b_id, greatest(0, greatest(ax0, bx0) - least(ax1, bx1), greatest(ay0, by0) - least(ay1, by1))::DOUBLE AS gap, (i / ((ax1 - ax0) * (ay1 - ay0) + (bx1 - bx0) * (by1 - by0) - i))::DOUBLE AS iou FROM m""")
def box_gaps(spark, sf):
    b = figures.boxes(frame(spark, sf, "dx_box"))
    other = b.select("set_id", F.col("box_id").alias("b_id"), F.col("box").alias("b"))
    rows = b.withColumnRenamed("box_id", "a_id").join(other, "set_id").filter("a_id < b_id")
    return rows.select("set_id", "a_id", "b_id", gap(F.col("box"), F.col("b")).alias("gap"), iou(F.col("box"), F.col("b")).alias("iou"))


@query(f"""WITH {cte('dx_box')}, {PAIRS}, hit AS (SELECT * FROM pair WHERE ax0 < bx1 AND bx0 < ax1 AND ay0 < by1 AND by0 < ay1),
p AS (SELECT set_id, a_id, b_id, ax0 AS x0, ay0 AS y0, ax1 AS x1, by0 AS y1 FROM hit UNION ALL SELECT set_id, a_id, b_id, ax0, by1, ax1, ay1 FROM hit
 UNION ALL SELECT set_id, a_id, b_id, ax0, greatest(ay0, by0), bx0, least(ay1, by1) FROM hit UNION ALL SELECT set_id, a_id, b_id, bx1, greatest(ay0, by0), ax1, least(ay1, by1) FROM hit)
SELECT set_id, a_id, b_id, sum((x1 - x0) * (y1 - y0))::DOUBLE AS outside FROM p WHERE x1 > x0 AND y1 > y0 GROUP BY ALL""")
def box_difference(spark, sf):
    b = figures.boxes(frame(spark, sf, "dx_box"))
    other = b.select("set_id", F.col("box_id").alias("b_id"), F.col("box").alias("b"))
    rows = b.withColumnRenamed("box_id", "a_id").join(other, "set_id").filter("a_id < b_id").filter(gap(F.col("box"), F.col("b")) == 0)
    parts = rows.select("set_id", "a_id", "b_id", "box", F.explode(minus(F.col("box"), F.col("b"))).alias("p")).filter("p <> box")
    return parts.groupBy("set_id", "a_id", "b_id").agg(F.sum((F.col("p.x1") - F.col("p.x0")) * (F.col("p.y1") - F.col("p.y0"))).alias("outside"))


NEAR = "a.x0 - 9 < b.x1 AND b.x0 < a.x1 + 9 AND a.y0 - 9 < b.y1 AND b.y0 < a.y1 + 9"


@query(f"""WITH RECURSIVE {cte('dx_box')}, m AS (SELECT set_id, 0 AS step, list({{'k': box_id, 'n': 1::BIGINT, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}}) AS l FROM dx_box GROUP BY set_id
  UNION ALL SELECT set_id, step + 1, list_append(list_filter(l, lambda c, i: i <> t.i AND i <> t.j), {{'k': least(l[t.i].k, l[t.j].k), 'n': l[t.i].n + l[t.j].n, 'x0': least(l[t.i].x0, l[t.j].x0), 'y0': least(l[t.i].y0, l[t.j].y0), 'x1': greatest(l[t.i].x1, l[t.j].x1), 'y1': greatest(l[t.i].y1, l[t.j].y1)}})
    FROM (SELECT set_id, step, l, list_filter(flatten(list_transform(range(1, len(l) + 1), lambda i: list_transform(range(i + 1, len(l) + 1), lambda j: {{'i': i, 'j': j}}))), lambda t: {NEAR.replace('a.', 'l[t.i].').replace('b.', 'l[t.j].')}) [1] AS t FROM m) WHERE t IS NOT NULL),
e AS (SELECT set_id, unnest(arg_max(l, step)) AS c FROM m GROUP BY set_id) SELECT set_id, c.k AS cluster, c.n AS n, c.x0 AS x0, c.y0 AS y0, c.x1 AS x1, c.y1 AS y1 FROM e""")
def rect_components(spark, sf):
    return _flat(figures.components(figures.boxes(frame(spark, sf, "dx_box")), ["set_id"]))


@query(f"""WITH {cte('dx_box')}, {PAIRS}, m AS (SELECT *, greatest(0, least(ax1, bx1) - greatest(ax0, bx0)) * greatest(0, least(ay1, by1) - greatest(ay0, by0)) / least((ax1 - ax0) * (ay1 - ay0), (bx1 - bx0) * (by1 - by0)) AS share FROM pair)
SELECT set_id, a_id AS no, b_id AS other, share::DOUBLE AS share FROM m WHERE share > 0.05""")
def box_overlap_audit(spark, sf):
    return figures.overlapping(figures.boxes(frame(spark, sf, "dx_box")).withColumnRenamed("box_id", "no"), ["set_id"])


@query(f"""WITH {cte('dx_caption', 'dx_cluster')}, d AS (SELECT k.page_idx, cluster, no, least(abs(k.y0 - a.y0), abs(a.y0 - k.y1), abs(k.y0 - a.y1),
  CASE WHEN least(k.y1, a.y1) - greatest(k.y0, a.y0) > 0.5 * least(a.y1 - a.y0, k.y1 - k.y0) AND greatest(k.x0 - a.x1, a.x0 - k.x1) < 60 THEN abs(k.y1 - a.y1) ELSE 1e9 END)::DOUBLE AS distance
  FROM dx_cluster k JOIN dx_caption a ON k.page_idx = a.page_idx), r AS (SELECT *, row_number() OVER (PARTITION BY page_idx, cluster ORDER BY distance, no) AS i FROM d WHERE distance < 40)
SELECT page_idx, cluster, no, distance FROM r WHERE i = 1""")
def nearest_caption(spark, sf):
    caps = figures.boxes(frame(spark, sf, "dx_caption"), "caption_box")
    return figures.nearest_caption(figures.boxes(frame(spark, sf, "dx_cluster")), caps, ["page_idx"])


DISTANCE = """least(abs(k.y0 - a.y0), abs(a.y0 - k.y1), abs(k.y0 - a.y1), CASE WHEN least(k.y1, a.y1) - greatest(k.y0, a.y0) > 0.5 * least(a.y1 - a.y0, k.y1 - k.y0) AND greatest(k.x0 - a.x1, a.x0 - k.x1) < 60 THEN abs(k.y1 - a.y1) ELSE 1e9 END)::DOUBLE"""


@query(f"""WITH RECURSIVE {cte('dx_caption', 'dx_cluster')}, a AS (SELECT *, row_number() OVER (PARTITION BY page_idx ORDER BY y0, x0, no, kind) AS i FROM dx_caption),
c AS (SELECT a.page_idx, a.i, any_value(a.no) AS no, any_value(a.kind) AS kind, list_sort(list({{'d': {DISTANCE}, 'c': cluster}}) FILTER (WHERE {DISTANCE} < 40)) AS near FROM a LEFT JOIN dx_cluster k ON k.page_idx = a.page_idx GROUP BY a.page_idx, a.i),
r AS (SELECT page_idx, 0::BIGINT AS i, NULL::VARCHAR AS no, NULL::VARCHAR AS kind, NULL::STRUCT(d DOUBLE, c BIGINT) AS got, []::BIGINT[] AS taken FROM c GROUP BY 1
  UNION ALL SELECT page_idx, i, no, kind, got, CASE WHEN got IS NULL THEN taken ELSE list_append(taken, got.c) END FROM (SELECT c.*, taken, list_filter(near, lambda x: NOT list_contains(taken, x.c))[1] AS got FROM r JOIN c ON c.page_idx = r.page_idx AND c.i = r.i + 1))
SELECT page_idx, no, kind, got.d AS distance, got IS NULL AS missing FROM r WHERE i > 0""")
def figure_assignment(spark, sf):
    caps = figures.boxes(frame(spark, sf, "dx_caption"), "caption_box")
    return figures.assigned(figures.boxes(frame(spark, sf, "dx_cluster")), caps, ["page_idx"]).select("page_idx", "no", "kind", "distance", "missing")


@query("SELECT * FROM (VALUES (0, '1.1', 50.0::DOUBLE, 10.0::DOUBLE, 380.0::DOUBLE, 115.0::DOUBLE)) t(page_idx, no, x0, y0, x1, y1)")
def figure_growth(spark, sf):
    def box(rows, names):
        return spark.createDataFrame(rows, "page_idx int, x0 double, y0 double, x1 double, y1 double, " + names)

    fig = figures.boxes(spark.createDataFrame([(0, "1.1", 50.0, 20.0, 300.0, 110.0)], "page_idx int, no string, x0 double, y0 double, x1 double, y1 double"))
    items = figures.boxes(box([(0, 290.0, 10.0, 320.0, 40.0, True), (0, 340.0, 20.0, 380.0, 115.0, False), (0, 50.0, 120.0, 200.0, 130.0, False), (0, 600.0, 20.0, 620.0, 30.0, True)], "drawn boolean"))
    walls = figures.boxes(box([(0, 50.0, 118.0, 300.0, 140.0, True)], "body boolean"))
    return _flat(figures.grow(fig, items, walls, ["page_idx"]))


@query(f"""WITH {cte('dx_word', 'dx_cell')}, w AS (SELECT c.page_idx, table_id, row_no, col_no, round_even(w.y0 / 3, 0) AS line, w.x0, text FROM dx_word w JOIN dx_cell c ON w.page_idx = c.page_idx
 AND (w.x0 + w.x1) / 2 >= c.x0 AND (w.x0 + w.x1) / 2 < c.x1 AND (w.y0 + w.y1) / 2 >= c.y0 AND (w.y0 + w.y1) / 2 < c.y1)
SELECT page_idx, table_id, row_no, col_no, replace(regexp_replace(string_agg(text, ' ' ORDER BY line, x0, text), '(\\w)- ([a-z])', '\\1-\\2', 'g'), '|', '/') AS text FROM w GROUP BY ALL""")
def table_cells(spark, sf):
    return figures.table_cells(figures.boxes(frame(spark, sf, "dx_word")), figures.boxes(frame(spark, sf, "dx_cell"), "cell"), ["page_idx"])


@query(f"""WITH {cte('dx_word', 'dx_cell')}, w AS (SELECT c.page_idx, table_id, row_no, col_no, round_even(w.y0 / 3, 0) AS line, w.x0, text FROM dx_word w JOIN dx_cell c ON w.page_idx = c.page_idx
 AND (w.x0 + w.x1) / 2 >= c.x0 AND (w.x0 + w.x1) / 2 < c.x1 AND (w.y0 + w.y1) / 2 >= c.y0 AND (w.y0 + w.y1) / 2 < c.y1),
t AS (SELECT page_idx, table_id, row_no, col_no, replace(regexp_replace(string_agg(text, ' ' ORDER BY line, x0, text), '(\\w)- ([a-z])', '\\1-\\2', 'g'), '|', '/') AS text FROM w GROUP BY ALL), e AS (SELECT c.page_idx, c.table_id, c.row_no, c.col_no, coalesce(text, '') AS text FROM dx_cell c LEFT JOIN t USING (page_idx, table_id, row_no, col_no)),
r AS (SELECT page_idx, table_id, row_no, list(text ORDER BY col_no) AS cells FROM e GROUP BY ALL HAVING bool_or(text <> '')), m AS (SELECT page_idx, table_id, count(*) AS n_rows, max(len(cells))::INTEGER AS n_cols, list('| ' || array_to_string(cells, ' | ') || ' |' ORDER BY row_no) AS l,
 sum(len(list_filter(cells, lambda x: x <> ''))) / sum(len(cells)) AS fill, sum(list_sum(list_transform(cells, lambda x: len(regexp_extract_all(x, '\\S+'))))) AS n_words FROM r GROUP BY ALL)
SELECT page_idx, table_id, n_rows, n_cols, l[1] || chr(10) || '|' || repeat('---|', n_cols) || chr(10) || array_to_string(l[2:], chr(10)) AS table_md FROM m WHERE n_cols >= 2 AND n_rows >= 2 AND fill >= 0.6 AND n_words >= 15""")
def table_markdown(spark, sf):
    cells = figures.boxes(frame(spark, sf, "dx_cell"), "cell")
    return figures.table_markdown(figures.table_cells(figures.boxes(frame(spark, sf, "dx_word")), cells, ["page_idx"]), cells, ["page_idx"])


@query(f"WITH {cte('dx_caption')}, n AS (SELECT page_idx, no, kind, row_number() OVER (PARTITION BY floor(page_idx / 10), kind, no ORDER BY page_idx) AS i FROM dx_caption) SELECT page_idx, no, kind, kind || '-' || no || (CASE WHEN i > 1 THEN '-' || i ELSE '' END) || '.png' AS file_name FROM n")
def figure_names(spark, sf):
    rows = frame(spark, sf, "dx_caption").select("page_idx", "no", "kind", F.floor(F.col("page_idx") / 10).alias("book"))
    return figures.unique_names(rows, ["book"], ["page_idx"]).drop("book")


ISLANDS = """c AS (SELECT user_id, value, count(*) AS c FROM events WHERE value IS NOT NULL GROUP BY ALL), s AS (SELECT *, CASE WHEN value - lag(value) OVER w <= {tol} THEN 0 ELSE 1 END AS step FROM c WINDOW w AS (PARTITION BY user_id ORDER BY value)),
g AS (SELECT *, sum(step) OVER (PARTITION BY user_id ORDER BY value RANGE UNBOUNDED PRECEDING)::INTEGER AS cluster FROM s)"""


@query(f"WITH {ISLANDS.format(tol=5)} SELECT user_id, cluster, round(sum(value * c ORDER BY value) / sum(c), 6) AS centre, sum(c)::BIGINT AS n FROM g GROUP BY ALL")
def clusters_1d(spark, sf):
    found = slides.clusters_1d(table(spark, sf, "events"), ["user_id"], "value", 5.0)
    return found.withColumn("centre", F.round("centre", 6))


@query("WITH r AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events WHERE value IS NOT NULL) SELECT user_id, value AS median FROM r WHERE i = n // 2")
def upper_median(spark, sf):
    return slides.upper_median(table(spark, sf, "events"), ["user_id"], "value")


@query("WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL) SELECT event_type, value AS median FROM r WHERE i = n // 4")
def lower_quartile(spark, sf):
    return slides.upper_median(table(spark, sf, "events"), ["event_type"], "value", 4)


@query(f"""WITH RECURSIVE {cte('dx_line', 'dx_mark')}, n AS (SELECT m.deck_id, m.page_idx, m.mark, list_sort(list({{'far': abs((y0 + y1) / 2 - yc) > 0.6 * (y1 - y0), 'dx': x0 - x, 'dy': abs((y0 + y1) / 2 - yc), 'pos': pos}})) AS near
  FROM dx_mark m JOIN dx_line l ON l.deck_id = m.deck_id AND l.page_idx = m.page_idx AND x0 > x AND x0 - x < 90 AND yc BETWEEN y0 - 0.3 * (y1 - y0) AND y1 + 0.3 * (y1 - y0) GROUP BY ALL),
c AS (SELECT *, row_number() OVER (PARTITION BY deck_id, page_idx ORDER BY mark) AS i FROM n),
r AS (SELECT deck_id, page_idx, 0::BIGINT AS i, NULL::INTEGER AS mark, NULL::INTEGER AS pos, []::INTEGER[] AS taken FROM c GROUP BY ALL
  UNION ALL SELECT deck_id, page_idx, i, mark, got, CASE WHEN got IS NULL THEN taken ELSE list_append(taken, got) END FROM (SELECT c.*, taken, list_filter(near, lambda x: NOT list_contains(taken, x.pos))[1].pos AS got FROM r JOIN c ON c.deck_id = r.deck_id AND c.page_idx = r.page_idx AND c.i = r.i + 1))
SELECT deck_id, page_idx, mark, pos FROM r WHERE pos IS NOT NULL""")
def matched_bullets(spark, sf):
    return slides.matched_bullets(figures.boxes(frame(spark, sf, "dx_line")), frame(spark, sf, "dx_mark"), ["deck_id", "page_idx"])


@query(r"""WITH b AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<(?:h[1-6]|li)[^>]*>.*?</(?:h[1-6]|li)>')) AS b, generate_subscripts(regexp_extract_all(html, '(?is)<(?:h[1-6]|li)[^>]*>.*?</(?:h[1-6]|li)>'), 1) AS i FROM pages),
t AS (SELECT page_id, i, CASE WHEN b ILIKE '<li%' THEN '- ' ELSE '### ' END || regexp_replace(regexp_replace(regexp_replace(b, '<[^>]*>', '', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS line FROM b)
SELECT page_id, '## ' || page_id || chr(10) || chr(10) || string_agg(line, chr(10) ORDER BY i) AS md FROM t GROUP BY page_id""")
def slide_markdown(spark, sf):
    """Headings and list items of web pages as the blocks of a slide."""
    found = F.regexp_extract_all("html", F.lit(r"(?is)(<(?:h[1-6]|li)[^>]*>.*?</(?:h[1-6]|li)>)"), F.lit(1))
    items = F.transform(found, lambda b: F.struct(F.when(F.lower(b).startswith("<li"), "item").otherwise("heading").alias("kind"), F.lit(0).alias("level"), F.regexp_replace(b, "<[^>]*>", "").alias("text")))
    return table(spark, sf, "pages").select("page_id", slides.slide_markdown(F.col("page_id").cast("string"), items, F.lit(None).cast("string")).alias("md"))


