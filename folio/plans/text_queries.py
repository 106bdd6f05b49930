"""Registered queries of cleaning, packing, vocabularies and coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions.text import capital_d, lines, odd_case, tokens, words
from folio.operators import pack, stitch, textclean, verify, vocab
from folio.plans.derived import cte as drawn_cte
from folio.plans.derived import frame as drawn
from folio.plans.fixtures import cte, frame
from folio.plans.runtime import spread

BOOK = ["source", "lang"]
Q: dict = {}
O: dict[str, str] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            O[f.__name__] = sql
        return f

    return add


LINES = r"""lined AS (SELECT doc_id, source, lang, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents),
ranked AS (SELECT *, regexp_replace(line, '^\s+|\s+$', '', 'g') AS s FROM lined),
filled AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS up, row_number() OVER (PARTITION BY doc_id ORDER BY line_no DESC) AS down FROM ranked WHERE s <> ''),
edges AS (SELECT *, regexp_replace(lower(s), '[0-9]+', '#', 'g') AS header FROM filled WHERE (up <= 3 OR down <= 3) AND length(s) <= 100),
headers AS (SELECT c.source, c.lang, header, n_pages, book_pages FROM (SELECT source, lang, header, count(*) AS n_pages FROM (SELECT DISTINCT doc_id, source, lang, line, header FROM edges) GROUP BY ALL) c
  JOIN (SELECT source, lang, count(*) AS book_pages FROM documents GROUP BY ALL) b ON c.source IS NOT DISTINCT FROM b.source AND c.lang IS NOT DISTINCT FROM b.lang
  WHERE n_pages >= greatest(3, book_pages // 4)),
removed AS (SELECT doc_id, source, lang, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '') AS text FROM (
  SELECT l.*, EXISTS (SELECT 1 FROM edges e JOIN headers h ON e.header = h.header AND e.source IS NOT DISTINCT FROM h.source AND e.lang IS NOT DISTINCT FROM h.lang
     WHERE e.doc_id = l.doc_id AND e.line_no = l.line_no) AS gone FROM lined l) GROUP BY ALL)"""


@query("SELECT doc_id, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INTEGER AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents")
def lines_exploded(spark, sf):
    return textclean.exploded_lines(table(spark, sf, "documents"), "doc_id")


@query(f"WITH {LINES} SELECT * FROM headers")
def running_headers(spark, sf):
    return textclean.running_headers(table(spark, sf, "documents"), BOOK)


@query(f"WITH {LINES} SELECT doc_id, text FROM removed")
def headers_removed(spark, sf):
    return textclean.remove_headers(table(spark, sf, "documents"), BOOK).select("doc_id", "text")


@query(r"SELECT doc_id, len(t)::BIGINT AS n_tokens, len(list_distinct(t))::BIGINT AS n_distinct FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS t FROM documents)")
def line_tokens(spark, sf):
    t = tokens(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.size(t).cast("long").alias("n_tokens"), F.size(F.array_distinct(t)).cast("long").alias("n_distinct"))


@query(r"SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS word FROM documents) GROUP BY ALL")
def vocabulary(spark, sf):
    return vocab.vocabulary(table(spark, sf, "documents"), ["lang"])


PACK = r"""sized AS (SELECT source, lang, doc_id, coalesce(len(regexp_extract_all(regexp_replace({text}, '!\[[^\]]*\]\([^)]*\)|<!--.*?-->', '', 'g'), '\S+')), 0)::BIGINT AS n_words, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id, n_words) AS i FROM {docs}),
packed AS (SELECT source, lang, doc_id, n_words, i, n_words AS filled, 1 AS chunk_no FROM sized WHERE i = 1
  UNION ALL SELECT s.source, s.lang, s.doc_id, s.n_words, s.i, CASE WHEN p.filled + s.n_words > 1800 THEN s.n_words ELSE p.filled + s.n_words END, p.chunk_no + (CASE WHEN p.filled + s.n_words > 1800 THEN 1 ELSE 0 END)
  FROM packed p JOIN sized s ON s.i = p.i + 1 AND s.source IS NOT DISTINCT FROM p.source AND s.lang IS NOT DISTINCT FROM p.lang)"""


@query(f"WITH RECURSIVE {PACK.format(text='text', docs='documents')} SELECT source, lang, chunk_no, min(doc_id) AS first_page, max(doc_id) AS last_page, count(*) AS n_pages, sum(n_words)::BIGINT AS n_words FROM packed GROUP BY ALL")
def chunk_pack(spark, sf):
    return pack.chunks(table(spark, sf, "documents"), BOOK, "doc_id")


COVER = r"""tok AS (SELECT doc_id, source, lang, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS word, 1 AS s, 0 AS o FROM documents
  UNION ALL SELECT doc_id, source, lang, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')), 0, 1 FROM removed),
counted AS (SELECT doc_id, source, lang, word, sum(s)::BIGINT AS s, sum(o)::BIGINT AS o FROM tok GROUP BY ALL),
cover AS (SELECT doc_id, source, lang, sum(s)::BIGINT AS total, sum(least(s, o))::BIGINT AS common, sum(s - least(s, o))::BIGINT AS missing, sum(o - least(s, o))::BIGINT AS extra FROM counted GROUP BY ALL)"""


def _cover(spark, sf) -> DataFrame:
    docs = spread(table(spark, sf, "documents"))
    cleaned = textclean.remove_headers(docs.withColumn("raw", F.col("text")), BOOK)
    return verify.coverage(cleaned, ["doc_id", "source", "lang"], "raw", "text")


@query(f"WITH {LINES}, {COVER} SELECT doc_id, total, common, missing, extra, CASE WHEN total = 0 THEN 1.0 ELSE common / total END::DOUBLE AS coverage FROM cover")
def word_coverage(spark, sf):
    return _cover(spark, sf).drop("source", "lang")


@query(f"WITH {LINES}, {COVER} SELECT source, lang, sum(total)::BIGINT AS total, sum(common)::BIGINT AS common, sum(missing)::BIGINT AS missing, sum(extra)::BIGINT AS extra, grouping(source, lang)::INTEGER AS level, CASE WHEN sum(total) = 0 THEN 1.0 ELSE sum(common) / sum(total) END::DOUBLE AS coverage FROM cover GROUP BY ROLLUP (source, lang)")
def coverage_rollup(spark, sf):
    return verify.coverage_rollup(_cover(spark, sf), BOOK)


@query(rf"""WITH RECURSIVE {LINES}, {COVER}, {PACK.format(text='text', docs='removed')}
SELECT p.source, p.lang, p.chunk_no, min(p.doc_id) AS first_page, max(p.doc_id) AS last_page, count(*) AS n_pages, sum(p.n_words)::BIGINT AS n_words, sum(coalesce(c.total, 0))::BIGINT AS total, sum(coalesce(c.common, 0))::BIGINT AS common
FROM packed p LEFT JOIN cover c USING (doc_id) GROUP BY p.source, p.lang, p.chunk_no""")
def packed_coverage(spark, sf):
    """Flagship: headers removed, pages packed, and the words of each chunk checked against the source."""
    docs = spread(table(spark, sf, "documents").select(*BOOK, "doc_id", "text")).withColumn("raw", F.col("text"))
    cleaned = textclean.remove_headers(docs, BOOK)
    # texts are read once: what later steps need of a page is a handful of numbers
    compared = cleaned.select(*BOOK, "doc_id", "text", verify.covered(F.col("raw"), F.col("text")).alias("c")).select(*BOOK, "doc_id", "text", "c.total", "c.common")
    numbered = pack.chunk_numbers(compared, BOOK, "doc_id", carry=["total", "common"])
    return numbered.groupBy(*BOOK, "chunk_no").agg(F.min("doc_id").alias("first_page"), F.max("doc_id").alias("last_page"), F.count(F.lit(1)).alias("n_pages"), F.sum("n_words").alias("n_words"), F.sum("total").alias("total"), F.sum("common").alias("common"))


@query(r"""WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<h[1-6][^>]*>.*?</h[1-6]>')) AS h, generate_subscripts(regexp_extract_all(html, '(?is)<h[1-6][^>]*>.*?</h[1-6]>'), 1) - 1 AS pos FROM pages)
SELECT page_id, pos::INTEGER AS pos, regexp_extract(h, '(?i)^<h([1-6])', 1)::INTEGER AS level, regexp_replace(regexp_replace(regexp_replace(h, '<[^>]*>', '', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS title FROM h
WHERE NOT regexp_matches(title, '(?i)objectives|contents|key points|further reading|exercises') AND title <> ''""")
def outline(spark, sf):
    return pack.outline(pack.html_headings(table(spark, sf, "pages"), "page_id"))


@query(rf"""WITH {cte('fx_term')}, v AS (SELECT term_id, unnest(source) AS variant, generate_subscripts(source, 1) AS i FROM fx_term),
p AS (SELECT *, '(?i)(^|[^A-Za-z])' || replace(replace(regexp_replace(variant, '([.\\+*?\[\](){{}}^$|])', '\\\1', 'g'), 'isation', 'i[sz]ation'), 'centred', 'cent(red|ered)') AS pattern FROM v)
SELECT doc_id, term_id, min_by(variant, i) AS variant FROM documents JOIN p ON regexp_matches(text, pattern) GROUP BY ALL""")
def glossary_hits(spark, sf):
    return pack.glossary_hits(spread(table(spark, sf, "documents").select("doc_id", "text")), frame(spark, "fx_term"), "doc_id")


@query(rf"""WITH {cte('fx_term')}, p AS (SELECT term_id, unnest(forbidden) AS form FROM fx_term)
SELECT conv_id, turn, term_id, form FROM conversations JOIN p ON regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{N}}_])' || form) WHERE role = 'assistant'""")
def forbidden_terms(spark, sf):
    return pack.forbidden_uses(table(spark, sf, "conversations").filter("role = 'assistant'"), frame(spark, "fx_term"), ["conv_id", "turn"])


@query(f"""WITH RECURSIVE {PACK.format(text='text', docs='documents')}, made AS (SELECT p.source, p.lang, chunk_no, 'Pages ' || min(p.doc_id) || '-' || max(p.doc_id) || chr(10) || chr(10) || string_agg(text, chr(10) || chr(10) ORDER BY p.doc_id) AS prompt
FROM packed p JOIN documents d USING (doc_id) GROUP BY p.source, p.lang, chunk_no) SELECT source, lang, chunk_no, max(chunk_no) OVER (PARTITION BY source, lang) AS n_chunks, prompt FROM made""")
def chunk_prompts(spark, sf):
    return pack.prompts(table(spark, sf, "documents"), BOOK, "doc_id", "Pages %s\n\n%s")


@query(rf"""WITH {drawn_cte('dx_paragraph')}, near AS (SELECT *, lag(text) OVER w AS b, lead(text) OVER w AS n FROM dx_paragraph WINDOW w AS (PARTITION BY doc_id ORDER BY pos))
SELECT doc_id, pos, text, CASE WHEN regexp_matches(text, '^#{{1,5}}\s') THEN 'heading' WHEN regexp_matches(text, '^###### ') THEN 'box'
 WHEN regexp_matches(text, '^(\||<!--|!\[)') OR contains(text, '<br>') OR regexp_matches(text, '^(#+\s*)?https?://\S+$') OR (regexp_matches(text, '^(Figure|Table) [0-9]+\.[0-9]+ [A-Z]') AND len(regexp_extract_all(text, '\S+')) <= 20)
   OR (len(regexp_extract_all(text, '\S+')) <= 6 AND NOT regexp_matches(text, '[.:!?]$') AND NOT regexp_matches(text, '^[-*+] ') AND (coalesce(regexp_matches(b, '^(Figure|Table) [0-9]+\.[0-9]+ [A-Z]'), false) OR coalesce(regexp_matches(n, '^(Figure|Table) [0-9]+\.[0-9]+ [A-Z]'), false) OR coalesce(contains(b, '<br>'), false) OR coalesce(contains(n, '<br>'), false)))
 THEN 'floating' ELSE 'text' END AS kind FROM near""")
def paragraph_kind(spark, sf):
    return textclean.paragraph_kinds(drawn(spark, sf, "dx_paragraph"), ["doc_id"])


STITCHED = [(1, 1, "heading", "# Chapter one"), (1, 2, "text", "In most places there are now fewer natural resources, and they change."), (1, 3, "floating", "| a | b |"), (1, 4, "box", "###### History of it"), (1, 5, "text", "A box with its own end."), (1, 7, "text", "The language for all of this is called Unified Modeling Language, or UML."), (1, 8, "floating", "![x](y.png)"), (1, 9, "floating", "Figure 2.1 A caption"), (1, 10, "floating", "of testing"), (1, 12, "text", "- an item that is not text"), (1, 13, "text", "A longer paragraph that ends nowhere at all"), (1, 14, "heading", "## Next"), (1, 15, "text", "goes not back over a heading."), (1, 16, "floating", "https://example.com/a"), (2, 1, "text", "Whole."), (2, 2, "text", "Also whole.")]


@query("SELECT * FROM (VALUES " + ", ".join(f"({d}::BIGINT, {p}, '{k}', '{t}')" for d, p, k, t in STITCHED) + ") t(doc_id, pos, kind, text)")
def stitched_paragraphs(spark, sf):
    return stitch.stitched(frame(spark, "fx_paragraph"), ["doc_id"])


@query(rf"""WITH {drawn_cte('dx_bullet')}, f AS (SELECT *, regexp_matches(text, '^- I [A-Za-z]') AS g FROM dx_bullet WHERE text <> ''),
r AS (SELECT *, sum(CASE WHEN g THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM f)
SELECT doc_id, pos, CASE WHEN g AND sum(CASE WHEN g THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, run) >= 2 THEN '- ' || substr(text, 5) ELSE text END AS text FROM r
UNION ALL SELECT doc_id, pos, text FROM dx_bullet WHERE text = ''""")
def bullet_glyph_runs(spark, sf):
    return textclean.bullet_glyphs(drawn(spark, sf, "dx_bullet"), ["doc_id"])


@query("SELECT * FROM (VALUES (1::BIGINT, 0, 'A service-centric view and development of real-time systems.'), (1, 1, 'By Addison-Wesley; DIFFERENCE and the DIFFERENCE. A lifetime. The up-front cost, up-front.')) t(doc_id, page_idx, text)")
def hyphen_repaired(spark, sf):
    return textclean.repair_hyphens(frame(spark, "fx_clean"), frame(spark, "fx_raw"), ["doc_id"])


PLACE = r"^[\t\n\x0b\f\r ]*(?:(?:[-*]|[0-9]+\.)[\t\n\x0b\f\r ]+)?|[.!?] "
CAPITALS = rf"SELECT doc_id, regexp_replace(regexp_replace(text, '(?m)({PLACE})d([a-np-z][a-z]|o[a-hj-z])', '\1D\2', 'g'), '(?m)({PLACE})doi([0-9A-Za-z_])', '\1Doi\2', 'g') AS text FROM documents"


@query(CAPITALS)
def capitals_restored(spark, sf):
    return table(spark, sf, "documents").select("doc_id", capital_d(F.col("text")).alias("text"))


@query("SELECT * FROM (VALUES (1::BIGINT, 1, 'a hazard in the plant'), (1, 2, 'every hazard counts in to day'), (1, 3, 'into the hazard zone, rd'), (2, 1, 'haza rd alone'), (1, 4, 'the system and a system to')) t(deck_id, pos, text)")
def split_word_repair(spark, sf):
    return vocab.repair_split_words(frame(spark, "fx_torn"), ["deck_id"], ["pos"])


EDIT = r"""v AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS word FROM documents) GROUP BY word),
rare AS (SELECT word FROM v WHERE n <= 1), known AS (SELECT word, n FROM v WHERE n >= 5)"""


# one edit by character: one place replaced, or one letter more on either side
FIXES = rf"""WITH {EDIT}, a AS (SELECT word FROM rare WHERE length(word) >= 6), k AS (SELECT word AS fixed FROM known WHERE length(word) >= 5),
da AS (SELECT word, unnest(range(1, length(word) + 1)) AS i, substr(word, 1, i - 1) || substr(word, i + 1) AS form FROM a), dk AS (SELECT fixed, unnest(range(1, length(fixed) + 1)) AS i, substr(fixed, 1, i - 1) || substr(fixed, i + 1) AS form FROM k),
pairs AS (SELECT word, fixed FROM da JOIN dk ON da.form = dk.form AND da.i = dk.i WHERE word <> fixed UNION SELECT word, fixed FROM da JOIN k ON form = fixed UNION SELECT word, fixed FROM dk JOIN a ON form = word)
SELECT word, min(fixed) AS fixed FROM pairs GROUP BY word HAVING count(*) = 1"""


@query(FIXES)
def edit1_fix(spark, sf):
    v = vocab.vocabulary(table(spark, sf, "documents"), [])
    return vocab.one_edit_fixes(v.filter("n <= 1"), v.filter("n >= 5"))


@query(rf"""WITH {EDIT}, cuts AS (SELECT word, unnest(range(2, length(word) - 1)) AS cut FROM rare WHERE length(word) >= 6),
both_ AS (SELECT c.word, c.cut, l.word AS l, r.word AS r, least(l.n, r.n) AS s FROM cuts c JOIN known l ON l.word = substr(c.word, 1, c.cut) JOIN known r ON r.word = substr(c.word, c.cut + 1)),
best AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY s DESC, cut) AS i FROM both_) SELECT word, l AS "left", r AS "right" FROM best WHERE i = 1""")
def glued_word_splits(spark, sf):
    v = vocab.vocabulary(table(spark, sf, "documents"), [])
    return vocab.glued_words(v.filter("n <= 1").select("word"), v.filter("n >= 5"))


@query(r"SELECT page_id, length(html)::BIGINT AS n_chars, len(regexp_extract_all(html, '\S+'))::BIGINT AS n_words FROM pages")
def page_sizes(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.length("html").cast("long").alias("n_chars"), words(F.col("html")).alias("n_words"))


@query("SELECT source, lang, count(*) AS n_docs, sum(len(string_split(text, chr(10))))::BIGINT AS n_lines, sum(length(text))::BIGINT AS n_chars FROM documents GROUP BY ALL")
def book_index(spark, sf):
    return table(spark, sf, "documents").groupBy(*BOOK).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.size(lines(F.col("text")))).alias("n_lines"), F.sum(F.length("text")).alias("n_chars"))
