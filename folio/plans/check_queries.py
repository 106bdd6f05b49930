"""Registered queries of verification, flags, manifests and streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from folio.functions.text import folder_key, safe_name
from folio.operators import incremental, pack, verify
from folio.plans.derived import cte, frame
from folio.plans.fixtures import frame as authored
from folio.plans.runtime import kept, shared_dir, spread
from folio.plans.text_queries import BOOK, PACK, table
from folio.sources import package
from folio.streaming import chapters, ingest

Q: dict = {}
O: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            O[f.__name__] = sql
        return f

    return add


TURNS = "pair AS (SELECT u.conv_id, u.turn, u.text AS source_text, a.text AS answer_text FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant')"


@query(f"WITH {TURNS} SELECT * FROM pair")
def answer_pairs(spark, sf):
    return verify.turn_pairs(table(spark, sf, "conversations"))


@query(rf"WITH {TURNS}, n AS (SELECT conv_id, turn, len(regexp_extract_all(source_text, '[\p{{L}}\p{{N}}_]+'))::BIGINT AS source_words, len(regexp_extract_all(answer_text, '[\p{{L}}\p{{N}}_]+'))::BIGINT AS answer_words FROM pair) SELECT * FROM n WHERE source_words >= 40 AND answer_words < 0.55 * source_words")
def short_answers(spark, sf):
    return verify.short_answers(verify.turn_pairs(table(spark, sf, "conversations")), ["conv_id", "turn"])


@query(rf"""WITH {TURNS}, t AS (SELECT conv_id, turn, unnest(regexp_extract_all(lower(source_text), '[\p{{L}}\p{{N}}]+')) AS word, 1 AS s, 0 AS o FROM pair UNION ALL SELECT conv_id, turn, unnest(regexp_extract_all(lower(answer_text), '[\p{{L}}\p{{N}}]+')), 0, 1 FROM pair),
c AS (SELECT conv_id, turn, word, sum(s) AS s, sum(o) AS o FROM t GROUP BY ALL)
SELECT conv_id, turn, sum(s)::BIGINT AS total, sum(least(s, o))::BIGINT AS common, sum(s - least(s, o))::BIGINT AS missing, sum(o - least(s, o))::BIGINT AS extra, CASE WHEN sum(s) = 0 THEN 1.0 ELSE sum(least(s, o)) / sum(s) END::DOUBLE AS coverage FROM c GROUP BY ALL""")
def answer_coverage(spark, sf):
    return verify.coverage(verify.turn_pairs(table(spark, sf, "conversations")), ["conv_id", "turn"], "source_text", "answer_text")


@query(rf"""WITH {TURNS}, t AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(lower(source_text), '[\p{{L}}\p{{N}}]+')) AS a, list_distinct(regexp_extract_all(lower(answer_text), '[\p{{L}}\p{{N}}]+')) AS b FROM pair)
SELECT conv_id, turn, len(a)::BIGINT AS total, len(list_intersect(a, b))::BIGINT AS common, CASE WHEN len(a) = 0 THEN 1.0 ELSE len(list_intersect(a, b)) / len(a) END::DOUBLE AS coverage FROM t""")
def answer_set_coverage(spark, sf):
    return verify.set_coverage(verify.turn_pairs(table(spark, sf, "conversations")), ["conv_id", "turn"], "source_text", "answer_text")


def _answers(spark):
    rows = authored(spark, "fx_answer")
    return verify.source_pages(rows, ["chunk_no"]), verify.answer_pages(rows, ["chunk_no"])


@query("""SELECT * FROM (VALUES (1, 3, 'note_repeated'), (1, 3, 'figure_in_translation'), (1, 4, 'translation_short'), (1, 4, 'no_emphasis'), (1, 4, 'teaser'), (1, 5, 'missing'), (1, 9, 'extra_page'), (1, 6, 'no_translation'), (1, 6, 'no_explanation')) t(chunk_no, page_no, code)""")
def answer_checks(spark, sf):
    return verify.answer_issues(*_answers(spark), ["chunk_no"])


@query(f"""WITH {cte('dx_word')}, v AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS word FROM documents), n AS (SELECT count(*) AS size FROM v),
w AS (SELECT f.*, lower(regexp_replace(text, '[^\\p{{L}}]', '', 'g')) AS w FROM dx_word f)
SELECT page_idx, avg(conf) AS confidence, count(*) AS n_words, sum(CASE WHEN length(w) >= 3 AND word IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS known_words,
 (avg(conf) >= 90 AND count(*) >= 2 AND (any_value(size) < 1000 OR sum(CASE WHEN length(w) >= 3 AND word IS NOT NULL THEN 1 ELSE 0 END) >= 0.9 * sum(CASE WHEN length(w) >= 3 THEN 1 ELSE 0 END))) AS accepted
FROM w LEFT JOIN v ON w.w = v.word CROSS JOIN n GROUP BY page_idx""")
def ocr_accept(spark, sf):
    from folio.operators.vocab import vocabulary

    return verify.ocr_accepted(frame(spark, sf, "dx_word"), vocabulary(table(spark, sf, "documents"), []).select("word"), ["page_idx"])


@query(f"WITH {cte('dx_scan')} SELECT doc_id, avg((coalesce(length(text), 0) < 20 AND has_image)::INTEGER) AS share, avg((coalesce(length(text), 0) < 20 AND has_image)::INTEGER) >= 0.8 AS image_only FROM dx_scan GROUP BY 1")
def image_books(spark, sf):
    return verify.image_only(frame(spark, sf, "dx_scan"), ["doc_id"])


FLAGS = r"""f AS (SELECT doc_id, source, text, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS l, length(text) AS n, length(text) - length(regexp_replace(text, '[^\p{L}\p{N}\s]', '', 'g')) AS signs, length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS caps, length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g')) AS letters FROM documents),
flagged AS (SELECT doc_id, source, list_filter([CASE WHEN n = 0 THEN 'empty' END, CASE WHEN n > 20000 THEN 'very_long' END, CASE WHEN n > 0 AND NOT regexp_matches(text, '[.!?]') THEN 'no_sentence' END, CASE WHEN len(list_distinct(l)) < len(l) THEN 'repeated_lines' END,
 CASE WHEN signs > 0.1 * n THEN 'many_signs' END, CASE WHEN letters > 0 AND caps > 0.5 * letters THEN 'shouting' END], lambda x: x IS NOT NULL) AS flags FROM f)"""


@query(rf"WITH {FLAGS} SELECT doc_id, array_to_string(list_filter(flags, lambda x: x <> 'very_long'), ',') AS warnings, array_to_string(list_filter(flags, lambda x: x = 'very_long'), ',') AS notes FROM flagged")
def quality_flags(spark, sf):
    warnings, notes = verify.flag_kinds(verify.page_flags(F.col("text")))
    return table(spark, sf, "documents").select("doc_id", F.array_join(warnings, ",").alias("warnings"), F.array_join(notes, ",").alias("notes"))


@query(rf"WITH {FLAGS}, u AS (SELECT source, unnest(flags) AS flag FROM flagged) SELECT source, flag, count(*) AS n FROM u GROUP BY ALL")
def quality_report(spark, sf):
    rows = spread(table(spark, sf, "documents").select("source", "text")).select("source", F.explode(verify.page_flags(F.col("text"))).alias("flag"))
    return rows.groupBy("source", "flag").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT sha1(text) AS sha1, min(doc_id) AS first, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_files(spark, sf):
    return incremental.duplicate_files(incremental.content_hashes(table(spark, sf, "documents"), ["doc_id"], "text"), "doc_id")


@query("SELECT page_id, sha1(html) AS sha1, md5(html) AS md5 FROM pages")
def content_hashes(spark, sf):
    return incremental.content_hashes(table(spark, sf, "pages"), ["page_id"], "html")


@query(f"WITH {cte('dx_source', 'dx_manifest')} SELECT path, CASE WHEN m.path IS NULL THEN 'added' WHEN f.path IS NULL THEN 'removed' WHEN f.sha1 <> m.sha1 THEN 'changed' ELSE 'unchanged' END AS change FROM dx_source f FULL JOIN dx_manifest m USING (path)")
def changed_manifest(spark, sf):
    return incremental.changes(frame(spark, sf, "dx_source"), frame(spark, sf, "dx_manifest"))


@query(f"WITH {cte('dx_source', 'dx_manifest')} SELECT path, sha1, modified FROM dx_source f WHERE NOT EXISTS (SELECT 1 FROM dx_manifest m WHERE m.path = f.path AND m.sha1 = f.sha1 AND m.version = '2')")
def files_to_process(spark, sf):
    return incremental.to_process(frame(spark, sf, "dx_source"), frame(spark, sf, "dx_manifest"), "2").select("path", "sha1", "modified")


@query(f"WITH {cte('dx_source', 'dx_output')} SELECT i.path FROM (SELECT path, max(modified) AS m FROM dx_source GROUP BY 1) i LEFT JOIN (SELECT path, max(modified) AS m FROM dx_output GROUP BY 1) o USING (path) WHERE o.m IS NULL OR i.m > o.m")
def stale_outputs(spark, sf):
    return incremental.stale(frame(spark, sf, "dx_output"), frame(spark, sf, "dx_source"), ["path"])


@query(r"SELECT page_id, substr(regexp_replace(regexp_replace(url, '[\\/:*?" + '"' + r"<>|]', '', 'g'), '\s+', '_', 'g'), 1, 80) AS name, regexp_replace(lower(url), '[^a-z0-9]', '', 'g') AS key FROM pages")
def safe_names(spark, sf):
    return table(spark, sf, "pages").select("page_id", safe_name(F.col("url"), F.col("page_id").cast("string")).alias("name"), folder_key(F.col("url")).alias("key"))


@query("SELECT doc_id, source, length(text)::BIGINT AS n_chars, sha1(text) AS sha1 FROM documents")
def incremental_ingest(spark, sf):
    """A second run over the same folder adds nothing."""
    return ingest.ingest_twice(spark, f"{sf}/documents.parquet")


@query("SELECT user_id, count(*) AS n, max(ts) AS last_ts FROM events GROUP BY 1")
def event_totals_stream(spark, sf):
    return ingest.stream_totals(spark, f"{sf}/events.parquet")


@query("""SELECT conv_id::VARCHAR AS chapter, 'complete' AS state, count(*)::INTEGER AS n_pages, string_agg(coalesce(text, ''), chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id""")
def chapters_streamed(spark, sf):
    """Conversations as chapters whose turns are pages, given out by a stream when they are complete."""
    turns = table(spark, sf, "conversations")
    wanted = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("wanted"))
    base = f"{shared_dir(spark)}/chapters-{uuid.uuid4().hex}"
    stream = ingest.reading(spark, f"{sf}/conversations.parquet").join(wanted, "conv_id")
    chapters.run(chapters.complete_chapters(stream, "conv_id", "turn", "wanted", "text"), f"{base}/out", f"{base}/state")
    return spark.read.schema(chapters.OUT).parquet(f"{base}/out")


@query(f"""WITH RECURSIVE {PACK.format(text='text', docs='documents')}, made AS (SELECT p.source, p.lang, chunk_no, 'Pages ' || min(p.doc_id) || '-' || max(p.doc_id) || chr(10) || chr(10) || string_agg(text, chr(10) || chr(10) ORDER BY p.doc_id) AS prompt
FROM packed p JOIN documents d USING (doc_id) GROUP BY p.source, p.lang, chunk_no) SELECT lang || '/' || source || '/' || chunk_no || '.md' AS path, sha1(prompt) AS sha1 FROM made""")
def package_files(spark, sf):
    """The documents' chunks as a package of files, written twice: the second run leaves the first one's version."""
    prompts = pack.prompts(table(spark, sf, "documents"), BOOK, "doc_id", "Pages %s\n\n%s")
    rows = prompts.select(F.concat_ws("/", "lang", "source", F.concat(F.col("chunk_no").cast("string"), F.lit(".md"))).alias("path"), F.col("prompt").alias("content"))
    rows = kept(rows, "files")  # put together once; each run reads them twice
    root = f"{shared_dir(spark)}/package-{uuid.uuid4().hex}"
    root = root if ":" in root else f"file://{root}"
    for _ in range(2):
        package.write_package(rows, root)
    return package.read_package(spark, root).select("path", F.sha1("content").alias("sha1"))
