"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm import codebook, decontam, divergence, html_text, langid, mixing, neardup, ngramjoin, pii, quality, sharding, tokencount, topk
from folio.llm.common import read


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = langid.train(docs.filter(F.col("doc_id").isNotNull() & ~held_out))
    return langid.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text").select("doc_id", "held_out", "lang_pred", "score")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    shards = sharding.shuffle(read(spark, sf_dir, "documents"), 16)
    return shards.select("doc_id", size.alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.grade(docs, quality.train(docs, read(spark, sf_dir, "labels"))).select("doc_id", "expected_grade", "tail_prob", "selected")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), shingle=2, percent=80)


OP5 = r"""
WITH RECURSIVE tok AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM tok),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS p, b.doc_id AS q FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
edges AS (SELECT p, q FROM shared UNION ALL SELECT q, p FROM shared),
reach(id, to_id) AS (SELECT p, q FROM edges UNION SELECT r.id, e.q FROM reach r JOIN edges e ON r.to_id = e.p),
low AS (SELECT id, least(id, min(to_id)) AS component FROM reach GROUP BY id)
SELECT s.doc_id, coalesce(len(s.s), 0)::BIGINT AS n_shingles, coalesce(l.component, s.doc_id) AS component_id, coalesce(l.component, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN low l ON s.doc_id = l.id"""


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP6 = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1] AS w
  FROM sized GROUP BY source),
fill AS (
  SELECT s.source, s.source_size, s.w, sum(source_size) OVER ()::BIGINT AS rest, sum(w) OVER ()::BIGINT AS total, NULL::DOUBLE AS target, 0 AS step, count(*) OVER () AS n
  FROM src s
  UNION ALL
  SELECT source, source_size, w,
         (rest - coalesce(sum(CASE WHEN above THEN 3 * source_size END) OVER (), 0))::BIGINT,
         (total - coalesce(sum(CASE WHEN above THEN w END) OVER (), 0))::BIGINT,
         CASE WHEN above THEN (3 * source_size)::DOUBLE ELSE target END, step + 1, n
  FROM (SELECT *, target IS NULL AND rest * w > 3 * source_size * total AS above FROM fill)
  WHERE step <= n AND step < 40),
plan AS (
  SELECT source, source_size, coalesce(target, rest * w::DOUBLE / total) AS target FROM fill
  WHERE step = (SELECT max(step) FROM fill)),
parts AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(3, floor(target)::BIGINT // source_size) END AS whole FROM plan),
ranked AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole, floor(p.target)::BIGINT - p.whole * p.source_size AS more,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('17:' || coalesce(d.doc_id::VARCHAR, '')), d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (whole * size + CASE WHEN source_size = 0 THEN 0 ELSE greatest(0, least(size, more - before)) END)::BIGINT AS taken
FROM ranked"""


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.visible_text(read(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "text")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP9 = """
WITH whole AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, x.vec_id, max(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i])))::BIGINT AS score
  FROM whole q JOIN whole x ON q.vec_id <> x.vec_id AND len(q.v) = len(x.v) WHERE q.vec_id % 50 = 0 GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and what is left to count after masking the personal data that the patterns find in it."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    counted = docs.select("doc_id", tokencount.edited(F.col("text"), tokencount.trees(F.col("text")), pii.masks(F.col("text")), with_text=False).alias("c"))
    return counted.select("doc_id", "c.n_tokens", "c.n_pretokens", "c.n_edits", "c.n_tokens_after", "c.n_reencoded")


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.similar_sets(read(spark, sf_dir, "documents").select("doc_id", "text"), shingle=3, percent=90)


OP11 = r"""
WITH RECURSIVE tok AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM tok),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
shared AS (
  SELECT a.doc_id AS p, b.doc_id AS q FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
edges AS (SELECT p, q FROM shared UNION ALL SELECT q, p FROM shared),
reach(id, to_id) AS (SELECT p, q FROM edges UNION SELECT r.id, e.q FROM reach r JOIN edges e ON r.to_id = e.p),
low AS (SELECT id, least(id, min(to_id)) AS component FROM reach GROUP BY id)
SELECT s.doc_id, coalesce(len(s.s), 0)::BIGINT AS n_shingles, coalesce(l.component, s.doc_id) AS component_id
FROM sets s LEFT JOIN low l ON s.doc_id = l.id"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codebook.compress(read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def _op12() -> str:
    """The rounds one after the other: c<r> are the codebooks before round r, a<r> each part's nearest entry in them."""
    far = "list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i])))::BIGINT"
    steps = [
        """whole AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0)""",
        "parts AS (SELECT vec_id, label, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS x FROM whole, range(8) r(p))",
        "c0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts QUALIFY e < 16)",
    ]
    for r in range(7):
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, label, p, x, arg_min(e, d * 16 + e) AS e, min(d) AS d FROM (SELECT t.*, c.e, {far} AS d FROM parts t JOIN c{r} c USING (p)) GROUP BY vec_id, label, p, x)")
        if r < 6:
            steps.append(f"""s{r} AS (
  SELECT p, e, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY p, e, i),
m{r} AS (SELECT p, e, list((s - (s % n + n) % n) // n ORDER BY i) AS c FROM s{r} GROUP BY p, e),
c{r + 1} AS MATERIALIZED (SELECT o.p, o.e, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN m{r} m ON o.p = m.p AND o.e = m.e)""")
    return "WITH " + ",\n".join(steps) + """,
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c6),
coded AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a6 GROUP BY vec_id, label)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded, book"""


OP12 = _op12()

def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents").select("text", "lang", "source"))


OP13 = r"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
occ AS (
  SELECT d, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
groups AS (SELECT DISTINCT lang, source FROM docs),
found AS (SELECT lang, source, term, count(*) AS n FROM occ SEMI JOIN kept USING (lang, term) GROUP BY ALL),
size AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
own AS (SELECT g.lang, g.source, coalesce(sum(f.n), 0)::HUGEINT AS n FROM groups g LEFT JOIN found f USING (lang, source) GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS c, 1 + (1000000000 * (coalesce(f.n, 0) + 2)::HUGEINT) // (g.n + 2 * s.v) AS p,
         1 + (1000000000 * (k.n + 2)::HUGEINT) // (s.n + 2 * s.v) AS q
  FROM own g JOIN kept k USING (lang) JOIN size s USING (lang) LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE c > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank FROM rows
QUALIFY part = 'pair' OR rank <= 10"""


QUERIES = {"op1_language_id": op1_language_id, "op2_sharding": op2_sharding, "op3_pii": op3_pii, "op4_quality": op4_quality, "op5_near_dedup": op5_near_dedup, "op6_mixing": op6_mixing, "op7_decontamination": op7_decontamination, "op8_html_text": op8_html_text, "op9_topk": op9_topk, "op10_token_counts": op10_token_counts, "op11_ngram_join": op11_ngram_join, "op12_vector_codes": op12_vector_codes, "op13_source_divergence": op13_source_divergence}
ORACLES = {"op5_near_dedup": OP5, "op6_mixing": OP6, "op9_topk": OP9, "op11_ngram_join": OP11, "op12_vector_codes": OP12, "op13_source_divergence": OP13}
