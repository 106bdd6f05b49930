"""Checks: word coverage, completeness, answers, flags.

Edge cases: a null text has no words, lines or pages; repeated rows are compared each by itself, and count as often as they stand where counts
are asked for; keys may be null (null meets null); an empty table gives no rows; ties go to the smaller number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import content_words, tokens
from folio.plans.runtime import checkpointed, fresh, same_keys

SHORT, SHORT_FROM = 0.55, 40
BRIEF, BRIEF_FROM = 0.4, 120


#: Words of both texts that are compared at a time; a longer row is compared by itself.
AT_A_TIME = 500_000


def _counted(source: pa.Array, output: pa.Array) -> list[np.ndarray]:
    """Multiset counts of two token lists in each row: words become numbers, and equal (row, word) numbers are counted side by side."""
    n = len(source)
    lists = (source, output)  # never null, as tokens() has it
    rows = [np.repeat(np.arange(n), np.diff(c.offsets.to_numpy())) for c in lists]
    codes = pa.concat_arrays([c.flatten() for c in lists]).dictionary_encode().indices.to_numpy().astype(np.int64)
    cut, width = len(rows[0]), int(codes.max(initial=0)) + 1
    keys, place = np.unique(np.concatenate(rows) * width + codes, return_inverse=True)
    s, o = (np.bincount(p, minlength=len(keys)) for p in (place[:cut], place[cut:]))
    both, owner = np.minimum(s, o), keys // width
    return [np.bincount(owner, c, n).astype(np.int64) for c in (s, both, s - both, o - both)]


def _compared(source: pa.Array, output: pa.Array) -> pa.Array:
    """_counted for some rows at a time, so that its arrays of numbers do not grow with the batch that Spark sends."""
    words_ = np.cumsum(np.diff(source.offsets.to_numpy()) + np.diff(output.offsets.to_numpy()))
    sums, start = [], 0
    while start < len(source):
        end = max(start + 1, int(np.searchsorted(words_, (words_[start - 1] if start else 0) + AT_A_TIME, "right")))
        sums.append(_counted(source.slice(start, end - start), output.slice(start, end - start)))
        start = end
    columns = [np.concatenate(c) for c in zip(*sums, strict=True)] if sums else [np.zeros(0, np.int64)] * 4
    return pa.StructArray.from_arrays([pa.array(c) for c in columns], ["total", "common", "missing", "extra"])


def covered(source: Column, output: Column, expected: Column | None = None) -> Column:
    """struct<total, common, missing, extra>: the two texts' words compared as multisets; words of expected leave both sides. The words of a text that did
    not change are counted only."""
    a, b, changed = tokens(source), tokens(output), ~source.eqNullSafe(output)
    if expected is not None:
        known = F.array_distinct(tokens(expected))
        a, b = (F.filter(c, lambda w: ~F.array_contains(known, w)) for c in (a, b))
    none = F.array().cast("array<string>")
    compared = F.arrow_udf("total long, common long, missing long, extra long")(_compared)(*[F.when(changed, c).otherwise(none) for c in (a, b)])
    n, zero = F.size(a).cast("long"), F.lit(0).cast("long")
    return F.when(changed, compared).otherwise(F.struct(n.alias("total"), n.alias("common"), zero.alias("missing"), zero.alias("extra")))


def coverage(df: DataFrame, key: list[str], source: str, output: str, expected: str | None = None) -> DataFrame:
    """Multiset word coverage of source by output, one row for each row that has words on either side: total, common, missing and extra words, and
    the rate (1 for an empty source).

    Both texts stand in one row, so nothing is shuffled. expected (a text, say the words of repairs made on purpose) names words that count
    neither as missing nor as extra.
    """
    counts = covered(F.col(source), F.col(output), F.col(expected) if expected else None)
    counted = df.select(*key, counts.alias("covered_words")).select(*key, "covered_words.*").filter("total + extra > 0")
    return counted.withColumn("coverage", F.when(F.col("total") == 0, 1.0).otherwise(F.col("common") / F.col("total")))


def set_coverage(df: DataFrame, key: list[str], source: str, output: str) -> DataFrame:
    """Coverage of distinct words, as for decks."""
    a, b = F.array_distinct(tokens(F.col(source))), F.array_distinct(tokens(F.col(output)))
    total, shared = F.size(a), F.size(F.array_intersect(a, b))
    return df.select(*key, total.cast("long").alias("total"), shared.cast("long").alias("common"), F.when(total == 0, 1.0).otherwise(shared / total).alias("coverage"))


def coverage_rollup(per_page: DataFrame, book: list[str]) -> DataFrame:
    """Totals by every level of the book's key and over all."""
    r = per_page.rollup(*book).agg(F.sum("total").alias("total"), F.sum("common").alias("common"), F.sum("missing").alias("missing"), F.sum("extra").alias("extra"), F.grouping_id().cast("int").alias("level"))
    return r.withColumn("coverage", F.when(F.col("total") == 0, 1.0).otherwise(F.col("common") / F.col("total")))


def turn_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, source_text, answer_text): a user's turn and the assistant's next."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    following = turns.withColumn("next_role", F.lead("role").over(w)).withColumn("next_turn", F.lead("turn").over(w)).withColumn("answer_text", F.lead("text").over(w))
    return following.filter("role = 'user' AND next_role = 'assistant' AND next_turn = turn + 1").select("conv_id", "turn", F.col("text").alias("source_text"), "answer_text")


def short_answers(pairs: DataFrame, key: list[str]) -> DataFrame:
    s, a = content_words(F.col("source_text")), content_words(F.col("answer_text"))
    return pairs.select(*key, s.cast("long").alias("source_words"), a.cast("long").alias("answer_words")).filter((F.col("source_words") >= SHORT_FROM) & (F.col("answer_words") < SHORT * F.col("source_words")))


def answer_pages(answers: DataFrame, key: list[str], text: str = "answer_text") -> DataFrame:
    """An answer's pages: blocks at "# " headings, the page named in a block's first 400 characters; blocks of one page are joined in order."""
    blocks = F.filter(F.split(F.concat(F.lit("\n"), F.col(text)), r"\n(?=# )"), lambda b: b.startswith("# "))
    rows = answers.select(*key, F.posexplode(blocks).alias("pos", "block"))
    page = F.regexp_extract(F.substring("block", 1, 400), r"page\s*([0-9]+)", 1)
    named = rows.filter(page != "").select(*key, page.cast("int").alias("page_no"), "pos", "block")
    return named.groupBy(*key, "page_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "block"))), lambda b: b["block"]), "\n").alias("block"))


def source_pages(chunks: DataFrame, key: list[str], text: str = "source_text") -> DataFrame:
    """A chunk's pages by their markers <!-- page N -->; text before the first marker is no page's."""
    rows = chunks.select(*key, F.explode(F.split(F.col(text), r"(?=<!-- page [0-9]+ -->)")).alias("block")).filter(F.col("block").startswith("<!-- page "))
    return rows.select(*key, F.regexp_extract("block", "^<!-- page ([0-9]+)", 1).cast("int").alias("page_no"), "block")


def missing_pages(source: DataFrame, answer: DataFrame, key: list[str]) -> DataFrame:
    return same_keys(source.select(*key, "page_no").distinct(), answer.select(*key, "page_no"), [*key, "page_no"], "left_anti")


def extra_pages(source: DataFrame, answer: DataFrame, key: list[str]) -> DataFrame:
    return missing_pages(answer, source, key)


def unmatched_pages(source: DataFrame, answer: DataFrame, key: list[str]) -> DataFrame:
    """(key, page_no, code): missing pages and pages too many (extra_page), from one sum by page instead of two joins."""
    marked = source.select(*key, "page_no", F.lit(True).alias("asked")).unionByName(answer.select(*key, "page_no", F.lit(False).alias("asked")))
    both = marked.groupBy(*key, "page_no").agg(F.bool_or("asked").alias("asked"), F.bool_and("asked").alias("lacking"))
    return both.filter("NOT asked OR lacking").select(*key, "page_no", F.when(F.col("asked"), "missing").otherwise("extra_page").alias("code"))


TEASER = r"(?i)\bin the next (?:section|part|page)\b[^.]*"
IMAGE = r"!\[[^\]]*\]\(([^)]+)\)"


def answer_issues(source: DataFrame, answer: DataFrame, key: list[str]) -> DataFrame:
    """(key, page_no, code) for every page: missing, no_translation, no_explanation, translation_short, explanation_short, no_emphasis,
    note_repeated, teaser, figure_missing, figure_in_translation, extra_page.

    source and answer(key, page_no, block); an answer has its translation under "## A" and its explanation under "## C". One full join.
    """
    s, a = source.select(*key, "page_no", F.col("block").alias("s")), answer.select(*key, "page_no", F.col("block").alias("a"))
    both = s.join(a, [*key, "page_no"], "full")
    part_a = F.regexp_extract("a", r"(?s)(?:^|\n)## A[^\n]*\n(.*?)(?=\n## C|\z)", 1)
    part_c = F.regexp_extract("a", r"(?s)(?:^|\n)## C[^\n]*\n(.*)", 1)
    both = both.withColumn("has_a", F.col("a").rlike(r"(?m)^## A")).withColumn("has_c", F.col("a").rlike(r"(?m)^## C")).withColumn("ta", part_a).withColumn("tc", part_c)
    both = both.withColumn("ns", content_words(F.col("s"))).withColumn("na", content_words(F.col("ta"))).withColumn("nc", content_words(F.col("tc")))
    here, reads = F.col("s").isNotNull() & F.col("a").isNotNull(), F.col("has_a") & (F.col("tc") != "")
    bold = F.filter(F.regexp_extract_all("tc", F.lit(r"\*\*(.+?)\*\*"), F.lit(1)), lambda b: ~b.rlike(r":\s*$"))
    names = F.transform(F.regexp_extract_all("s", F.lit(IMAGE), F.lit(1)), lambda p: F.regexp_extract(p, r"([^/]+)$", 1))
    lost = F.exists(names, lambda n: ~F.contains(F.col("a"), n))
    left_in_a = F.exists(names, lambda n: F.contains(F.col("ta"), n) & ~F.contains(F.col("tc"), n))
    rules = {
        "missing": F.col("a").isNull(), "extra_page": F.col("s").isNull(), "no_translation": here & ~F.col("has_a"), "no_explanation": here & ~F.col("has_c"),
        "translation_short": here & F.col("has_a") & (F.col("ns") >= SHORT_FROM) & (F.col("na") < SHORT * F.col("ns")), "explanation_short": here & reads & (F.col("na") >= BRIEF_FROM) & (F.col("nc") < BRIEF * F.col("na")),
        "no_emphasis": here & reads & (F.size(bold) == 0), "note_repeated": here & reads & (F.regexp_count("tc", F.lit(r"\*\*Note:\*\*")) > 1), "teaser": here & reads & F.col("tc").rlike(TEASER),
        "figure_missing": here & lost, "figure_in_translation": here & reads & left_in_a,
    }
    codes = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return both.select(*key, "page_no", F.explode(codes).alias("code"))


#: A word of more rows than these is frequent.
FREQUENT = 20_000


def ocr_accepted(words: DataFrame, vocabulary: DataFrame, page: list[str]) -> DataFrame:
    """Whether a page's OCR can be trusted: mean confidence 90, two words, and 90 % of its words of three letters known (if the vocabulary
    has 1,000 words). vocabulary(word) joins by word, whatever its size."""
    size = vocabulary.agg(F.count(F.lit(1)).alias("vocabulary_size"))
    word = F.lower(F.regexp_replace("text", r"[^\p{L}]", ""))
    known = vocabulary.select(F.col("word").alias("w"), F.lit(1).alias("known")).dropDuplicates(["w"])
    # a word that very many rows have is told to all tasks (there are few such words); the rows of the others are joined by word, none of which is large
    rows = words.select(*page, "conf", word.alias("w"))
    hot = checkpointed(rows.groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > FREQUENT).select("w").join(known, "w", "left").withColumn("hot", F.lit(1)))
    rows = rows.join(F.broadcast(hot), "w", "left")
    told, others = rows.filter("hot = 1").drop("hot"), rows.filter("hot IS NULL").drop("hot", "known")
    rows = told.unionByName(others.join(known, "w", "left"))
    long = F.length("w") >= 3
    sums = rows.groupBy(*page).agg(F.avg("conf").alias("confidence"), F.count(F.lit(1)).alias("n_words"), F.sum(F.when(long, 1).otherwise(0)).alias("long_words"), F.sum(F.when(long & F.col("known").isNotNull(), 1).otherwise(0)).alias("known_words"))
    good = (F.col("confidence") >= 90) & (F.col("n_words") >= 2) & ((F.col("vocabulary_size") < 1000) | (F.col("known_words") >= 0.9 * F.col("long_words")))
    return sums.crossJoin(F.broadcast(size)).select(*page, "confidence", "n_words", "known_words", good.alias("accepted"))  # one row on the right


def best_reading(readings: DataFrame, page: list[str]) -> DataFrame:
    """Of several OCR readings the one with more words of confidence 80, then the higher mean confidence, then the first."""
    sums = readings.groupBy(*page, "reading").agg(F.sum((F.col("conf") >= 80).cast("int")).alias("sure_words"), F.avg("conf").alias("confidence"))
    best = F.max_by(F.struct("reading", "sure_words", "confidence"), F.struct("sure_words", "confidence", (-F.col("reading")).alias("r")))
    return sums.groupBy(*page).agg(best.alias("b")).select(*page, "b.*")


def image_only(pages: DataFrame, book: list[str]) -> DataFrame:
    """Books of which 80 % of the pages have under 20 characters and an image."""
    bare = (F.coalesce(F.length("text"), F.lit(0)) < 20) & F.col("has_image")
    return pages.groupBy(*book).agg(F.avg(bare.cast("int")).alias("share")).withColumn("image_only", F.col("share") >= 0.8)


#: Flag: condition on a page's columns (text).
def page_flags(text: Column) -> Column:
    """Flags of a text, in order: empty, very_long, no_sentence, repeated_lines, many_signs, shouting."""
    lines_ = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x) != "")
    n = F.length(F.coalesce(text, F.lit("")))
    signs, caps, letters = F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s]")), F.regexp_count(text, F.lit("[A-Z]")), F.regexp_count(text, F.lit("[A-Za-z]"))
    rules = {"empty": n == 0, "very_long": n > 20_000, "no_sentence": (n > 0) & ~text.rlike(r"[.!?]"), "repeated_lines": F.size(F.array_distinct(lines_)) < F.size(lines_), "many_signs": signs > 0.1 * n, "shouting": (letters > 0) & (caps > 0.5 * letters)}
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))


INFORMATION = ["very_long"]


def flag_kinds(flags: Column) -> tuple[Column, Column]:
    """Warnings, and what is information only."""
    info = F.array(*[F.lit(x) for x in INFORMATION])
    return F.filter(flags, lambda f: ~F.array_contains(info, f)), F.filter(flags, lambda f: F.array_contains(info, f))


def needs_image(flags: Column, prefixes: list[str], every: bool = False) -> Column:
    """Whether a slide's picture is kept: in any case, or if a flag begins with one of the prefixes."""
    return F.lit(True) if every else F.exists(flags, lambda f: F.greatest(*[F.startswith(f, F.lit(p)) for p in prefixes]) if len(prefixes) > 1 else F.startswith(f, F.lit(prefixes[0])))


def first_image(candidates: DataFrame, slide: list[str]) -> DataFrame:
    """Of several renderings (rank, fill) of a slide the first that is not blank; a slide whose renderings are all blank has none."""
    return candidates.filter(F.col("fill") > 0.005).groupBy(*slide).agg(F.min("rank").alias("rank"))


def text_changes(pages: DataFrame, key: list[str], source: str, output: str, share: float = 0.03, words_: int = 3) -> DataFrame:
    """Pages that lost or gained more than a share of their words plus a few."""
    c = coverage(pages, key, source, output)
    most = F.col("total") * share + words_
    return c.filter((F.col("missing") > most) | (F.col("extra") > most))


def shared_tables(tables: DataFrame, book: list[str]) -> DataFrame:
    """Table texts that stand in more than one figure of a book."""
    return tables.groupBy(*book, "table_md").agg(F.count(F.lit(1)).alias("n"), F.min("no").alias("first")).filter("n > 1")


def words_outside(tables: DataFrame, figures: DataFrame, key: list[str], table: str = "table_md", text: str = "text") -> DataFrame:
    """(key, word, in_table, in_figure): the words that a table's text holds more often than the figure that it was taken from: a containment of words with
    their counts. A table whose figure is not among figures has all its words reported; null texts hold none. Words are summed by key before they meet."""
    def counted(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.select(*key, F.explode(tokens(F.col(column))).alias("word")).groupBy(*key, "word").agg(F.count(F.lit(1)).alias(name))

    both = same_keys(counted(tables, table, "in_table"), counted(figures, text, "in_figure"), [*key, "word"], "left").fillna(0, ["in_figure"])
    return both.filter(F.col("in_table") > F.col("in_figure")).select(*key, "word", "in_table", "in_figure")


def repair_words(log: DataFrame, key: list[str]) -> DataFrame:
    """(key, expected): the words that repairs made or took away on purpose, for `coverage(expected=...)`; log(key, left, right, joined)."""
    return log.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(" ", "left", "right", "joined"))), " ").alias("expected"))


def slide_coverage(slides: DataFrame, key: list[str], source: str, output: str, expected: str, deck_file: str, flags: str) -> DataFrame:
    """(key, total, missing, extra, rate, flag): words compared as the way of reading asks, less the expected ones.

    Where deck_file is false both texts come from one page: every word counts, and any difference is flagged. Where it is true they come from two
    sources (deck and rendered page), which may draw a text twice: only words that the other side lacks altogether count, and a rate below 0.95
    is flagged unless the slide has a chart.
    """
    known = tokens(F.col(expected))
    drop = lambda c: F.filter(c, lambda w: ~F.array_contains(known, w))
    a, b = F.array_distinct(tokens(F.col(source))), F.array_distinct(tokens(F.col(output)))
    lost, gained = drop(F.array_except(a, b)), drop(F.array_except(b, a))
    rows = slides.withColumn("expected_words", F.coalesce(F.col(expected), F.lit("")))
    exact = coverage(rows.select(*key, F.col(source).alias("s"), F.col(output).alias("o"), "expected_words"), key, "s", "o", "expected_words")
    # all words of the source are the rate's measure, also those that are expected to differ
    sets = slides.select(*key, F.col(deck_file).alias("deck_file"), F.size(tokens(F.col(source))).cast("long").alias("all_words"), F.size(a).cast("long").alias("set_words"), F.size(lost).cast("long").alias("lost"), F.size(gained).cast("long").alias("gained"), F.coalesce(F.exists(flags, lambda f: f.startswith("chart")), F.lit(False)).alias("chart"))
    both = same_keys(sets, exact.select(*key, F.col("missing").alias("m"), F.col("extra").alias("e")), key, "left").fillna(0, ["m", "e"])
    pick = lambda x, y: F.when(F.col("deck_file"), F.col(x)).otherwise(F.col(y))
    both = both.withColumn("total", pick("set_words", "all_words")).withColumn("missing", pick("lost", "m")).withColumn("extra", pick("gained", "e"))
    rate = F.when(F.col("total") > 0, 1 - F.col("missing") / F.col("total")).otherwise(1.0)
    flag = F.when(~F.col("deck_file") & (F.col("missing") + F.col("extra") > 0), "texts differ").when(F.col("deck_file") & (F.col("total") > 0) & (rate < 0.95) & ~F.col("chart"), "deck and page differ")
    return both.select(*key, "total", "missing", "extra", rate.alias("rate"), flag.alias("flag"))


def report(chunks: DataFrame, answers: DataFrame, issues: DataFrame, key: list[str]) -> DataFrame:
    """(key, n_issues, line): one line a chunk: no answer (which counts as one issue), its issues in order, or that all is well.

    chunks(key), answers(key), issues(key, page_no, code). n_issues summed over all lines is what a run exits with.
    """
    # chunks, answers and issues are summed by chunk at once, not joined one after the other
    said = F.struct("page_no", "code")
    issue, chunk, got = fresh(key, "issue", "in_chunks", "answered")
    rows = issues.select(*key, said.alias(issue), F.lit(False).alias(chunk), F.lit(False).alias(got))
    for df, asked in ((chunks, True), (answers, False)):
        rows = rows.unionByName(df.select(*key, F.lit(None).alias(issue), F.lit(asked).alias(chunk), F.lit(not asked).alias(got)))
    rows = rows.groupBy(*key).agg(F.array_sort(F.collect_list(issue)).alias("i"), F.bool_or(chunk).alias(chunk), F.bool_or(got).alias("answered")).filter(F.col(chunk))
    rows = rows.select(*key, F.when(F.size("i") > 0, F.col("i")).alias("i"), F.when(F.col("answered"), True).alias("answered"))
    listed = F.transform("i", lambda x: F.concat(F.lit("\n    - page "), x["page_no"].cast("string"), F.lit(": "), x["code"]))
    n = F.when(F.col("answered").isNull(), 1).otherwise(F.coalesce(F.size("i"), F.lit(0))).cast("long")
    name = F.concat_ws("-", *[F.col(k).cast("string") for k in key])
    line = F.when(F.col("answered").isNull(), F.concat(F.lit("- "), name, F.lit(": no answer"))).when(F.col("i").isNull(), F.concat(F.lit("- "), name, F.lit(": complete"))).otherwise(F.concat(F.lit("- "), name, F.lit(": "), F.size("i").cast("string"), F.lit(" issues"), F.array_join(listed, "")))
    return rows.select(*key, n.alias("n_issues"), line.alias("line"))


def merged_answers(answers: DataFrame, book: list[str], order: str, text: str = "answer_text") -> DataFrame:
    """(book, md): a book's answers in order as one text, with a page break between two and none twice. It is one text in the end."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(order, F.trim(text).alias("t")))), lambda a: a["t"])
    md = F.array_join(F.filter(parts, lambda t: t != ""), "\n\n---PAGE---\n\n")
    return answers.groupBy(*book).agg(F.regexp_replace(md, r"(?:\s*---PAGE---\s*){2,}", "\n\n---PAGE---\n\n").alias("md"))
