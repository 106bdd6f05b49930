"""Packing: chunks of whole pages under a word budget, outlines, glossary terms, prompts.

Greedy filling is sequential within a book, but a run of pages acts on what comes before it only through how full the open chunk is. So pages
of books of more than RANGE pages are sorted into ranges of about so many; each range is reduced to a small table (fullness on entry: chunks
begun, fullness at the end); a book's tables are composed in order, and then every range numbers its pages by itself. Smaller books are numbered
whole. Texts never take part, and no task holds more than some ranges' numbers.

Edge cases: a null or wordless text is a page of 0 words; pages that share a place are ordered by their words, null places come first; null keys
are a book of their own; repeated rows are pages of their own; a page over the budget is a chunk; an empty table gives no rows. Glossaries may
be of any size, null and empty spellings count for nothing, and null texts hold no term.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import read_words, squeeze, strip
from folio.plans.runtime import fresh, kept, same_keys, sent_if_small

BUDGET = 1800
#: Pages of a range; a book of more is packed range by range.
RANGE = 100_000


def _reduce(sizes: np.ndarray, budget: int) -> tuple[list[int], list[int], list[int]]:
    """How a range answers to the open chunk's fullness: from each of `fullness` on (ascending), how many chunks it begins, and how full the last
    is at its end. Below the first of them the range goes into the open chunk whole."""
    n, sums = len(sizes), np.concatenate([[0], np.cumsum(sizes)])
    # begun[i], ends[i]: chunks and fullness at the end if a chunk begins at page i
    begun, ends = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    after = np.maximum(np.arange(n) + 1, np.searchsorted(sums, sums[:n] + budget, "right") - 1)
    for i in range(n - 1, -1, -1):
        j = int(after[i])
        begun[i], ends[i] = 1 + begun[j], ends[j] if j < n else sums[n] - sums[i]
    fullness, seen = [], None
    where: list[int] = []
    for i in range(n):
        least = budget + 1 - int(sums[i + 1])  # from this fullness on, page i does not fit
        if seen is None or least < seen:
            fullness.append(max(0, least))
            where.append(i)
            seen = least
        if least <= 0:
            break
    order = np.argsort(fullness, kind="stable")
    return [fullness[k] for k in order], [int(begun[where[k]]) for k in order], [int(min(budget + 1, ends[where[k]])) for k in order]


def chunk_numbers(pages: DataFrame, book: list[str], order: str, text: str = "text", budget: int = BUDGET, carry: list[str] | None = None, counted: str | None = None) -> DataFrame:
    """(book, order, carry, n_words, chunk_no): pages in order fill a chunk until the next one would exceed the budget; a larger page is a chunk.

    Words are those that are read: links to pictures and comments (page markers among them) do not count. `carry` names small columns that
    come along, `counted` a column that has the words' number already; the text is not read then.
    """
    carry = carry or []
    n_words = F.col(f"`{counted}`") if counted else read_words(F.col(text))
    sized = pages.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*book, order, *carry])], n_words.alias("n_words"))
    keys = [F.col(f"`{k}`") for k in book]
    part, first, last = fresh(sized, "range_no", "entry", "before")
    large = pages.groupBy(*keys).agg(F.count(F.lit(1)).alias(part)).filter(F.col(part) > RANGE)  # reads the keys only
    rows_of_large = large.agg(F.sum(part)).first()[0]
    place = lambda t: t.take(pc.sort_indices(t, sort_keys=[(order, "ascending"), ("n_words", "ascending")], null_placement="at_start"))
    schema, sized_names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sized.schema), sized.columns

    def number(rows: pa.Table) -> pa.Table:
        rows = place(rows)
        sums = np.concatenate([[0], np.cumsum(rows["n_words"].to_numpy())])
        full, chunk = (rows[first][0].as_py(), rows[last][0].as_py()) if first in rows.column_names else (budget + 1, 0)
        out = np.empty(rows.num_rows, np.int64)
        at = max(0, int(np.searchsorted(sums, budget - full, "right")) - 1) if full <= budget else 0  # pages that still fit
        out[:at] = chunk
        while at < rows.num_rows:
            stop = max(at + 1, int(np.searchsorted(sums, sums[at] + budget, "right")) - 1)
            chunk += 1
            out[at:stop] = chunk
            at = stop
        return rows.select(sized_names).append_column("chunk_no", pa.array(out.astype(np.int32)))

    if not rows_of_large:
        return sized.groupBy(*keys).applyInArrow(number, f"{schema}, chunk_no int")
    large = sent_if_small(kept(large.drop(part), "large"))
    sized = kept(sized, "sizes")  # small and large books read them, and ranges are drawn from a sample; none must read the texts again
    small = same_keys(sized, large, book, "left_anti").groupBy(*keys).applyInArrow(number, f"{schema}, chunk_no int")
    sized = same_keys(sized, large, book, "left_semi")
    ranged = sized.repartitionByRange(-(-rows_of_large // RANGE), *[k.asc_nulls_first() for k in keys], F.col(order).asc_nulls_first(), F.col("n_words").asc()).withColumn(part, F.spark_partition_id())
    ranged = kept(ranged, "ranges")
    by_range = [*keys, F.col(part)]

    names = fresh(sized, "fullness", "begun", "ends", "total")
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sized.select(*book).schema)

    def table(rows: pa.Table) -> pa.Table:
        rows = place(rows)
        sizes = rows["n_words"].to_numpy()
        lists = [pa.array([x], pa.list_(pa.int64())) for x in _reduce(sizes, budget)]
        one = rows.slice(0, 1).select([*book, part])
        for name, column in zip(names, [*lists, pa.array([int(sizes.sum())], pa.int64())], strict=True):
            one = one.append_column(name, column)
        return one

    head = f"{key_schema}, " if book else ""
    tables = ranged.groupBy(*by_range).applyInArrow(table, f"{head}`{part}` int, `{names[0]}` array<long>, `{names[1]}` array<long>, `{names[2]}` array<long>, `{names[3]}` long")

    def compose(rows: pa.Table) -> pa.Table:
        """A book's ranges in order: how full the open chunk is where each begins, and how many chunks there are."""
        rows = rows.sort_by(part)
        full, chunks, entry, before = budget + 1, 0, [], []
        for at, begun, ends, total in zip(*[rows[n].to_pylist() for n in names], strict=True):
            entry.append(full)
            before.append(chunks)
            i = int(np.searchsorted(at, full, "right")) - 1
            full, chunks = (ends[i], chunks + begun[i]) if i >= 0 else (full + total, chunks)
        return rows.select([*book, part]).append_column(first, pa.array(entry, pa.int64())).append_column(last, pa.array(before, pa.int64()))

    entries = tables.groupBy(*keys).applyInArrow(compose, f"{head}`{part}` int, `{first}` long, `{last}` long")
    entries = kept(entries, "entries")
    entered = same_keys(ranged, sent_if_small(entries), [*book, part])
    return small.unionByName(entered.groupBy(*by_range).applyInArrow(number, f"{schema}, chunk_no int"))


def chunks(pages: DataFrame, book: list[str], order: str, text: str = "text", budget: int = BUDGET) -> DataFrame:
    """One row per chunk: its number, first and last page, pages and words."""
    numbered = chunk_numbers(pages, book, order, text, budget)
    return numbered.groupBy(*book, "chunk_no").agg(F.min(order).alias("first_page"), F.max(order).alias("last_page"), F.count(F.lit(1)).alias("n_pages"), F.sum("n_words").alias("n_words"))


#: A page's marker: file page, and printed page where it is known.
MARKER = r"<!-- page ([0-9]+)(?: · printed ([0-9]+))? -->"


def marked_pages(chapters: DataFrame, chapter: list[str], md: str = "md") -> DataFrame:
    """(chapter, pos, page_no, printed_no, label, text): a chapter's text cut before each page marker; what stands before the first is no page's."""
    rows = chapters.select(*chapter, F.posexplode(F.split(F.col(md), rf"(?={MARKER})")).alias("pos", "text")).filter(F.col("text").rlike(f"^{MARKER}"))
    number = lambda i: F.nullif(F.regexp_extract("text", f"^{MARKER}", i), F.lit("")).cast("int")
    return rows.select(*chapter, "pos", number(1).alias("page_no"), number(2).alias("printed_no"), F.regexp_extract("text", "^<!-- (page [^>]*?) -->", 1).alias("label"), "text")


#: Headings that are no part of an outline.
NOT_OUTLINE = "objectives|contents|key points|further reading|exercises"


def html_headings(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Headings of web pages in order: level, title without tags."""
    found = F.regexp_extract_all(F.col(html), F.lit(r"(?is)(<h[1-6][^>]*>.*?</h[1-6]>)"), F.lit(1))
    rows = pages.select(key, F.posexplode(found).alias("pos", "h"))
    return rows.select(key, "pos", F.regexp_extract("h", r"(?i)^<h([1-6])", 1).cast("int").alias("level"), squeeze(F.regexp_replace("h", r"(?s)<[^>]*>", "")).alias("title"))


def outline(headings: DataFrame, title: str = "title") -> DataFrame:
    return headings.filter(~F.col(title).rlike(f"(?i){NOT_OUTLINE}") & (F.col(title) != ""))


def outline_titles(md: Column) -> Column:
    """The titles of a markdown text's headings of the second to fourth level, in order."""
    found = F.transform(F.regexp_extract_all(md, F.lit(r"(?m)^(#{2,4} .+)$"), F.lit(1)), lambda h: squeeze(F.regexp_replace(h, "[#*]", "")))
    return F.filter(found, lambda t: ~t.rlike(f"(?i){NOT_OUTLINE}") & (t != ""))


def markdown_outline(chapters: DataFrame, key: list[str], text: str = "md") -> DataFrame:
    """Headings of the second to fourth level of markdown, in order."""
    return chapters.select(*key, F.posexplode(outline_titles(F.col(text))).alias("pos", "title"))


#: Spellings that one scan looks for; a larger glossary is dealt into several.
TERMS_AT_ONCE = 100_000
_SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _spellings(form: str) -> set[str]:
    """A variant in small letters, with s or z in -isation and -ed or -ered in centred."""
    out = [form.translate(_SMALL)]
    for one, two in (("isation", "ization"), ("centred", "centered")):
        cut = [f.split(one) for f in out]
        out = [s for parts in cut for s in _joined(parts, (one, two))]
    return set(out)


def _joined(parts: list[str], by: tuple[str, str]) -> list[str]:
    out = [parts[0]]
    for p in parts[1:]:
        out = [f"{o}{b}{p}" for o in out for b in by]
    return out


def _found(text: Column, forms: list[tuple[int, str]], spellings, inside) -> Column:
    """array<int>: which of the numbered forms stand in the text, not behind a sign that is `inside` a word. One scan, linear in the text."""
    wanted: dict[str, list[int]] = {}
    for i, form in forms:
        for s in spellings(form):
            wanted.setdefault(s, []).append(i)
    words = list(wanted.items())
    machines: list = []

    @F.arrow_udf("array<int>")
    def scan(texts: pa.Array) -> pa.Array:
        if not machines:  # built once in a worker
            machine = ahocorasick.Automaton()
            for n, (word, _) in enumerate(words):
                machine.add_word(word, (n, len(word)))
            machine.make_automaton()
            machines.append(machine)
        out = []
        for t in texts:
            t = t.as_py()
            hits = set()
            if t:
                t = t.translate(_SMALL)
                for end, (n, size) in machines[0].iter(t):
                    start = end - size + 1
                    if n not in hits and not (start and inside(t[start - 1])):
                        hits.add(n)
                        if len(hits) == len(words):
                            break
            out.append(sorted({i for n in hits for i in words[n][1]}))
        return pa.array(out, pa.list_(pa.int32()))

    return scan(text)


def _uses(texts: DataFrame, forms: DataFrame, key: list[str], text: str, spellings, inside) -> DataFrame:
    """forms(form, ...) that stand in texts: (key, columns of forms). The glossary comes to the driver in blocks of TERMS_AT_ONCE spellings."""
    forms = kept(forms.filter("form <> ''"), "forms")
    blocks = max(1, -(-forms.count() // TERMS_AT_ONCE))
    block = lambda b: forms.filter(F.pmod(F.xxhash64("form"), F.lit(blocks)) == b)
    every = None
    for b in range(blocks):
        distinct = sorted(r[0] for r in block(b).select("form").distinct().collect())
        if not distinct:
            continue
        found = texts.select(*key, F.explode(_found(F.col(text), list(enumerate(distinct)), spellings, inside)).alias("i"))
        numbers = texts.sparkSession.createDataFrame(list(enumerate(distinct)), "i int, form string")
        hits = found.join(F.broadcast(numbers), "i").drop("i")
        every = hits if every is None else every.unionByName(hits)
    if every is None:
        every = texts.select(*key, F.lit("").alias("form")).limit(0)
    return every.join(sent_if_small(forms), "form")


def glossary_hits(texts: DataFrame, terms: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, term_id, variant): terms of which a variant begins a word of the text, with the first such variant; terms(term_id, source array).

    Small and capital letters a-z, s or z in -isation, and -ed or -ered in centred are one. Texts are scanned once by an automaton of all
    spellings, so the size of the glossary does not count.
    """
    variants = terms.select("term_id", F.posexplode("source").alias("v", "form"))
    hits = _uses(texts, variants, [key], text, _spellings, lambda c: "a" <= c <= "z")
    return hits.groupBy(key, "term_id").agg(F.min_by("form", "v").alias("variant"))


def forbidden_uses(texts: DataFrame, terms: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """(key, term_id, form): forbidden forms that begin a word of the text; terms(term_id, forbidden array). Scanned as glossary_hits does."""
    forms = terms.select("term_id", F.explode("forbidden").alias("form")).distinct()
    return _uses(texts, forms, key, text, lambda f: {f.translate(_SMALL)}, lambda c: c.isalnum() or c == "_").select(*key, "term_id", "form")


def term_lines(hits: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """(key, terms): a text's terms as lines "- source -> target", in order of their numbers; terms(term_id, source, target)."""
    line = F.concat(F.lit("- "), F.array_join("source", " / "), F.lit(" -> "), F.coalesce("target", F.lit("")))
    rows = hits.select(key, "term_id").join(sent_if_small(terms.select("term_id", line.alias("line"))), "term_id")
    return rows.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("term_id", "line"))), lambda t: t["line"]), "\n").alias("terms"))


def filled_chunks(pages: DataFrame, book: list[str], order: str, text: str = "text", budget: int = BUDGET) -> DataFrame:
    """(book, chunk_no, n_chunks, first_page, last_page, pages): each chunk with its pages in order, array<struct<order, words, text>>.

    Only a chunk's own pages come together, which the budget bounds but for a single larger page. Pages find their chunk by place and text (its
    digest), so pages that share a place, and repeated ones, keep their own. Texts are read twice: to count their words, and to be put together; what
    lies between are the pages' numbers, written to the shared folder.
    """
    place, sign, times, words_, side = fresh(pages, "page_place", "page_sign", "page_times", "page_words", "page_side")
    text_ = F.col(f"`{text}`")
    rows = pages.select(*[F.col(f"`{b}`") for b in book], F.col(f"`{order}`").alias(place), text_.alias(text)).withColumn(sign, F.md5(text_))
    sizes = kept(rows.select(*[F.col(f"`{b}`") for b in book], place, sign, read_words(text_).alias(words_)), "sizes")
    numbered = kept(chunk_numbers(sizes, book, place, budget=budget, carry=[sign], counted=words_).withColumnRenamed("n_words", words_), "numbers")
    # equal pages at one place may be dealt to several chunks: the k-th of them goes where the k-th number says. Both lie by page, and meet there
    same = [*book, place, sign]
    keys = [F.col(f"`{k}`") for k in same]
    of_text = rows.select(*keys, text_, F.lit(None).cast("long").alias(words_), F.lit(None).cast("int").alias("chunk_no"), F.lit(True).alias(side))
    of_number = numbered.select(*keys, F.lit(None).cast("string").alias(text), F.col(words_), F.col("chunk_no"), F.lit(False).alias(side))
    both = of_text.unionByName(of_number).repartition(*keys)
    both = both.withColumn(times, F.row_number().over(Window.partitionBy(*keys, side).orderBy("chunk_no")))
    met = both.groupBy(*keys, times).agg(*[F.max(c).alias(c) for c in (text, words_, "chunk_no")])  # one of each
    told = F.array_sort(F.collect_list(F.struct(F.col(place).alias("place"), F.col(words_).alias("words"), F.col(text).alias("text"))))
    made = met.groupBy(*book, "chunk_no").agg(F.min(place).alias("first_page"), F.max(place).alias("last_page"), told.alias("pages"))
    counts = numbered.groupBy(*book).agg(F.max("chunk_no").alias("n_chunks"))
    return same_keys(made, sent_if_small(counts), book).select(*book, "chunk_no", "n_chunks", "first_page", "last_page", "pages")


def prompts(pages: DataFrame, book: list[str], order: str, template: str, text: str = "text", budget: int = BUDGET) -> DataFrame:
    """One prompt per chunk from a template with two places (%s): the page range and the pages' text in order."""
    made = filled_chunks(pages, book, order, text, budget)
    span = F.concat_ws("-", F.col("first_page").cast("string"), F.col("last_page").cast("string"))
    return made.select(*book, "chunk_no", "n_chunks", F.format_string(template, span, F.array_join(F.transform("pages", lambda p: p["text"]), "\n\n")).alias("prompt"))


#: The places of a prompt's template.
PLACES = ("range", "no", "count", "images", "outline", "terms", "note", "text")


def _fill(template: str, values: dict[str, Column]) -> Column:
    parts = re.split(r"\{(" + "|".join(PLACES) + r")\}", template)
    return F.concat(*[values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts)])


def study_prompts(chapters: DataFrame, key: str, template: str, terms: DataFrame, first_note: str = "", last_note: str = "", images_note: str = "Pictures of these pages: ", md: str = "md", budget: int = BUDGET) -> DataFrame:
    """(key, chunk_no, n_chunks, first_page, last_page, n_images, prompt): each chapter's pages (by its markers) packed into chunks, and for each
    chunk the template with its places filled: range, no, count, images, outline, terms, note, text.

    A chunk's own pages come together, which the budget bounds but for a single larger page; outline and terms are the chapter's. Without an
    outline or terms a dash stands there. chapters(key, md) has one row a chapter; a chapter without markers has no chunks.
    """
    pages = kept(marked_pages(chapters, [key], md), "pages")
    numbered = chunk_numbers(pages, [key], "pos", budget=budget).select(key, "pos", "chunk_no")
    rows = same_keys(pages, numbered, [key, "pos"])
    ordered = F.array_sort(F.collect_list(F.struct("pos", "label", "page_no", "text")))
    made = rows.groupBy(key, "chunk_no").agg(ordered.alias("p"))
    body = strip(F.array_join(F.transform("p", lambda p: p["text"]), ""))
    labels = F.transform("p", lambda p: p["label"])
    made = made.select(key, "chunk_no", body.alias("body"), F.element_at(labels, 1).alias("a"), F.element_at(labels, -1).alias("z"), F.element_at("p", 1)["page_no"].alias("first_page"), F.element_at("p", -1)["page_no"].alias("last_page"), F.size("p").alias("n_pages"))
    counts = numbered.groupBy(key).agg(F.max("chunk_no").alias("n_chunks"))
    facts = chapters.select(key, F.array_join(F.transform(outline_titles(F.col(md)), lambda t: F.concat(F.lit("- "), t)), "\n").alias("outline"))
    facts = same_keys(facts, term_lines(glossary_hits(chapters, terms, key, md), terms, key), [key], "left")
    made = same_keys(same_keys(made, counts, [key]), facts, [key], "left")
    images = F.transform(F.regexp_extract_all("body", F.lit(r"!\[[^\]]*\]\(([^)]+)\)"), F.lit(1)), lambda i: F.regexp_extract(i, r"([^/]+)$", 1))
    dash = lambda c: F.when(F.coalesce(c, F.lit("")) == "", "-").otherwise(c)
    note = F.concat(F.when(F.col("chunk_no") == 1, first_note).otherwise(""), F.when(F.col("chunk_no") == F.col("n_chunks"), last_note).otherwise(""))
    values = {
        "range": F.when(F.col("n_pages") > 1, F.concat("a", F.lit(" – "), "z")).otherwise(F.col("a")), "no": F.col("chunk_no").cast("string"), "count": F.col("n_chunks").cast("string"),
        "images": F.when(F.size(images) > 0, F.concat(F.lit(images_note), F.array_join(images, ", "))).otherwise(""), "outline": dash(F.col("outline")), "terms": dash(F.col("terms")), "note": note, "text": F.col("body"),
    }
    return made.select(key, "chunk_no", "n_chunks", "first_page", "last_page", F.size(images).alias("n_images"), _fill(template, values).alias("prompt"))


def instructions(chapters: DataFrame, counts: DataFrame, key: list[str], template: str) -> DataFrame:
    """(key, instructions): the chapter's own instruction text, from a template with {label}, {title}, {name} and {count} (of chunks);
    chapters(key, label, title, name), counts(key, n_chunks). A chapter without chunks has none."""
    rows = same_keys(chapters, counts.select(*key, "n_chunks"), key)
    parts = re.split(r"\{(label|title|name|count)\}", template)
    value = lambda p: F.coalesce(F.col("n_chunks" if p == "count" else p).cast("string"), F.lit(""))
    return rows.select(*key, F.concat(*[value(p) if i % 2 else F.lit(p) for i, p in enumerate(parts)]).alias("instructions"))
