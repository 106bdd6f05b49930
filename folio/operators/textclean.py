"""Cleaning of page text: running headers, page numbers, hyphens, bullets, split sentences, and all of it in its fixed order.

Pages are rows with the book's key columns, an order column and a text; everything is built-in expressions, windows and joins.

Edge cases: a null text has no lines and comes out empty where lines are taken from it (remove_headers), else null; empty texts stay empty; null keys are a book of
their own; pages that share a place keep both their texts, ordered by it; repeated rows are kept and count as often as they stand; an empty
table gives no rows; other columns, whatever their names, are handed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import bare, capital_d, contents_items, heading_case, is_complete, lines, normal_line, starts_item, strip, without_picture_noise, words
from folio.operators.vocab import replace_words
from folio.plans.runtime import checkpointed, fresh, once, own, same_keys

EDGE = 3
LONGEST = 100
#: Headers of up to so many books (32 lines of 100 characters each at most) are sent to all tasks; more are joined by a shuffle.
MOST_BOOKS = 20_000


def _blank(c: Column) -> Column:
    return ~c.rlike(r"\S")


def _with_edges(pages: DataFrame, text: str, n: int, rows: str, edges: str) -> DataFrame:
    """Adds the lines (rows) and the first and last n that are not blank (edges), as structs of place (from 0) and line. Columns of their own,
    so that a text is cut into lines once."""
    filled = f"{edges}_of"
    df = pages.withColumn(rows, F.transform(lines(F.col(text)), lambda x, i: F.struct(i.alias("i"), x.alias("x"))))
    df = df.withColumn(filled, F.filter(F.col(rows), lambda s: ~_blank(s["x"])))
    return df.withColumn(edges, F.array_distinct(F.concat(F.slice(filled, 1, n), F.reverse(F.slice(F.reverse(F.col(filled)), 1, n)))))


def exploded_lines(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """One row per line, numbered from 0."""
    return df.select(key, F.posexplode(lines(F.col(text))).alias("line_no", "line"))


def running_headers(pages: DataFrame, book: list[str], text: str = "text") -> DataFrame:
    """Normalised short lines that stand at the edges of a quarter of a book's pages (3 at least), with their counts.

    One count with map-side sums; a book has at most 32 such lines, since a page offers 6 and a line needs max(3, n / 4).
    """
    rows, edges = fresh(pages, "page_rows", "page_edges")
    seen = F.array_distinct(F.transform(edges, lambda s: s["x"]))
    edged = _with_edges(pages.select(*book, text), text, EDGE, rows, edges)
    short = edged.select(*book, F.explode(seen).alias("line")).filter(F.length(strip(F.col("line"))) <= LONGEST)
    counts = short.groupBy(*book, normal_line(F.col("line")).alias("header")).agg(F.count(F.lit(1)).alias("n_pages"))
    sizes = pages.groupBy(*book).agg(F.count(F.lit(1)).alias("book_pages"))
    sizes = sizes.toDF(*[f"book_{b}" for b in book], "book_pages")
    kept = counts.join(sizes, [F.col(b).eqNullSafe(F.col(f"book_{b}")) for b in book]).filter(F.col("n_pages") >= F.greatest(F.lit(3), F.floor(F.col("book_pages") / 4)))
    return kept.select(*book, "header", "n_pages", "book_pages")


def remove_headers(pages: DataFrame, book: list[str], text: str = "text") -> DataFrame:
    """The pages with running headers deleted from their edges; other lines stay as they are."""
    headers, rows, edges, gone = fresh(pages, "headers", "page_rows", "page_edges", "gone")
    found = checkpointed(running_headers(pages, book, text).groupBy(*book).agg(F.collect_set("header").alias(headers)))  # 32 strings at most
    if found.count() <= MOST_BOOKS:  # then the texts stay where they are
        found = F.broadcast(found)
    joined = _with_edges(same_keys(pages, found, book, "left"), text, EDGE, rows, edges)
    header = lambda s: (F.length(strip(s["x"])) <= LONGEST) & F.array_contains(headers, normal_line(s["x"]))
    joined = joined.withColumn(gone, F.when(F.col(headers).isNotNull(), F.filter(edges, header)))
    # places make the lines distinct; nothing is computed anew for each line, and pages without a header stay as they are
    rest = F.array_join(F.transform(F.array_except(F.col(rows), F.col(gone)), lambda s: s["x"]), "\n")
    return joined.withColumn(text, F.when(F.coalesce(F.size(gone), F.lit(0)) > 0, rest).otherwise(F.coalesce(F.col(text), F.lit("")))).select(*own(pages))


def remove_page_numbers(pages: DataFrame, text: str = "text", printed: str = "printed_no") -> DataFrame:
    """Deletes edge lines (two at each end, 100 characters at most without decoration) that begin or end with the page's printed number."""
    rows, edges = fresh(pages, "page_rows", "page_edges")
    number = F.col(printed).cast("string")
    size = F.length(number)

    def bears(t: Column) -> Column:  # no pattern is made for each row's number
        begins = F.startswith(t, number) & ~F.substring(t, size + 1, F.lit(2)).rlike(r"^\.?[0-9]")
        ends = F.endswith(t, number) & ((F.length(t) == size) | ~F.substring(t, F.length(t) - size, F.lit(1)).rlike("[0-9.]"))
        return (F.length(t) <= LONGEST) & (begins | ends)

    numbered = F.filter(edges, lambda s: once(bare(s["x"]), bears))
    rest = F.array_join(F.transform(F.array_except(F.col(rows), numbered), lambda s: s["x"]), "\n")
    edged = _with_edges(pages, text, 2, rows, edges)
    return edged.withColumn(text, F.when(F.col(printed).isNull() | F.col(text).isNull(), F.col(text)).otherwise(rest)).select(*own(pages))


CAPTION = r"^(?:Figure|Table)\s+(?:[0-9]+|[A-Z])\.[0-9]+\w*\s+[A-Z“\"(]"


def paragraph_kinds(paragraphs: DataFrame, book: list[str], order: str = "pos", text: str = "text") -> DataFrame:
    """Adds kind: heading, box, floating (tables, pictures, captions, notes, links, stray labels beside them) or text."""
    w = Window.partitionBy(*book).orderBy(order)
    t = F.col(text)
    beside = lambda c: F.coalesce(c.rlike(CAPTION) | c.contains("<br>"), F.lit(False))
    floating = t.rlike(r"^(\||<!--|!\[)") | t.contains("<br>") | t.rlike(r"^[*_`\s]*<[A-Za-z/]") | t.rlike(r"^>\s*[†‡*§]|^[†‡]") | t.rlike(r"^(#+\s*)?https?://\S+(\s*/)?\s*$") | (t.rlike(CAPTION) & (words(t) <= 20))
    stray = (words(t) <= 6) & ~is_complete(t) & ~starts_item(t) & (beside(F.lag(t).over(w)) | beside(F.lead(t).over(w)))
    kind = F.when(t.rlike(r"^#{1,5}\s"), "heading").when(t.rlike(r"^######\s"), "box").when(floating | stray, "floating").otherwise("text")
    return paragraphs.withColumn("kind", kind)


def bullet_glyphs(rows: DataFrame, book: list[str], order: str | list[str] = "pos", text: str = "text") -> DataFrame:
    """Removes the glyph I from runs of two or more items "- I x" with only blank lines between; a single one is a pronoun."""
    order = [order] if isinstance(order, str) else order
    glyph, run = fresh(rows, "glyph", "glyph_run")
    w = Window.partitionBy(*book).orderBy(*order)
    t = F.coalesce(F.col(text), F.lit(""))
    blank = _blank(t)
    # blank lines belong to no run and break none
    filled = rows.filter(~blank).withColumn(glyph, t.rlike("^- I [A-Za-z]"))
    runs = filled.withColumn(run, F.sum((~F.col(glyph)).cast("int")).over(w))
    size = F.sum(F.col(glyph).cast("int")).over(Window.partitionBy(*book, run))
    fixed = F.when(F.col(glyph) & (size >= 2), F.concat(F.lit("- "), F.substring(F.col(text), F.lit(5), F.length(text)))).otherwise(F.col(text))
    return runs.withColumn(text, fixed).select(*own(rows)).unionByName(rows.filter(blank))


# First and last parts that make a compound whatever else the text says.
COMPOUND_FIRST = "so self non multi well high low real cross user object safety mission business time".split()
COMPOUND_LAST = "based centric critical oriented driven called level stage scale specific wide intensive defined dependent independent known time term making sized free like off up in out aided related".split()


def hyphen_compounds(raw: DataFrame, book: list[str], text: str = "text") -> DataFrame:
    """(book, joined, hyphened): words split at a line's end whose hyphen belongs to them, one form for each joined word: that which most
    lines split so, the first by letters among equals.

    It does if the word also stands hyphened within a line, if a part is a known compound part, or if the second part has a capital and the
    joined word never stands whole. Counts and joins by word; no book is gathered.
    """
    t = F.col(text)
    every = lambda c, pattern: F.explode(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)))
    split = raw.select(*book, every(t, r"([A-Za-z]+-\n\s*[A-Za-z]+)").alias("w"))
    parts = split.select(*book, F.regexp_extract("w", "^([A-Za-z]+)", 1).alias("a"), F.regexp_extract("w", "([A-Za-z]+)$", 1).alias("b")).groupBy(*book, "a", "b").agg(F.count(F.lit(1)).alias("times"))
    parts = parts.withColumn("joined", F.concat("a", "b")).withColumn("hyphened", F.concat_ws("-", "a", "b")).withColumn("low", F.lower("hyphened"))
    inline = raw.select(*book, every(F.regexp_replace(t, "-\n", ""), r"\b([A-Za-z]+-[A-Za-z]+)\b").alias("w")).select(*book, F.lower("w").alias("low")).distinct().withColumn("inline", F.lit(True))
    whole = raw.select(*book, every(t, r"(?<![-\w])([A-Za-z]+)(?![-\w])").alias("joined")).distinct().withColumn("whole", F.lit(True))
    found = same_keys(same_keys(parts, inline, [*book, "low"], "left"), whole, [*book, "joined"], "left")
    capital = F.col("b").rlike("^[A-Z]") & F.col("whole").isNull()
    good = capital | F.col("inline").isNotNull() | F.lower("a").isin(COMPOUND_FIRST) | F.lower("b").isin(COMPOUND_LAST)
    one = F.min_by("hyphened", F.struct((-F.col("times")).alias("n"), "hyphened"))
    return found.filter(good & (F.lower("joined") != "lifetime")).groupBy(*book, "joined").agg(one.alias("hyphened"))


def repair_hyphens(pages: DataFrame, raw: DataFrame, book: list[str], text: str = "text") -> DataFrame:
    """Puts the hyphens of hyphen_compounds back, in the words of the pages that lost them."""
    found = hyphen_compounds(raw, book, text).select(*book, F.col("joined").alias("word"), F.col("hyphened").alias("fixed"))
    return replace_words(pages, checkpointed(found), book, text)


def capitals_restored(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn(text, capital_d(F.col(text)))


def loose_items(c: Column) -> Column:
    """Raised item numbers begin a paragraph; a caption that became an item stands alone."""
    def raised(told: Column, piece: Column) -> Column:
        number, rest = F.substring_index(piece, "</sup>", 1), F.substring(piece, F.locate("</sup>", piece) + 6, F.length(piece))
        item = piece.contains("</sup>") & number.rlike(r"^[0-9]+\.$")
        return F.when(item, F.concat(F.regexp_replace(told, r"\s+$", ""), F.lit("\n\n"), number, F.lit(" "), F.regexp_replace(rest, r"^\s+", ""))).otherwise(F.concat(told, F.lit("<sup>"), piece))

    pieces = F.split(c, "<sup>")
    told = F.aggregate(F.slice(pieces, F.lit(2), F.size(pieces)), F.element_at(pieces, 1), raised)
    free = lambda r: F.regexp_replace(F.substring(r, F.lit(2), F.length(r)), r"^\s+", "")
    alone = lambda r: F.when(F.substring(r, 1, 1).isin("-", "*") & r.rlike(r"^.\s") & free(r).rlike(CAPTION), free(r)).otherwise(r)
    return F.array_join(F.transform(F.split(told, "\n"), alone), "\n")


def tidy(c: Column) -> Column:
    """Last repairs of a chapter's markdown, line by line: first-level headings that are a number go, numbered lines are not indented, section numbers
    are not struck out; heading case, raised numbers, captions that became items, contents in one line, blank runs."""
    lone = lambda r: F.coalesce((F.substring_index(strip(r), " ", 1) == "#") & bare(r).rlike("^[0-9]+$"), F.lit(False))
    left = lambda r: F.regexp_replace(r, r"^[ \t]+", "")
    plain = lambda r: F.when(left(r).rlike(r"^[0-9]+\.\s"), left(r)).otherwise(r)
    kept = F.transform(F.filter(F.split(F.regexp_replace(c, "~~([0-9.]*[0-9])~~", "$1"), "\n"), lambda r: ~lone(r)), plain)
    return strip(F.regexp_replace(contents_items(loose_items(heading_case(F.array_join(kept, "\n")))), r"\n{3,}", "\n\n"))


def with_links(pages: DataFrame, figures: DataFrame, page: list[str], offset: str = "page_offset", index: str = "page_idx") -> DataFrame:
    """Adds before and after to each page: its marker (file page, and printed page where an offset is known) and the links of the figures in
    its upper half, and the links of the others. figures(page, kind, no, title, file_name, box, labels, table_md); pages have a height."""
    f = F.col("figure")
    name = F.concat(F.initcap("kind"), F.lit(" "), F.col("no"), F.when(F.coalesce(F.col("title"), F.lit("")) != "", F.concat(F.lit(": "), F.col("title"))).otherwise(""))
    told = F.when(F.col("table_md").isNotNull(), F.concat(F.lit("\n\n<!-- "), F.col("no"), F.lit(" as a table: -->\n\n"), F.col("table_md"))).when(F.coalesce(F.col("labels"), F.lit("")) != "", F.concat(F.lit("\n\n<!-- labels of "), F.col("no"), F.lit(": "), F.col("labels"), F.lit(" -->"))).otherwise("")
    link = F.concat(F.lit("!["), name, F.lit("](figures/"), F.col("file_name"), F.lit(")"), told)
    listed = figures.select(*page, F.struct(((F.col("box")["y0"] + F.col("box")["y1"]) / 2).alias("middle"), F.col("box")["y0"].alias("y"), F.col("box")["x0"].alias("x"), "no", link.alias("link")).alias("figure"))
    listed = listed.groupBy(*page).agg(F.array_sort(F.collect_list(f)).alias("figures_here"))  # of one page
    rows = same_keys(without_columns(pages, "before", "after"), listed, page, "left")
    part = lambda upper: F.transform(F.filter("figures_here", lambda x: (x["middle"] < F.col("height") / 2) == F.lit(upper)), lambda x: x["link"])
    printed = F.col(index) - F.col(offset) + 1
    marker = F.concat(F.lit("<!-- page "), (F.col(index) + 1).cast("string"), F.when(F.col(offset).isNotNull(), F.concat(F.lit(" · printed "), printed.cast("string"))).otherwise(""), F.lit(" -->"))
    none = F.array().cast("array<string>")
    before = F.array_join(F.concat(F.array(marker), F.coalesce(part(True), none)), "\n\n")
    return rows.withColumn("before", before).withColumn("after", F.array_join(F.coalesce(part(False), none), "\n\n")).drop("figures_here")


def without_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in names])


def paragraphs(pages: DataFrame, book: list[str], order: str, text: str = "text") -> DataFrame:
    """(book, order, pos, text): the blocks between blank lines, in order."""
    blocks = F.filter(F.transform(F.split(F.col(text), r"\n[ \t]*\n\s*"), strip), lambda b: b != "")
    return pages.select(*book, order, F.posexplode(blocks).alias("pos", "text"))


def clean_chapters(pages: DataFrame, chapter: list[str], order: str = "page_idx", text: str = "text", printed: str = "printed_no") -> DataFrame:
    """(chapter, md): the chapters' text after all cleaning steps, in their fixed order.

    On pages: text read in pictures, page numbers, running headers, raised numbers and stuck captions; then the page's before and after
    (markers and links, which must not shift the header's lines); on paragraphs: sentences cut by a page's end; on the chapter: the capital D,
    the last repairs, glyphs of items. A chapter is one text in the end; until then its pages and paragraphs are rows.
    """
    from folio.operators.stitch import stitched  # it reads this module's paragraph kinds

    rows = pages.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*chapter, order])], F.col(f"`{printed}`").alias("printed_no"), "before", "after", F.coalesce(without_picture_noise(F.col(text)), F.lit("")).alias("text"))
    rows = remove_headers(remove_page_numbers(rows), chapter).withColumn("text", loose_items(F.col("text")))
    blocks = F.filter(F.array("before", "text", "after"), lambda b: F.coalesce(strip(b), F.lit("")) != "")
    rows = checkpointed(rows.withColumn("text", F.array_join(blocks, "\n\n")))
    parts = paragraphs(rows, chapter, order)
    place = F.row_number().over(Window.partitionBy(*chapter).orderBy(order, "pos"))
    joined = stitched(checkpointed(parts.select(*chapter, place.alias("pos"), "text")), chapter)
    gathered = lambda between: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda p: p["text"]), between)
    md = joined.groupBy(*chapter).agg(gathered("\n\n").alias("text")).withColumn("text", tidy(capital_d(F.col("text"))))
    md = checkpointed(md)  # its lines are read twice, with and without blank ones
    line = bullet_glyphs(md.select(*chapter, F.posexplode(F.split("text", "\n")).alias("pos", "text")), chapter)
    return line.groupBy(*chapter).agg(strip(F.regexp_replace(gathered("\n"), r"\n{3,}", "\n\n")).alias("md"))
