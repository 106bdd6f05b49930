"""Chapters from bookmarks or a contents page, page offsets, body fonts.

Edge cases: a null title or text names nothing; a null page is no place; books need a row in documents (null keys meet none) to have chapters; ties
go to what is read first; repeated entries count as the first; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import lines, squeeze, strip

#: Titles of bookmarks and contents entries.
CHAPTER = r"(?i)^\s*chapter\s+([0-9]{1,3})\s*[:.–—-]?\s*(.*)$"
APPENDIX = r"^\s*(?i:appendix)(?:[\s–-]*([A-Z]|[0-9]{1,2})(?!\w)|(?!\w))\s*[:.–—-]?\s*(.*)$"
GLOSSARY = r"(?i)^\s*glossary\s*$"


def body_mode(spans: DataFrame, book: list[str]) -> DataFrame:
    """(font, size) that most characters of a book are set in; sizes are rounded half to even; ties go to the span read first."""
    size = F.bround(F.col("size")).cast("int")
    order = F.struct("page_idx", "block_no", "line_no", "span_no")
    sums = spans.groupBy(*book, "font", size.alias("size")).agg(F.sum(F.length(strip(F.col("text")))).alias("n_chars"), F.min(order).alias("first"))
    best = F.min_by(F.struct("font", "size", "n_chars"), F.struct((-F.col("n_chars")).alias("n"), F.col("first")))
    return sums.groupBy(*book).agg(best.alias("b")).select(*book, "b.*")


def page_offset(pages: DataFrame, book: list[str], text: str = "text") -> DataFrame:
    """page_idx - (printed number - 1) by vote of the numbers in the first and last two lines of all pages; 5 votes at least.

    A line gives its numbers once, on short pages too. Ties go to the number seen first.
    """
    rows = F.filter(F.transform(lines(F.col(text)), strip), lambda x: x != "")
    n = F.size(rows)
    first, last = F.slice(rows, 1, 2), F.slice(rows, F.greatest(F.lit(3), n - 1), 2)
    votes = pages.select(*book, "page_idx", F.posexplode(F.concat(first, last)).alias("line_no", "line"))
    votes = votes.select(*book, "page_idx", "line_no", F.posexplode(F.regexp_extract_all("line", F.lit(r"(?:^|\s)([0-9]{1,4})(?=\s|$)"), F.lit(1))).alias("k", "number"))
    votes = votes.withColumn("number", F.col("number").cast("int")).filter("number BETWEEN 1 AND 5000").withColumn("page_offset", F.col("page_idx") - F.col("number") + 1)
    sums = votes.groupBy(*book, "page_offset").agg(F.count(F.lit(1)).alias("votes"), F.min(F.struct("page_idx", "line_no", "k")).alias("seen"))
    best = F.min_by(F.struct("page_offset", "votes"), F.struct((-F.col("votes")).alias("v"), F.col("seen")))
    return sums.groupBy(*book).agg(best.alias("b")).select(*book, "b.*").filter("votes >= 5")


def _lettered(found: DataFrame, book: list[str]) -> DataFrame:
    """Appendices in order: missing letters filled by how many were taken before, the first of each letter kept."""
    rows = found.groupBy(*book).agg(F.array_sort(F.collect_list(F.struct("first_page", "pos", "letter", "title", "last_page"))).alias("rows"))
    start = F.array().cast("array<struct<letter:string,title:string,first_page:int,last_page:int>>")

    def step(acc, r):
        letter = F.when(F.coalesce(r["letter"], F.lit("")) != "", F.upper(r["letter"])).otherwise(F.char(F.size(acc) + 65))
        title = F.when(F.coalesce(r["title"], F.lit("")) != "", r["title"]).otherwise(F.concat(F.lit("Appendix "), letter))
        row = F.struct(letter.alias("letter"), title.alias("title"), r["first_page"].cast("int").alias("first_page"), r["last_page"].cast("int").alias("last_page"))
        return F.when(F.exists(acc, lambda a: a["letter"] == letter), acc).otherwise(F.array_append(acc, row))

    return rows.select(*book, F.explode(F.aggregate("rows", start, step)).alias("a")).select(*book, F.lit("appendix").alias("kind"), F.col("a.letter").alias("no"), "a.title", "a.first_page", "a.last_page")


def chapters_from_bookmarks(bookmarks: DataFrame, documents: DataFrame, book: list[str]) -> DataFrame:
    """(book, kind, no, title, first_page, last_page), pages from 0, from bookmarks(book, pos, level, title, page) and documents(book, n_pages).

    A chapter ends before the next bookmark of its level or above on a later page. Fewer than two chapters give none. Appendices must stand
    at the chapters' level or above, after the last chapter.
    """
    rows = bookmarks.withColumn("title", squeeze(F.col("title")))
    later = rows.select(*book, F.col("pos").alias("next_pos"), F.col("level").alias("next_level"), F.col("page").alias("next_page"))
    chapter, appendix, glossary = F.col("title").rlike(CHAPTER), F.col("title").rlike(APPENDIX), F.col("title").rlike(GLOSSARY)
    kind = F.when(chapter, "chapter").when(appendix, "appendix").when(glossary, "glossary")
    named = rows.withColumn("kind", kind).filter("kind IS NOT NULL")
    after = named.join(later, book).filter("next_pos > pos AND next_level <= level AND next_page > page").groupBy(*book, "pos").agg(F.min_by("next_page", "next_pos").alias("next_page"))
    ended = named.join(after, [*book, "pos"], "left").join(documents.select(*book, "n_pages"), book)
    ended = ended.select(*book, "pos", "level", "kind", "title", (F.col("page") - 1).alias("first_page"), (F.coalesce(F.col("next_page") - 1, F.col("n_pages")) - 1).alias("last_page"))
    facts = ended.filter("kind = 'chapter'").groupBy(*book).agg(F.count(F.lit(1)).alias("n"), F.min("level").alias("top"), F.max("first_page").alias("last_start")).filter("n >= 2")
    good = ended.join(facts, book)
    number, rest = F.regexp_extract("title", CHAPTER, 1), strip(F.regexp_extract("title", CHAPTER, 2))
    plain = good.filter("kind = 'chapter'").select(*book, "kind", number.cast("int").cast("string").alias("no"), F.when(rest == "", F.concat(F.lit("Chapter "), number)).otherwise(rest).alias("title"), "first_page", "last_page")
    extra = good.filter("kind = 'appendix' AND level <= top AND first_page > last_start")
    extra = extra.select(*book, "pos", F.regexp_extract("title", APPENDIX, 1).alias("letter"), strip(F.regexp_extract("title", APPENDIX, 2)).alias("title"), "first_page", "last_page")
    last = good.filter("kind = 'glossary'").groupBy(*book).agg(F.max_by(F.struct("title", "first_page", "last_page"), "pos").alias("g")).select(*book, F.lit("glossary").alias("kind"), F.lit("99").alias("no"), "g.*")
    return plain.unionByName(_lettered(extra, book)).unionByName(last).filter("last_page >= first_page")


def contents_entries(pages: DataFrame, book: list[str], text: str = "text", most: int = 40) -> DataFrame:
    """Entries of printed contents on the first pages: one line, or title and number on the lines after."""
    rows = F.filter(F.transform(lines(F.col(text)), squeeze), lambda x: x != "")
    line = pages.filter(F.col("page_idx") < most).select(*book, "page_idx", F.posexplode(rows).alias("line_no", "line"))
    w = Window.partitionBy(*book, "page_idx").orderBy("line_no")
    near = line.withColumn("l1", F.lead("line", 1).over(w)).withColumn("l2", F.lead("line", 2).over(w)).withColumn("l3", F.lead("line", 3).over(w))
    head = r"^(?:(?i:chapter)\s+([0-9]{1,3})\b|(?i:appendix)(?:[\s–-]*([A-Z])(?!\w)|(?!\w)))\s*[:.–—-]?\s*(.*)$"
    number = lambda c: c.rlike("^[0-9]{1,4}$")
    rest = F.regexp_extract("line", head, 3)
    own_page = F.regexp_extract(rest, r"(?:^|\s)([0-9]{1,4})$", 1)
    own_title = strip(F.when(own_page != "", F.regexp_replace(rest, r"(?:^|\s)[0-9]{1,4}$", "")).otherwise(rest))
    below = (own_title == "") & ~number(F.col("l1"))  # the title stands on the next line
    title = F.when(below, F.col("l1")).otherwise(own_title)
    a, b = F.when(below, F.col("l2")).otherwise(F.col("l1")), F.when(below, F.col("l3")).otherwise(F.col("l2"))
    two = (own_page == "") & F.coalesce(~number(a) & number(b) & (F.length(a) < 60), F.lit(False))
    page = F.when(own_page != "", own_page).when(two, b).when(number(a), a)
    full = F.when(two, F.concat_ws(" ", title, a)).otherwise(title)
    entry = near.filter(F.col("line").rlike(head)).select(*book, "page_idx", "line_no", F.when(F.regexp_extract("line", head, 1) != "", "chapter").otherwise("appendix").alias("kind"), F.concat(F.regexp_extract("line", head, 1), F.upper(F.regexp_extract("line", head, 2))).alias("no"), full.alias("title"), page.cast("int").alias("printed_page"))
    other = r"(?i)^(glossary|subject index|author index|index|references|part\s+[0-9]{1,2}\b.*?)(?:\s+([0-9]{1,4}))?$"
    kind = F.when(F.col("line").rlike("(?i)^glossary"), "glossary").when(F.col("line").rlike("(?i)^part"), "part").otherwise("end")
    part_page = F.when(F.col("line").rlike(r"(?i)^part\s+[0-9]+$"), F.lit("")).otherwise(F.regexp_extract("line", other, 2))
    more = near.filter(F.col("line").rlike(other)).select(*book, "page_idx", "line_no", kind.alias("kind"), F.lit("").alias("no"), F.regexp_extract("line", other, 1).alias("title"), F.when(part_page != "", part_page).when(number(F.col("l1")), F.col("l1")).cast("int").alias("printed_page"))
    both = entry.unionByName(more).filter("printed_page IS NOT NULL AND title <> ''")
    return both.withColumn("pos", F.row_number().over(Window.partitionBy(*book).orderBy("page_idx", "line_no"))).select(*book, "pos", "kind", "no", "title", "printed_page")


def chapters_from_contents(entries: DataFrame, offsets: DataFrame, documents: DataFrame, book: list[str]) -> DataFrame:
    """Chapters from contents entries(book, pos, kind, no, title, printed_page): each ends before the next boundary of any kind.

    The first entry of a chapter number counts; a part within three pages behind a chapter's start is a misread number; appendices count
    behind the last chapter; page numbers are shifted by the book's offset and cut to its pages.
    """
    firsts = entries.filter("kind IN ('chapter', 'appendix')").groupBy(*book, "kind", "no").agg(F.min_by(F.struct("pos", "title", "printed_page"), "pos").alias("e")).select(*book, "kind", "no", "e.*")
    chapters = firsts.filter("kind = 'chapter'")
    facts = chapters.groupBy(*book).agg(F.count(F.lit(1)).alias("n"), F.max("printed_page").alias("last_start")).filter("n >= 2")
    appendices = firsts.filter("kind = 'appendix'").join(facts, book).filter("printed_page > last_start").select(*firsts.columns)
    marks = entries.filter("kind IN ('glossary', 'end')").groupBy(*book, "kind").agg(F.min_by(F.struct("pos", "title", "printed_page"), "pos").alias("e")).select(*book, "kind", F.lit("99").alias("no"), "e.*")
    starts = chapters.select(*book, F.col("printed_page").alias("start"))
    misread = entries.filter("kind = 'part'").join(starts, book).filter("printed_page - start BETWEEN 0 AND 2").select(*book, "pos").distinct()
    parts = entries.filter("kind = 'part'").join(misread, [*book, "pos"], "left_anti").select(*book, "kind", "no", "pos", "title", "printed_page")
    bounds = chapters.unionByName(appendices).unionByName(marks).unionByName(parts)
    next_page = F.min("printed_page").over(Window.partitionBy(*book).orderBy("printed_page").rangeBetween(1, Window.unboundedFollowing))
    ended = bounds.withColumn("next_page", next_page).filter("kind NOT IN ('part', 'end')").join(facts, book).join(offsets.select(*book, "page_offset"), book).join(documents.select(*book, "n_pages"), book)
    place = lambda c: F.greatest(F.lit(0), F.least(F.col("n_pages") - 1, c - 1 + F.col("page_offset"))).cast("int")
    last = F.coalesce(place(F.col("next_page") - 1), (F.col("n_pages") - 1).cast("int"))
    placed = ended.select(*book, "pos", "kind", "no", "title", place(F.col("printed_page")).alias("first_page"), last.alias("last_page"))
    extra = _lettered(placed.filter("kind = 'appendix'").withColumnRenamed("no", "letter").drop("kind"), book)
    return placed.filter("kind <> 'appendix'").drop("pos").unionByName(extra).filter("last_page >= first_page")


def first_found(*tries: DataFrame, book: list[str]) -> DataFrame:
    """For each book the rows of the first of several ways that gave it any."""
    out = tries[0]
    for t in tries[1:]:
        out = out.unionByName(t.join(out.select(*book).distinct(), book, "left_anti"))
    return out


def single_chapter(pages: DataFrame, documents: DataFrame, book: list[str], most: int = 12) -> DataFrame:
    """A book without bookmarks and contents as one chapter: number and title by vote of the chapter headers on its first pages, else from
    the first page's first five lines, else 1 and "Chapter"."""
    head = r"(?i)chapter\s+([0-9]{1,3})\s*[■•|:–—-]?\s*(.+)$"
    line = pages.filter(F.col("page_idx") < most).select(*book, "page_idx", F.posexplode(F.transform(lines(F.col("text")), strip)).alias("line_no", "line"))
    votes = line.filter(F.col("line").rlike(head)).select(*book, F.regexp_extract("line", head, 1).cast("int").alias("no"), strip(F.regexp_extract("line", head, 2)).alias("title"), F.struct("page_idx", "line_no").alias("at")).filter(F.length("title") < 60)
    counts = votes.groupBy(*book, "no", "title").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("at"))
    best = counts.groupBy(*book).agg(F.min_by(F.struct("no", "title"), F.struct((-F.col("n")).alias("n"), "at")).alias("voted"))
    first = F.slice(F.filter(F.transform(lines(F.col("text")), strip), lambda x: x != ""), 1, 5)
    number = F.filter(first, lambda x: x.rlike("^[0-9]{1,2}$"))
    words_ = F.filter(first, lambda x: ~x.rlike("^[0-9]+$"))
    front = pages.filter("page_idx = 0").select(*book, F.coalesce(F.get(number, F.lit(0)).cast("int"), F.lit(1)).alias("no0"), F.coalesce(F.get(words_, F.lit(0)), F.lit("Chapter")).alias("title0"))
    rows = documents.select(*book, "n_pages").join(best, book, "left").join(front, book, "left")
    no, title = F.coalesce("voted.no", "no0", F.lit(1)).cast("string"), F.coalesce("voted.title", "title0", F.lit("Chapter"))
    return rows.select(*book, F.lit("chapter").alias("kind"), no.alias("no"), title.alias("title"), F.lit(0).alias("first_page"), (F.col("n_pages") - 1).cast("int").alias("last_page"))
