"""Books from their pages to the files of a package: chapters found in one of three ways, cleaned, packed into study prompts, with instructions and an index.

Edge cases: a book without bookmarks and contents is one chapter; ranges that end before they begin, and pages that no chapter has, make no file; a null
text is an empty page; a page in two ranges stands in both chapters; books and chapters whose names come out equal are told apart by a number behind the
name, in the order of their keys or pages; keys that are null make no files; other columns are not read; empty tables give no files. Pages are rows until a
chapter is one text in the end, as its file is; a chapter is the largest group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import chapter_file, safe_name
from folio.operators import pack, structure
from folio.operators.textclean import clean_chapters, repair_hyphens, with_links
from folio.plans.runtime import kept

GUIDE = "{label}: {title}\nGive the {count} parts of {name} to the model in their order, and keep its answers beside them.\n"


def _apart(df: DataFrame, name: str, to: str, within: list[str], order: list[str]) -> DataFrame:
    """Adds to: the name, with a number behind it where names come out equal (compared without case, as some file systems do). All that differ by
    numbers at their ends only are numbered together then, the shortest first, so that none takes another's name."""
    base = Window.partitionBy(*within, F.regexp_replace(F.lower(name), "(_[0-9]+)+$", ""))
    same = F.count(F.lit(1)).over(Window.partitionBy(*within, F.lower(name)))
    rows = df.withColumn("same_name", same).withColumn("same_name", F.max("same_name").over(base))
    n = F.row_number().over(base.orderBy(F.length(name), *order))
    return rows.withColumn(to, F.when((F.col("same_name") > 1) & (n > 1), F.concat(name, F.lit("_"), n.cast("string"))).otherwise(F.col(name))).drop("same_name", name)


def book_chapters(pages: DataFrame, bookmarks: DataFrame, documents: DataFrame, book: list[str]) -> DataFrame:
    """(book, kind, no, title, first_page, last_page, way): from the bookmarks, else from printed contents and the offset of page numbers, else the whole
    book as one. pages(book, page_idx, text), bookmarks(book, pos, level, title, page), documents(book, n_pages)."""
    # each is read by several steps: kept, none of them is worked out again within the plan of the next
    documents = kept(documents.select(*book, "n_pages"), "book-documents")
    entries, offsets = kept(structure.contents_entries(pages, book), "book-entries"), kept(structure.page_offset(pages, book).select(*book, "page_offset"), "book-offsets")
    columns = [*book, "kind", "no", "title", "first_page", "last_page"]
    tries = {"bookmarks": structure.chapters_from_bookmarks(bookmarks, documents, book), "contents": structure.chapters_from_contents(entries, offsets, documents, book), "whole": structure.single_chapter(pages, documents, book)}
    made = [kept(t.select(*columns, F.lit(way).alias("way")), f"book-{way}") for way, t in tries.items()]
    return structure.first_found(*made, book=book).filter("last_page >= first_page")


def named_chapters(chapters: DataFrame, documents: DataFrame, book: list[str]) -> DataFrame:
    """chapters with name (of the book), label, folder and stem: <folder of the book>/<stem>, and the stem of the chapter's files."""
    books = _apart(documents.select(*book, F.coalesce("name", F.lit("book")).alias("name"), safe_name(F.col("name"), F.lit("book")).alias("plain")), "plain", "book_folder", [], book)
    rows = chapters.join(books.select(*book, "name", "book_folder"), book)
    plain = F.regexp_replace(chapter_file(F.col("kind"), F.col("no"), F.col("title")), r"\.md$", "")
    rows = _apart(rows.withColumn("plain", plain), "plain", "stem", book, ["first_page", "kind", "no", "title", "last_page"])
    label = F.when(F.col("kind") == "appendix", F.concat(F.lit("Appendix "), "no")).when(F.col("kind") == "glossary", F.lit("Glossary")).otherwise(F.concat(F.lit("Chapter "), "no"))
    return rows.withColumn("label", label).withColumn("folder", F.concat("book_folder", F.lit("/"), "stem"))


def chapter_texts(pages: DataFrame, chapters: DataFrame, figures: DataFrame, book: list[str]) -> DataFrame:
    """(folder, md, n_words, n_figures, page_offset): the chapters' cleaned text under a head that says where it comes from.

    pages(book, page_idx, text, height), chapters as named_chapters gives them, figures(book, page_idx, kind, no, title, file_name, box, labels, table_md).
    """
    page = [*book, "page_idx"]
    offsets = structure.page_offset(pages, book).select(*book, "page_offset")
    linked = with_links(pages.select(*page, "text", "height").join(offsets, book, "left"), figures, page)
    linked = linked.select(*page, "text", "before", "after", "page_offset", (F.col("page_idx") - F.col("page_offset") + 1).cast("int").alias("printed_no"))
    ranges = chapters.select(*book, "folder", F.explode(F.sequence(F.col("first_page").cast("int"), F.col("last_page").cast("int"))).alias("page_idx"))
    rows = kept(ranges.join(linked, page), "book-pages")  # read for the text, for the hyphens of its lines and for the offsets
    cleaned = kept(clean_chapters(rows, ["folder"]), "book-cleaned")  # each word of it may be repaired, so it is read more than once
    whole = repair_hyphens(cleaned, rows.select("folder", F.col("text").alias("md")), ["folder"], "md")
    shown = figures.join(ranges, page).groupBy("folder").agg(F.count(F.lit(1)).alias("n_figures"))
    facts = rows.groupBy("folder").agg(F.max("page_offset").alias("page_offset"))
    joined = whole.join(facts, "folder").join(shown, "folder", "left").join(chapters.select("folder", "name", "label", "title", "first_page", "last_page"), "folder")
    span = lambda by: F.concat((F.col("first_page") + by).cast("string"), F.lit("–"), (F.col("last_page") + by).cast("string"))
    printed = F.when(F.col("page_offset").isNotNull(), F.concat(F.lit(" (printed "), span(1 - F.col("page_offset")), F.lit(")"))).otherwise("")
    n = F.coalesce("n_figures", F.lit(0))
    head = F.concat(F.lit("# "), "label", F.lit(": "), "title", F.lit("\n\n> Source: "), "name", F.lit(", pages "), span(F.lit(1)), printed, F.lit(", figures and tables: "), n.cast("string"), F.lit("\n\n"))
    words = F.regexp_count(F.regexp_replace("md", r"(?s)<!--.*?-->", ""), F.lit(r"\S+"))
    return joined.select("folder", F.concat(head, "md", F.lit("\n")).alias("md"), words.alias("n_words"), n.alias("n_figures"), "page_offset")


def book_files(pages: DataFrame, bookmarks: DataFrame, documents: DataFrame, figures: DataFrame, terms: DataFrame, book: list[str], template: str, guide: str = GUIDE, first_note: str = "", last_note: str = "", budget: int = pack.BUDGET) -> DataFrame:
    """(path, content): the files of the books' packages, for sources.package.write_package.

    For each chapter <book>/<chapter>/<chapter>.md, its study prompts parts/<chapter>_<no>.txt (two digits) and instructions.txt; for each book index.md:
    how its chapters were found, and a line a chapter with its pages, words, figures and parts. documents(book, n_pages, name); terms and template as
    pack.study_prompts has them, guide as pack.instructions.
    """
    chapters = kept(named_chapters(book_chapters(pages, bookmarks, documents, book), documents, book), "book-chapters")
    texts = kept(chapter_texts(pages, chapters, figures, book), "book-texts")
    prompts = kept(pack.study_prompts(texts, "folder", template, terms, first_note, last_note, budget=budget), "book-prompts")
    counts = prompts.groupBy("folder").agg(F.max("n_chunks").alias("n_chunks"))
    stem = F.substring_index("folder", "/", -1)
    md = texts.select(F.concat("folder", F.lit("/"), stem, F.lit(".md")).alias("path"), F.col("md").alias("content"))
    no = F.lpad(F.col("chunk_no").cast("string"), F.greatest(F.lit(2), F.length(F.col("chunk_no").cast("string"))), F.lit("0"))
    parts = prompts.select(F.concat("folder", F.lit("/parts/"), stem, F.lit("_"), no, F.lit(".txt")).alias("path"), F.col("prompt").alias("content"))
    told = pack.instructions(chapters.select("folder", "label", "title", F.col("stem").alias("name")), counts, ["folder"], guide)
    guides = told.select(F.concat("folder", F.lit("/instructions.txt")).alias("path"), F.col("instructions").alias("content"))
    rows = chapters.join(texts.select("folder", "n_words", "n_figures"), "folder").join(counts, "folder", "left")
    line = F.concat(F.lit("- ["), "label", F.lit(": "), "title", F.lit("]("), "stem", F.lit("/"), "stem", F.lit(".md), pages "), (F.col("first_page") + 1).cast("string"), F.lit("–"), (F.col("last_page") + 1).cast("string"),
                    F.lit(", words "), F.col("n_words").cast("string"), F.lit(", figures "), F.col("n_figures").cast("string"), F.lit(", parts "), F.coalesce("n_chunks", F.lit(0)).cast("string"))
    listed = rows.groupBy("book_folder", "name", "way").agg(F.array_sort(F.collect_list(F.struct("first_page", "stem", line.alias("line")))).alias("l"))  # the chapters of one book
    index = listed.select(F.concat("book_folder", F.lit("/index.md")).alias("path"), F.concat(F.lit("# "), "name", F.lit("\n\nChapters by: "), "way", F.lit("\n\n"), F.array_join(F.transform("l", lambda x: x["line"]), "\n"), F.lit("\n")).alias("content"))
    return md.unionByName(parts).unionByName(guides).unionByName(index)
