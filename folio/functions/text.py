"""Text functions as column expressions: all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word for counting and coverage: a run of letters and digits.
TOKEN = r"[\p{L}\p{N}]+"


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """White space collapsed to single spaces, none at the ends."""
    return strip(F.regexp_replace(c, r"\s+", " "))


def lines(c: Column) -> Column:
    """The lines of a text; a null text has none."""
    return F.split(F.coalesce(c, F.lit("")), r"\r\n|\n|\r")


def normal_line(c: Column) -> Column:
    """What repeated lines have in common: case and numbers do not count."""
    return F.regexp_replace(F.lower(strip(c)), "[0-9]+", "#")


def tokens(c: Column) -> Column:
    """Lower-case words in order; none for null."""
    return F.coalesce(F.regexp_extract_all(F.lower(c), F.lit(f"({TOKEN})"), F.lit(1)), F.array().cast("array<string>"))


def words(c: Column) -> Column:
    """How many runs without white space; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(r"\S+")), F.lit(0)).cast("long")


#: Links to pictures and comments: not words of a text.
UNREAD = r"!\[[^\]]*\]\([^)]*\)|<!--.*?-->"


def read_words(c: Column) -> Column:
    """Words that a reader reads: pictures and comments do not count; 0 for null."""
    return words(F.when(c.contains("![") | c.contains("<!--"), F.regexp_replace(c, UNREAD, "")).otherwise(c))  # most texts have neither


def content_words(c: Column) -> Column:
    """Words of markdown without pictures, comments, headings and table rules; 0 for null."""
    rows = F.split(F.regexp_replace(F.coalesce(c, F.lit("")), UNREAD, " "), "\n")
    told = F.filter(rows, lambda r: ~r.startswith("#") & ~r.rlike(r"^[-:| ]+$"))
    return F.regexp_count(F.array_join(told, "\n"), F.lit(r"(?U)\w+")).cast("long")


def bare(c: Column) -> Column:
    """Markdown without its decoration, for comparing."""
    # Signs of bold, italics, strike, underline, headings, quotes and code.
    return strip(F.regexp_replace(c, r"\*\*|__|~~|</?u>|[#>`]", ""))


#: Marks around the text that was read within a picture.
PICTURE_BEGINS, PICTURE_ENDS = "<!-- Start of picture text -->", "<!-- End of picture text -->"


def without_picture_noise(c: Column) -> Column:
    """Text read within pictures is kept if half of its tokens are words (three letters at least, small but for the first), else dropped; the
    marks around it go. A block is the part of the line before its end mark that follows the start mark, if there is one."""
    parts = F.split(c, PICTURE_ENDS)
    n = F.size(parts)

    def block(part: Column, i: Column) -> Column:
        line = F.substring_index(part, "\n", -1)
        text = F.substring_index(line, PICTURE_BEGINS, -1)
        head = F.substring(part, F.lit(1), F.length(part) - F.length(text))
        tokens_ = F.filter(F.split(text, r"<br>|\s+"), lambda t: t != "")
        known = F.filter(tokens_, lambda t: t.rlike(r"^\p{L}[\p{Ll}'’-]{2,}[.,;:]?$"))
        kept = F.when((F.size(tokens_) > 0) & (2 * F.size(known) >= F.size(tokens_)), F.regexp_replace(text, r"\s+$", "")).otherwise("")
        return F.when(i == n - 1, part).otherwise(F.concat(head, kept))

    return F.replace(F.array_join(F.transform(parts, block), ""), F.lit(PICTURE_BEGINS), F.lit(""))


def is_complete(c: Column) -> Column:
    """Ends a sentence: . : ! or ? before any closing marks."""
    return F.regexp_replace(c, r"[\s*_”’\"')\]»]+$", "").rlike(r"[.:!?]$")


def starts_item(c: Column) -> Column:
    """Looks like a list item."""
    return c.rlike(r"^(?:[0-9]+\.|[-*•])\s")


def odd_case(c: Column) -> Column:
    """Mixed case that no word has: a small first letter with capitals behind, or two steps up."""
    steps = F.regexp_count(c, F.lit(r"\p{Ll}(?=\p{Lu})"))
    return (F.length(c) >= 4) & (F.upper(c) != c) & (c.rlike(r"^\p{Ll}.*\p{Lu}") | (steps >= 2))


def capital_d(c: Column) -> Column:
    """Restores a capital D that a font gave as d, where a word of three letters or more begins a line (behind an item's mark or not) or a
    sentence; the word doi stays."""
    place = r"^\s*(?:(?:[-*]|\d+\.)\s+)?|[.!?] "
    return F.regexp_replace(c, rf"(?md)({place})d(?!oi\b)(?=[a-z][a-z])", "$1D")


def heading_case(c: Column) -> Column:
    """Words of odd case in headings (exerCiSeS) get a capital and small letters."""
    def heading(line: Column) -> Column:
        parts = F.split(line, r"(?<=[A-Za-z])(?![A-Za-z])|(?<![A-Za-z])(?=[A-Za-z])")
        return F.array_join(F.transform(parts, lambda w: F.when(w.rlike("^[A-Za-z]+$") & odd_case(w), F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, F.lit(2), F.length(w))))).otherwise(w)), "")

    return F.array_join(F.transform(F.split(c, "\n"), lambda line: F.when(line.startswith("#"), heading(line)).otherwise(line)), "\n")


def contents_items(c: Column) -> Column:
    """A Contents heading's numbered entries, also several in one line, as items of their own: paragraphs that begin with a section number."""
    number = r"\d{1,2}\.\d{1,2}\s"  # fixed value: what a section number in the contents looks like
    parts = F.split(c, r"\n\n+")
    entry = lambda p: p.rlike(rf"^(?:[-*]\s*)?{number}")
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(False).alias("inside"))

    def step(acc: Column, p: Column) -> Column:
        lines_ = F.transform(F.split(p, "\n"), lambda r: F.regexp_replace(r, r"^\s*[-*]?\s*", ""))
        split_ = F.flatten(F.transform(lines_, lambda r: F.split(r, rf"\s+(?={number})")))
        items = F.transform(F.filter(split_, lambda r: r != ""), lambda r: F.concat(F.lit("- "), strip(r)))
        listed = acc["inside"] & entry(p)
        return F.struct(F.concat(acc["out"], F.when(listed, items).otherwise(F.array(p))).alias("out"), (listed | p.rlike(r"^#+\s*\**Contents\**\s*$")).alias("inside"))

    # only texts with such a heading are folded
    return F.when(c.rlike(r"(?m)^#+\s*\**Contents\**\s*$"), F.array_join(F.aggregate(parts, start, step, lambda a: a["out"]), "\n\n")).otherwise(c)


def join_lines(first: Column, second: Column) -> Column:
    """Two lines as one; a hyphen within a word is kept and closes up."""
    a, b = F.regexp_replace(first, r"\s+$", ""), strip(second)
    return F.when(a == "", b).when(a.rlike(r"\p{L}-$") & b.rlike(r"^\p{L}"), F.concat(a, b)).otherwise(F.concat(a, F.lit(" "), b))


def escape_block(c: Column) -> Column:
    """A line that must not turn into a markdown block."""
    s = strip(c)
    # Signs that begin a block of markdown.
    return F.when(s.rlike(r"^(#|>|\d+[.)]\s|[-+*]\s)"), F.concat(F.lit("\\"), s)).otherwise(s)


def table_cell(c: Column) -> Column:
    return strip(F.replace(c, F.lit("|"), F.lit("\\|")))


def folder_key(c: Column) -> Column:
    """A name without accents of Turkish letters, case and signs, for comparing."""
    # Letters and what they fold to.
    return F.regexp_replace(F.lower(F.translate(c, "çğıöşüÇĞİÖŞÜ", "cgiosuCGIOSU")), "[^a-z0-9]", "")


def safe_name(c: Column, fallback: Column) -> Column:
    """A file name: reserved signs gone, spaces to underscores, 80 characters at most."""
    name = F.substring(F.regexp_replace(strip(F.regexp_replace(c, r'[\\/:*?"<>|]', "")), r"\s+", "_"), 1, 80)
    return F.when(F.coalesce(name, F.lit("")) == "", fallback).otherwise(name)


def chapter_file(kind: Column, no: Column, title: Column) -> Column:
    """Two digits for a chapter, App_X for an appendix."""
    name = safe_name(title, F.concat(F.lit("Chapter_"), no))
    return F.when(kind == "appendix", F.concat(F.lit("App_"), no, F.lit("_"), name, F.lit(".md"))).otherwise(F.concat(F.lpad(no, 2, "0"), F.lit("_"), name, F.lit(".md")))
