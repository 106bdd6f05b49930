"""Sentences that a page's end cuts are put together again, over the tables, pictures and side boxes between.

A rule over windows of a chapter, between two headings: an *open* paragraph is text that ends nowhere and has more than six words (or fewer
than that it heads a box), and does not explain a box. What stands behind it, up to and with the next open paragraph, is its stretch. A paragraph
of the stretch continues it

* with a small first letter, if at most MOST_BETWEEN paragraphs stand between, and no prose among them but what a box explains;
* with a capital, if floating paragraphs stand between, at least one, and nothing else;

unless an earlier paragraph of the stretch continued and completed it. Continuations that are open themselves pass their own continuations on,
so a chain is one sentence; chains are numbered by a running count of the open paragraphs that continue nothing.

Edge cases: a null or blank paragraph is floating; items never continue a sentence; paragraphs that share a place are ordered by their text;
null keys are a chapter of their own; an empty table gives no rows. A chapter (some hundred paragraphs) is one window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.functions.text import is_complete, starts_item, strip, words
from folio.operators.textclean import paragraph_kinds

MOST_BETWEEN = 12
SHORT = 6


def stitched(paragraphs: DataFrame, book: list[str], order: str = "pos", text: str = "text") -> DataFrame:
    """(book, pos, kind, text) with continuations moved to the paragraph that they continue."""
    rows = paragraphs.select(*book, F.col(order).alias("at"), F.coalesce(F.col(text), F.lit("")).alias("told"))
    rows = paragraph_kinds(rows, book, "at", "told").withColumn("kind", F.when(strip(F.col("told")) == "", "floating").otherwise(F.col("kind")))
    chapter = Window.partitionBy(*book).orderBy("at", "told")
    is_text, done = F.col("kind") == "text", is_complete(F.col("told"))
    lead = F.substring(F.regexp_replace("told", r"^[\s_*“\"‘'(]+", ""), 1, 1)
    unended = is_text & ~done
    short = unended & (words(F.col("told")) <= SHORT)
    explains = unended & ~short & (F.lag("kind").over(chapter) == "box")
    rows = rows.select(
        *book, "at", "told", "kind", F.sum((F.col("kind") == "heading").cast("int")).over(chapter).alias("section"), F.coalesce(unended & ~short & ~F.coalesce(explains, F.lit(False)), F.lit(False)).alias("open"),
        ((F.col("kind") == "box") | short).cast("int").alias("box"), ((is_text & done) | F.coalesce(explains, F.lit(False))).cast("int").alias("prose"), (F.col("kind") == "floating").cast("int").alias("floats"),
        (is_text & ~starts_item(F.col("told"))).alias("may"), done.alias("done"), lead.rlike(r"^\p{Ll}").alias("small"), lead.rlike(r"^\p{Lu}").alias("capital"),
    )
    before = Window.partitionBy(*book, "section").orderBy("at", "told").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("stretch", F.coalesce(F.sum(F.col("open").cast("int")).over(before), F.lit(0)))
    between = Window.partitionBy(*book, "section", "stretch").orderBy("at", "told").rowsBetween(Window.unboundedPreceding, -1)
    n = lambda c: F.coalesce(F.sum(c).over(between), F.lit(0))
    count = F.coalesce(F.count(F.lit(1)).over(between), F.lit(0))
    on_small = F.col("small") & (count <= MOST_BETWEEN) & ((n("prose") == 0) | (n("box") > 0))
    on_capital = F.col("capital") & (count >= 1) & (count <= MOST_BETWEEN) & (n("floats") == count)
    rows = rows.withColumn("fits", F.col("may") & (F.col("stretch") > 0) & (on_small | on_capital))
    completed = F.coalesce(F.max((F.col("fits") & F.col("done")).cast("int")).over(between), F.lit(0)) == 1
    rows = rows.withColumn("goes_on", F.col("fits") & ~completed)
    first = F.col("open") & ~F.col("goes_on")
    rows = rows.withColumn("chain", F.coalesce(F.sum(first.cast("int")).over(before), F.lit(0)) + first.cast("int"))
    # what neither begins nor continues a chain stays by itself
    alone = F.when(first | F.col("goes_on"), F.lit(None).cast("long")).otherwise(F.row_number().over(Window.partitionBy(*book, "section").orderBy("at", "told")))
    parts = F.array_sort(F.collect_list(F.struct("at", "told", "kind")))
    whole = rows.withColumn("alone", alone).groupBy(*book, "section", F.when(F.col("alone").isNull(), F.col("chain")).alias("chain"), "alone").agg(parts.alias("parts"))
    told = F.transform("parts", lambda p, i: F.when(i == F.size("parts") - 1, p["told"]).otherwise(F.regexp_replace(p["told"], r"\s+$", "")))
    head = F.element_at("parts", 1)
    return whole.select(*book, head["at"].alias(order), head["kind"].alias("kind"), F.array_join(told, " ").alias(text))
