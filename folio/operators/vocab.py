"""Vocabularies, and repairs by them: split words, glued words, single wrong letters.

A repair never carries a book's or deck's list of findings to its rows: findings meet the words of the texts in a join, and each text gets
only what concerns it. A text is known by a 128-bit hash of itself and its keys in these joins, so equal texts are repaired once.

Edge cases: a null text has no words and stays null, an empty one stays empty; null keys are a deck (or language) of their own; repeated rows
are kept; an empty table gives no rows; other columns, whatever their names, are handed through by the repairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import tokens
from folio.plans.runtime import fresh, kept, same_keys, sent_if_small


def vocabulary(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, word, n) over all texts; summed before the shuffle."""
    return df.select(*keys, F.explode(tokens(F.col(text))).alias("word")).groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("n"))


def adjacent_pairs(df: DataFrame, deck: list[str], text: str = "text") -> DataFrame:
    """(deck, left, right, n): neighbouring words with one space between, the second in small letters."""
    pairs = F.regexp_extract_all(F.col(text), F.lit(r"\b([A-Za-z]+ (?=[a-z]+\b))"), F.lit(1))
    right = F.regexp_extract_all(F.col(text), F.lit(r"\b[A-Za-z]+ (?=([a-z]+)\b)"), F.lit(1))
    rows = df.select(*deck, F.explode(F.arrays_zip(pairs.alias("l"), right.alias("r"))).alias("p"))
    return rows.groupBy(*deck, F.lower(F.trim("p.l")).alias("left"), F.col("p.r").alias("right")).agg(F.count(F.lit(1)).alias("n"))


def deck_words(df: DataFrame, deck: list[str], text: str = "text") -> DataFrame:
    """(deck, word, known, in_pairs): how often a run of letters stands in the deck, and how often in pairs whose joined form the deck knows."""
    letters = F.regexp_extract_all(F.lower(F.col(text)), F.lit("([a-z]+)"), F.lit(1))
    known = df.select(*deck, F.explode(letters).alias("word")).groupBy(*deck, "word").agg(F.count(F.lit(1)).alias("known"))
    pairs = adjacent_pairs(df, deck, text).withColumn("word", F.concat("left", "right"))
    torn = same_keys(pairs, known.drop("known"), [*deck, "word"], "left_semi")
    sides = torn.select(*deck, "n", F.explode(F.array("left", "right")).alias("word")).groupBy(*deck, "word").agg(F.sum("n").alias("in_pairs"))
    return same_keys(known, sides, [*deck, "word"], "left").fillna(0, ["in_pairs"])


def torn_pairs(pairs: DataFrame, facts: DataFrame, deck: list[str]) -> DataFrame:
    """(deck, left, right, joined, n): those of the pairs that are one word torn apart, by the deck's facts (deck_words): the joined form is
    known, and one part never stands but in such pairs. Joins by word, so a common word costs no more than its distinct neighbours."""
    found = same_keys(pairs.withColumn("joined", F.concat("left", "right")), facts.select(*deck, F.col("word").alias("joined")), [*deck, "joined"], "left_semi")
    for side in ("left", "right"):
        part = facts.select(*deck, F.col("word").alias(side), (F.col("known") == F.col("in_pairs")).alias(f"{side}_only"))
        found = same_keys(found, part, [*deck, side], "left")
    only = lambda s: F.coalesce(f"{s}_only", F.lit(True))
    return found.filter(only("left") | only("right")).select(*deck, "left", "right", "joined", "n")


def split_words(df: DataFrame, deck: list[str], text: str = "text") -> DataFrame:
    """(deck, left, right, joined): pairs that are one word torn apart."""
    return torn_pairs(adjacent_pairs(df, deck, text), deck_words(df, deck, text), deck).drop("n")


#: Where a word may be torn: a space between a letter and a small letter.
GAP = r"(?<=[A-Za-z]) (?=[a-z])"


def _pieces(text: Column) -> Column:
    return F.split(text, GAP)


def _signature(*columns: Column) -> Column:
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit("again"), *columns).alias("b"))


def close_gaps(df: DataFrame, pairs: DataFrame, deck: list[str], text: str = "text") -> DataFrame:
    """The texts without the spaces between the deck's pairs(deck, left, right); of gaps that touch one word the first is closed.

    A text's gaps are joined with the pairs, and the places found go back to the text.
    """
    sign, at = fresh(df, "text_sign", "gap_places")
    signed = df.withColumn(sign, _signature(*[F.col(f"`{k}`") for k in deck], F.col(text)))
    parts = _pieces(F.col(text))
    ends = F.struct(F.lower(F.regexp_extract(F.element_at("parts", F.col("i")), "([A-Za-z]+)$", 1)).alias("left"), F.regexp_extract(F.element_at("parts", F.col("i") + 1), "^([a-z]+)", 1).alias("right"))
    gaps = signed.filter(F.col(text).rlike(GAP)).select(*[F.col(f"`{k}`") for k in deck], sign, parts.alias("parts")).distinct()
    gaps = gaps.select(*deck, sign, "parts", F.explode(F.sequence(F.lit(1), F.size("parts") - 1)).alias("i")).select(*deck, sign, "i", ends.alias("e")).select(*deck, sign, "i", "e.*")
    met = same_keys(gaps, sent_if_small(pairs.select(*deck, "left", "right").distinct()), [*deck, "left", "right"], "left_semi")
    places = met.groupBy(sign).agg(F.collect_set("i").alias(at))
    places = kept(places, "gaps")
    joined = signed.join(sent_if_small(places), sign, "left")
    mark = lambda i: F.array_contains(at, i) & ~F.array_contains(at, i - 1)
    closed = F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).when(mark(i), p).otherwise(F.concat(F.lit(" "), p))), "")
    columns = [F.when(F.col(at).isNull(), F.col(f"`{c}`")).otherwise(closed).alias(c) if c == text else F.col(f"`{c}`") for c in df.columns]
    return joined.select(*columns)


def repair_split_words(df: DataFrame, deck: list[str], order: list[str], text: str = "text") -> DataFrame:
    """The texts with torn words joined, again and again until nothing is left to join; the deck's counts are those of the texts as given."""
    return repair_with_log(df, deck, text)[0]


def repair_with_log(df: DataFrame, deck: list[str], text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The repaired texts, and what was joined: (deck, left, right, joined, n, round)."""
    facts, rows, log, turn = kept(deck_words(df, deck, text), "words"), df, None, 0
    while True:
        turn += 1
        found = kept(torn_pairs(adjacent_pairs(rows, deck, text), facts, deck).withColumn("round", F.lit(turn)), "torn")
        log = found if log is None else log.unionByName(found)
        if not found.limit(1).count():
            return rows, log
        # each round closes at least the first gap of every run, so the rounds end
        rows = kept(close_gaps(rows, found, deck, text), "closed")


def _deletions(word):
    """All forms of a word with one letter less, and the word itself."""
    n = F.length(word)
    cut = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, n)))
    return F.array_distinct(F.array_append(cut, word))


def one_edit_fixes(words: DataFrame, known: DataFrame, least: int = 6) -> DataFrame:
    """(word, fixed): unknown words of `least` letters that exactly one known word is one edit away from.

    words(word), known(word). An edit leaves a common form after deleting one letter at most on either side, so candidates meet in a hash
    join on those forms (length + 1 rows a word) and are then measured.
    """
    unknown = words.select("word").distinct().filter(F.length("word") >= least).join(known.select("word"), "word", "left_anti")
    left = unknown.select("word", F.explode(_deletions(F.col("word"))).alias("form"))
    right = known.select(F.col("word").alias("fixed")).distinct().filter(F.length("fixed") >= least - 1).select("fixed", F.explode(_deletions(F.col("fixed"))).alias("form"))
    pairs = left.join(right, "form").select("word", "fixed").distinct().filter(F.levenshtein("word", "fixed") == 1)
    return pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.min("fixed").alias("fixed")).filter("n = 1").select("word", "fixed")


def _best_cuts(joined: DataFrame, key: list[str], word: str, known: DataFrame, shortest: int) -> DataFrame:
    """(key, left, right): the cut of each word into two known parts whose rarer part is most frequent, the first of equals; known(word, n)."""
    cuts = joined.filter(F.length(word) >= 2 * shortest).select(*key, F.col(word).alias("whole"), F.explode(F.sequence(F.lit(shortest), F.length(word) - shortest)).alias("cut"))
    parts = cuts.select(*key, "cut", F.expr("substring(whole, 1, cut)").alias("left"), F.expr("substring(whole, cut + 1)").alias("right"))
    side = lambda c: known.select(F.col("word").alias(c), F.col("n").alias(f"n_{c}"))
    both = parts.join(side("left"), "left").join(side("right"), "right")
    best = F.max_by(F.struct("left", "right"), F.struct(F.least("n_left", "n_right"), (-F.col("cut")).alias("c")))
    return both.groupBy(*key).agg(best.alias("b")).select(*key, "b.left", "b.right")


def glued_words(words: DataFrame, known: DataFrame, least: int = 6) -> DataFrame:
    """(word, left, right): unknown words that two known ones make, by the split whose rarer part is most frequent; known(word, n)."""
    unknown = words.select("word").distinct().filter(F.length("word") >= least).join(known.select("word"), "word", "left_anti")
    return _best_cuts(unknown, ["word"], "word", known, 2)


def shifted_gaps(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """(first, second, left, right): neighbours whose gap stands in a wrong place ("i tis"): the first is unknown, and the second too unless the
    first is one letter; together they are two known words, of one letter only if it is a or i. pairs(first, second), known(word, n)."""
    one = F.length("word") > 1
    good = known.filter(one | F.col("word").isin("a", "i"))
    for side in ("first", "second"):
        pairs = pairs.join(known.select(F.col("word").alias(side), F.lit(True).alias(f"{side}_known")), side, "left")
    odd = pairs.filter(F.col("first_known").isNull() & (F.col("second_known").isNull() | (F.length("first") == 1))).select("first", "second").distinct()
    return _best_cuts(odd.withColumn("whole_pair", F.concat("first", "second")), ["first", "second"], "whole_pair", good, 1)


def plain_i(words: DataFrame, known: DataFrame) -> DataFrame:
    """(word, fixed): words with a dotted capital İ that are unknown as they are and known with a plain I; known(word, n) in small letters."""
    dotted = words.select("word").distinct().filter(F.col("word").contains("İ")).withColumn("fixed", F.replace("word", F.lit("İ"), F.lit("I")))
    dotted = dotted.withColumn("low", F.lower("fixed")).withColumn("as_it_is", F.lower(F.replace("word", F.lit("İ"), F.lit("i"))))
    hit = dotted.join(known.select(F.col("word").alias("low")).distinct(), "low", "left_semi")
    # a word that is known with i too is that word
    same = F.col("low") == F.col("as_it_is")
    return hit.join(known.select(F.col("word").alias("as_it_is")).distinct().withColumn("k", F.lit(True)), "as_it_is", "left").filter(same | F.col("k").isNull()).select("word", "fixed")


def replace_words(df: DataFrame, fixes: DataFrame, book: list[str], text: str = "text") -> DataFrame:
    """The texts with whole runs of letters replaced by the book's fixes(book, word, fixed), one for each word.

    Words meet the fixes in a join; a text gets the fixes of its own words only.
    """
    sign, own_fixes = fresh(df, "text_sign", "word_fixes")
    signed = df.withColumn(sign, _signature(*[F.col(f"`{k}`") for k in book], F.col(text)))
    letters = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit("([A-Za-z]+)"), F.lit(1)))
    words = signed.select(*[F.col(f"`{k}`") for k in book], sign, F.explode(letters).alias("word"))
    met = same_keys(words, sent_if_small(fixes.select(*book, "word", "fixed")), [*book, "word"]).select(sign, "word", "fixed").distinct()
    found = kept(met.groupBy(sign).agg(F.map_from_entries(F.collect_list(F.struct("word", "fixed"))).alias(own_fixes)), "fixes")
    joined = signed.join(sent_if_small(found), sign, "left")
    parts = F.split(F.col(text), r"(?<=[A-Za-z])(?![A-Za-z])|(?<![A-Za-z])(?=[A-Za-z])")
    fixed = F.array_join(F.transform(parts, lambda p: F.coalesce(F.col(own_fixes)[p], p)), "")
    return joined.select(*[F.when(F.col(own_fixes).isNull(), F.col(f"`{c}`")).otherwise(fixed).alias(c) if c == text else F.col(f"`{c}`") for c in df.columns])


