"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of tokens: lower-cased runs of letters, marks and digits of any script (by Unicode's classes), with typed placeholders
for numbers, for units after a number, and for names (title-case words of any script that has capitals; neighbours in a sentence make one name, a
sentence's first word may be one). Windows of WINDOW tokens are
hashed; benchmark windows are joined by hash with those of every whole document.

An occurrence of an item is a stretch of a document: windows of the item on diagonals (distances between the two places) that lie within
NEAR tokens or half the item of each other, so that words may be put in or left out, but pieces scattered over a text do not add up. Its
slots (placeholders) must be consistent, as when a question is re-told with other numbers, names or units: each value of the item maps to
one value in the document, and each name or unit of the document to one of the item (two numbers may become equal by chance). A document
holds an item if one consistent occurrence covers at least `coverage` of the item's windows.

Templates need LEAST literal words a window. So that copies of any item are found, also of sums and lists of names, all texts are windowed a
second time by their literal tokens, without placeholders; a document also holds an item if these cover at least `coverage` of it.

The benchmark's distinct window hashes go to all tasks if they are at most MOST_SENT; otherwise all documents' windows are shuffled and
joined. Both ways give the same rows. A document that holds `need` of an item's n windows holds one of any n - need + 1 of them: candidates
are met by the windows that fewest items share, so that a phrase of many items brings no pairs by itself; only then are all windows of a
candidate pair joined, by document and hash.

Edge cases: null and empty texts, on either side, match nothing; an item of fewer than WINDOW tokens is one window, and one of fewer than
LEAST tokens, or whose windows all hold fewer than LEAST literal words, is looked for literally only, be it a single word; an item without
letters and digits cannot be found. Punctuation and spaces of any kind (typographic quotes, dashes, no-break spaces), signs without width (soft
hyphens) and small or capital letters make no difference to literal windows; composed and decomposed accents are not alike. Rows sharing a doc_id
count as one document; texts sharing an item_id are looked for one by one and reported as one item; a document without id cannot be reported
and is kept by `clean`. Repeated rows count once. Empty tables give no rows.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import mix, pieces, sent_if_small, small_batches, staged, word_hashes

WINDOW = 8
LEAST = 4
#: Added to a window's size in the hash of literal ones, which templates never meet.
LITERAL = 1000
#: Hashes that are sent to all tasks (8 bytes each), and index rows that are (some 100 bytes each).
MOST_SENT, MOST_ROWS = 4_000_000, 200_000
#: Tokens by which the windows of one occurrence may be shifted against each other; half of a longer item's windows.
NEAR = 8
#: Bytes of text that are cut into tokens at a time (one text at least).
PIECE = 1 << 18
#: Units that stand after a number.
UNITS = "mm cm m km in ft yd mi mg g kg t lb oz ml cl l gal s sec min h hr hrs day days week weeks month months year years second seconds minute minutes hour hours meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms liter liters litre litres inch inches foot feet yard yards mile miles pound pounds ounce ounces dollar dollars euro euros cent cents eur usd gbp kmh mph percent degrees".split()

_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (0x1111, 0x2222, 0x3333))
_INSIDE, _DIGIT, _CAPITAL, _STOP, _GONE = (np.uint8(1 << i) for i in range(5))
#: Code points with a class and a small letter of their own; above them are ideographs up to 0x3FFFF, and signs that are no letters.
_CLASSED = 0x20000


@functools.cache
def _classes() -> tuple[np.ndarray, np.ndarray]:
    """The class of each code point as bits, and its small letter."""
    kind, small = np.zeros(_CLASSED, np.uint8), np.arange(_CLASSED, dtype=np.uint32)
    for c in range(_CLASSED):
        name = unicodedata.category(chr(c))
        if name[0] in "LNM":
            kind[c] = _INSIDE | (_DIGIT if name == "Nd" else 0) | (_CAPITAL if name in ("Lu", "Lt") else 0)
        elif name == "Cf":
            kind[c] = _GONE
        if name in ("Lu", "Lt") and len(chr(c).lower()) == 1:
            small[c] = ord(chr(c).lower())
    for stop in "\n!.?\u061f\u0964\u3002\uff01\uff1f":
        kind[ord(stop)] |= _STOP
    return kind, small


def signs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 as code points, without signs that have no width; and where the rows begin and end."""
    begins = (data & 0xC0) != 0x80
    lead = data[begins].astype(np.uint32)
    place = np.flatnonzero(begins)
    many = (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
    point = np.where(many == 0, lead, lead & (0x3F >> many).astype(np.uint32))
    for j in range(1, 4):
        more = np.flatnonzero(many >= j)
        point[more] = (point[more] << 6) | (data[np.minimum(place[more] + j, len(data) - 1)] & 0x3F)
    at = np.searchsorted(place, at)
    stays = ~_is(point, _GONE)
    return point[stays], np.concatenate([[0], np.cumsum(stays)])[at]


def _is(point: np.ndarray, kind: np.uint8) -> np.ndarray:
    table = _classes()[0]
    out = (table[np.minimum(point, _CLASSED - 1)] & kind) > 0
    above = point >= _CLASSED
    if above.any():
        out[above] = (point[above] < 0x40000) & (kind == _INSIDE)
    return out


def _small(point: np.ndarray) -> np.ndarray:
    return np.where(point < _CLASSED, _classes()[1][np.minimum(point, _CLASSED - 1)], point)


def _literal(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return word_hashes(data, np.array([0]), np.array([len(data)]))[0]


_UNIT_HASHES = np.sort(np.array([_literal(u) for u in UNITS], np.uint64))


def member(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which x are in the sorted table; a bitmap of hash bits spares most of the search."""
    if not len(table):
        return np.zeros(len(x), bool)
    bits = np.zeros(1 << 20, bool)
    bits[table & np.uint64((1 << 20) - 1)] = True
    out = bits[x & np.uint64((1 << 20) - 1)]
    maybe = np.flatnonzero(out)
    at = np.minimum(np.searchsorted(table, x[maybe]), len(table) - 1)
    out[maybe] = table[at] == x[maybe]
    return out


def template(point: np.ndarray, at: np.ndarray):
    """Of code points token hashes with placeholders, whether each is a placeholder, start, end and row of each token; and the same of the literal tokens."""
    empty = np.zeros(0, np.int64)
    if not len(point):
        return [(empty.astype(np.uint64), empty.astype(bool), empty, empty, empty)] * 2
    digit = _is(point, _DIGIT)
    inside = _is(point, _INSIDE)
    joins = np.zeros(len(point), bool)  # 3.5 and 1,000 are one number
    joins[1:-1] = ((point[1:-1] == 46) | (point[1:-1] == 44)) & digit[:-2] & digit[2:]
    inside |= joins
    edge = np.zeros(len(point) + 1, bool)
    edge[at] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.searchsorted(at, start, "right") - 1
    low = _small(point)
    capital = _is(point, _CAPITAL)
    stops = np.concatenate([[0], np.cumsum(_is(point, _STOP) & ~joins, dtype=np.int32)])
    first = np.ones(len(start), bool)  # of a sentence
    first[1:] = (row[1:] != row[:-1]) | (stops[start[1:]] > stops[end[:-1]])
    upper = np.concatenate([[0], np.cumsum(capital, dtype=np.int32)])
    number = digit[start]
    name = capital[start] & (upper[end] - upper[start] == 1) & (end - start > 1) & ~number
    go_on = np.zeros(len(start), bool)
    go_on[1:] = name[1:] & name[:-1] & ~first[1:]
    plain = word_hashes(low, start, end), np.zeros(len(start), bool), start, end, row
    keep = np.flatnonzero(~go_on)
    end = end[np.concatenate([keep[1:], [len(end)]]) - 1] if len(keep) else end
    start, row, number, name = start[keep], row[keep], number[keep], name[keep]
    token = word_hashes(low, start, end) if go_on.any() else plain[0].copy()
    unit = np.zeros(len(start), bool)
    unit[1:] = number[:-1] & (row[1:] == row[:-1])
    unit[unit] = member(token[unit], _UNIT_HASHES)
    token[number], token[name], token[unit] = _NUMBER, _NAME, _UNIT
    return (token, number | name | unit, start, end, row), plain


def windows(token: np.ndarray, slot: np.ndarray, row: np.ndarray, n: int, size: int, whole: bool = False, literally: bool = False):
    """Hash and first token of each window of `size` tokens in a row; whole: only of rows that have just so many tokens."""
    count = np.bincount(row, minlength=n)
    first = np.cumsum(count) - count
    ok = np.arange(len(token)) - first[row] <= count[row] - size if len(token) else np.zeros(0, bool)
    if whole:
        ok &= count[row] == size
    begin = np.flatnonzero(ok)
    if not literally:
        literal = np.concatenate([[0], np.cumsum(~slot)])
        begin = begin[literal[begin + size] - literal[begin] >= LEAST]
    h = np.full(len(begin), size + (LITERAL if literally else 0), np.uint64)
    for j in range(size):
        h = mix(h * np.uint64(0x9FB21C651E98DF25) + token[begin + j])
    return h, begin


def _emit(size_of, keep):
    """(id, text) batches to (id, first token's place, hash, slots, size, literally); size_of: (size, whether whole short texts only, literally)."""
    schema = pa.schema([("id", pa.int64()), ("place", pa.int32()), ("hash", pa.int64()), ("slots", pa.list_(pa.string())), ("size", pa.int32()), ("literally", pa.bool_())])

    def emit(batches):
        for b in batches:
            ids = b.column(0)
            for lead, data, at in pieces(b.column(1), PIECE):
                n = len(at) - 1
                point, at = signs(data, at)
                for literally, (token, slot, start, end, row) in enumerate(template(point, at)):
                    count = np.bincount(row, minlength=n)
                    first = np.cumsum(count) - count
                    for size, whole in [(size, whole) for size, whole, how in size_of if how == literally]:
                        h, begin = windows(token, slot, row, n, size, whole, bool(literally))
                        if keep is not None:
                            hit = member(h, keep)
                            h, begin = h[hit], begin[hit]
                        if not len(h):
                            continue
                        values = [[]] * len(begin) if literally else [[" ".join("".join(map(chr, point[start[i] : end[i]].tolist())).split()) for i in range(g, g + size) if slot[i]] for g in begin.tolist()]
                        r = row[begin]
                        yield pa.RecordBatch.from_arrays([ids.take(pa.array(r + lead)), pa.array((begin - first[r]).astype(np.int32)), pa.array(h.view(np.int64)), pa.array(values, pa.list_(pa.string())), pa.array(np.full(len(h), size, np.int32)), pa.array(np.full(len(h), bool(literally)))], schema=schema)

    return emit


SCHEMA = "id long, place int, hash long, slots array<string>, size int, literally boolean"


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", coverage: float = 0.5, consistency: float = 0.8) -> DataFrame:
    """One row for each document and item it holds: key, item_key, windows (of the item found), coverage, slots and slots_kept (consistent)."""
    small_batches()
    # texts under one item_key are items of their own until the end
    name, words = F.col(item_key).cast("long"), F.col(item_text)
    items = staged(benchmark.filter(name.isNotNull()).select(F.xxhash64(name, words).alias("id"), name.alias("name"), words.alias("text")).distinct(), "texts")
    sizes = [(WINDOW, False, False), *((s, True, False) for s in range(LEAST, WINDOW)), (WINDOW, False, True), *((s, True, True) for s in range(1, WINDOW))]
    index = staged(items.select("id", "text").mapInArrow(_emit(sizes, None), SCHEMA), "items")
    hashes = index.select("hash").distinct()
    looked = [(r["size"], False, r["literally"]) for r in index.select("size", "literally").distinct().collect()]  # short items are looked for anywhere
    docs = docs.filter(F.col(key).isNotNull())
    known = np.sort(hashes.toArrow()["hash"].to_numpy().view(np.uint64)) if hashes.count() <= MOST_SENT else None
    found = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(_emit(looked, known), SCHEMA)
    if known is None:
        found = found.join(hashes, "hash", "left_semi")
    found = staged(found.select("id", "hash", "place", "slots"), "found")

    # any n - need + 1 of an item's windows hold one of `need`: those that fewest items share
    shared = index.groupBy("hash").agg(F.countDistinct("id").alias("items"))
    by_rarity = Window.partitionBy("id", "literally").orderBy("items", "hash", "place")
    of_item = Window.partitionBy("id", "literally")
    index = index.join(shared, "hash").select(F.col("id").alias("item"), F.col("place").alias("item_place"), "hash", "literally", F.col("slots").alias("item_slots"), F.row_number().over(by_rarity).alias("rank"), F.count(F.lit(1)).over(of_item).alias("total"))
    index = staged(index, "index")
    sent = (lambda df: F.broadcast(df)) if index.count() <= MOST_ROWS else (lambda df: df)
    rare = index.filter(F.col("rank") <= F.col("total") - F.ceil(coverage * F.col("total") - 1e-9) + 1)
    candidates = found.select("id", "hash").distinct().join(sent(rare.select("item", "literally", "hash")), "hash").select("id", "item", "literally").distinct()
    met = candidates.join(sent(index.drop("rank")), ["item", "literally"]).join(found, ["id", "hash"])
    near = F.greatest(F.lit(NEAR), F.ceil(F.col("total") / 2)).cast("int")
    # bands twice as wide as what is near, twice: any two near diagonals share one
    bands = F.array(*[F.floor((F.col("place") - F.col("item_place") + i * near) / (2 * near)) * 2 + i for i in (0, 1)])
    met = staged(met.select("id", "item", "literally", "total", "item_place", "item_slots", F.col("slots").alias("doc_slots"), F.explode(bands).alias("band")), "met")

    at = ["id", "item", "literally", "band"]
    # each slot of an occurrence is seen in several windows; it counts in each of them
    pairs = met.select(*at, F.explode(F.arrays_zip("item_slots", "doc_slots")).alias("s")).groupBy(*at, "s").agg(F.count(F.lit(1)).alias("c"))
    ways = F.array(F.struct(F.lit(True).alias("there"), F.col("s.item_slots").alias("v")), F.struct(F.lit(False).alias("there"), F.col("s.doc_slots").alias("v")))
    by_value = pairs.select(*at, "c", F.explode(ways).alias("w")).groupBy(*at, "w").agg(F.sum("c").alias("all"), F.max("c").alias("most"))
    there, back = F.col("w.there"), ~F.col("w.there") & ~F.col("w.v").rlike(r"^\p{Nd}")
    when = lambda cond, x: F.coalesce(F.sum(F.when(cond, x)), F.lit(0))
    kept = by_value.groupBy(*at).agg(when(there, F.col("all")).alias("slots"), when(there, F.col("most")).alias("forth"), when(back, F.col("all") - F.col("most")).alias("lost"))
    kept = kept.select(*at, "slots", F.least("forth", F.col("slots") - F.col("lost")).alias("slots_kept"))
    good = met.join(kept, at, "left").filter(F.col("slots").isNull() | (F.col("slots_kept") >= consistency * F.col("slots")))
    zero = lambda c: F.max(F.coalesce(c, F.lit(0))).alias(c)
    held = good.groupBy(*at, "total").agg(F.countDistinct("item_place").alias("windows"), zero("slots"), zero("slots_kept"))
    held = held.withColumn("coverage", F.col("windows") / F.col("total")).filter(F.col("windows") >= F.ceil(coverage * F.col("total") - 1e-9))
    # found in both ways: the template's figures, of its fullest occurrence
    order = F.struct("literally", (-F.col("coverage")).alias("c"), "band")
    one = held.groupBy("id", "item").agg(F.min_by(F.struct("literally", "windows", "coverage", "slots", "slots_kept"), order).alias("h"))
    named = one.join(items.select(F.col("id").alias("item"), F.col("name").alias("item_name")), "item")
    best = named.groupBy("id", "item_name").agg(F.min_by("h", F.struct("h.literally", (-F.col("h.coverage")).alias("c"), "item")).alias("h"))
    return best.select(F.col("id").alias(key), F.col("item_name").alias(item_key), "h.windows", "h.coverage", "h.slots", "h.slots_kept")


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """The documents that hold no item, with their own columns."""
    found = staged(leaks(docs, benchmark, key=key, **how).select(F.col(key)).distinct(), "leaks")
    return docs.join(sent_if_small(found), key, "left_anti").select(*[f"`{c}`" for c in docs.columns])
