"""Source divergence audit: how far the sources of a language are from each other and from the language as a whole, term by term.

p(group, term) = 1 + floor(10^9 (count + 2) / (N + 2 V)): the smoothed share of a term among the N occurrences of the language's V kept terms, as a
whole number. f = floor((p - q)^2 / (p + q)) is what a term adds to the distance of two shares. All arithmetic is exact.

1. Terms are cut out of the UTF-8 bytes of whole texts. A task sums occurrences and documents by (lang, source, term) before anything moves, so a
   frequent term or a hot source costs a row for each task. A language keeps the terms that enough of its documents hold.
2. The kept terms of a language are dealt by hash into blocks of some thousand, its sources into blocks of 32. A tile is a source block by a term
   block; its occurrences stand in one row, and it is made dense (numpy int64, zeros included) where it is used.
3. `pair`: tiles of two source blocks meet by (language, term block). All pairs of their sources are computed by broadcasting, and each pair of tiles
   gives one matrix of partial sums, which are added up by pair of sources.
4. `term`: a tile beside the language's own row gives each source's best terms (a heap of at most 10 for each tile); the heaps are merged by group.

The rows of `pair` are the result's own size, sources squared; the work is that times the terms. No task holds more than two tiles.

Edge cases: null text, lang or source is ''. A group without terms has rows of its own; its shares are all the smoothing's. A language without kept
terms has values 0, ranked by name; one with a single source has no pairs. Repeated rows are documents of their own. Ties go to the smaller item in
the order of UTF-8 bytes. Counts are summed as longs; shares are computed by long division, so any count below 9 x 10^15 is exact. An empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import LOWER, discard, pieces, sent_if_small, small_batches, staged

#: Sources and terms of a tile, about.
SOURCES, TERMS = 32, 2048
#: Distinct (group, term) sums that a task holds before it gives them out, and bytes of text that are cut at a time.
HELD, PIECE = 400_000, 1 << 22

INSIDE = np.zeros(256, bool)
INSIDE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def terms(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of each row, one after the other, A-Z lower-cased; and the row of each."""
    inside = INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True  # a term ends with its row
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    offsets = np.concatenate([[0], np.cumsum(stop - start)]).astype(np.int64)
    low = LOWER[data[inside]]
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(low)), np.searchsorted(at, start, "right") - 1


def _counted(batches):
    """(lang, source, text) to (lang, source, term, n, docs), summed within the task; a group's own row has no term."""
    names, kinds = ["lang", "source", "term", "n", "docs"], [pa.large_string()] * 3 + [pa.int64()] * 2
    schema = pa.schema([pa.field(*x) for x in zip(names, kinds, strict=True)])
    out = pa.schema([pa.field(n, pa.string() if n in names[:3] else pa.int64()) for n in names])
    held = schema.empty_table()
    groups: set[tuple[str, str]] = set()

    def summed(table: pa.Table) -> pa.Table:
        grouped = table.group_by(names[:3]).aggregate([("n", "sum"), ("docs", "sum")])
        return grouped.select([*names[:3], "n_sum", "docs_sum"]).rename_columns(names).cast(schema)

    for b in batches:
        lang, source = (b.column(j).cast(pa.large_string()) for j in (0, 1))
        for first, data, at in pieces(b.column(2), PIECE):
            found, row = terms(data, at)
            coded = found.dictionary_encode()
            width = max(1, len(coded.dictionary))
            cell, n = np.unique(row * width + coded.indices.to_numpy(), return_counts=True)
            rows = pa.array(first + cell // width)
            part = pa.table([lang.take(rows), source.take(rows), coded.dictionary.take(pa.array(cell % width)), pa.array(n), pa.array(np.ones(len(n), np.int64))], schema=schema)
            held = pa.concat_tables([held, summed(part)])
            if held.num_rows >= HELD:
                held = summed(held)
            if held.num_rows >= HELD:
                yield from held.cast(out).combine_chunks().to_batches(max_chunksize=1 << 16)
                held = schema.empty_table()
        seen = set(zip(lang.to_pylist(), source.to_pylist(), strict=True)) - groups
        groups |= seen
        if seen:
            both = [pa.array([g[j] for g in seen], pa.string()) for j in (0, 1)]
            zero = pa.array(np.zeros(len(seen), np.int64))
            yield pa.RecordBatch.from_arrays([*both, pa.nulls(len(seen), pa.string()), zero, zero], schema=out)
    yield from summed(held).cast(out).combine_chunks().to_batches(max_chunksize=1 << 16)


def shares(count: np.ndarray, n: np.ndarray, v: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (n + 2 v)) by long division in three steps, so that no product leaves int64."""
    below = (n + 2 * v)[..., None] if np.ndim(n) else np.int64(n + 2 * v)
    p, rest = np.divmod(count + 2, below)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        p = p * 1000 + digit
    return p + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)), element by element."""
    gap = p - q
    return gap * gap // (p + q)


def _lists(col: pa.Array):
    """k to the (i, at, n) arrays of a tile's cells, without a Python object for each."""
    at, flat = np.concatenate([[0], np.cumsum(col.value_lengths().fill_null(0).to_numpy())]), col.flatten()
    fields = [flat.field(j).to_numpy(zero_copy_only=False) for j in range(3)]
    return lambda k: [f[at[k] : at[k + 1]] for f in fields]


def _tile(cells, totals: list[int], v: int, width: int) -> np.ndarray:
    """The shares of a source block in a term block, where most counts may be zero."""
    count = np.zeros((len(totals), width), np.int64)
    count[cells[0], cells[1]] = cells[2]
    return shares(count, np.array(totals, np.int64), v)


_TRIPLES = pa.list_(pa.struct([("i", pa.int32()), ("j", pa.int32()), ("value", pa.int64())]))


def _triples(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x[0]) for x in found])]).astype(np.int32)
    join = lambda j, kind: pa.array(np.concatenate([x[j] for x in found]) if found else np.zeros(0), kind)
    flat = pa.StructArray.from_arrays([join(0, pa.int32()), join(1, pa.int32()), join(2, pa.int64())], ["i", "j", "value"])
    return pa.ListArray.from_arrays(pa.array(ends), flat).cast(_TRIPLES)


def _pair_sums():
    @F.arrow_udf("array<struct<i:int,j:int,value:long>>")
    def pairs(a: pa.Array, a_totals: pa.Array, b: pa.Array, b_totals: pa.Array, v: pa.Array, width: pa.Array, same: pa.Array) -> pa.Array:
        """The partial sums of all pairs of sources of two tiles; of a tile with itself each pair once."""
        out, of_a, of_b = [], _lists(a), _lists(b)
        for k, (na, nb, kept, wide, own) in enumerate(zip(a_totals.to_pylist(), b_totals.to_pylist(), v.to_pylist(), width.to_pylist(), same.to_pylist(), strict=True)):
            left = _tile(of_a(k), na, kept, wide)
            right = left if own else _tile(of_b(k), nb, kept, wide)
            sums = np.stack([apart(row[None], right).sum(1) for row in left])
            i, j = np.triu_indices(len(left), 1) if own else (x.ravel() for x in np.indices(sums.shape))
            out.append((i, j, sums[i, j]))
        return _triples(out)

    return pairs


def _heaps(most: int):
    @F.arrow_udf("array<struct<i:int,j:int,value:long>>")
    def heaps(cells: pa.Array, totals: pa.Array, whole: pa.Array, n: pa.Array, v: pa.Array, width: pa.Array) -> pa.Array:
        """Of each source i of a tile the terms j, more frequent there than in the language, that add most."""
        out, own = [], _lists(cells)
        for k, (of, every, sum_, kept, wide) in enumerate(zip(totals.to_pylist(), whole.to_pylist(), n.to_pylist(), v.to_pylist(), width.to_pylist(), strict=True)):
            p, present = _tile(own(k), of, kept, wide), np.zeros((len(of), wide), bool)
            present[own(k)[0], own(k)[1]] = True
            q = shares(np.array(every, np.int64), np.int64(sum_), kept)
            value, top = apart(p, q[None]), []
            for i in range(len(p)):
                good = np.flatnonzero(present[i] & (p[i] > q))
                top.append(good[np.argsort(-value[i, good], kind="stable")[:most]])  # places of a block ascend with their terms
            i, j = np.repeat(np.arange(len(p)), [len(t) for t in top]), np.concatenate(top)
            out.append((i, j, value[i, j]))
        return _triples(out)

    return heaps


def _dealt(df: DataFrame, name: str, per_block: int) -> DataFrame:
    """df(lang, name, ...) with block, at (the place by name within the block) and the language's number of blocks."""
    count = df.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / per_block).cast("int").alias("blocks"), F.count(F.lit(1)).alias("size"))
    dealt = df.join(sent_if_small(count), "lang").withColumn("block", F.when(F.col("size") <= per_block, 0).otherwise(F.pmod(F.xxhash64(name), F.col("blocks"))).cast("int"))
    return dealt.withColumn("at", F.row_number().over(Window.partitionBy("lang", "block").orderBy(name)) - 1).drop("blocks", "size")


def audit(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 10, best: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: each group's distance to every other source of its language (`pair`) and its `best` most telling terms (`term`)."""
    small_batches()
    docs = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    counted = staged(docs.mapInArrow(_counted, "lang string, source string, term string, n long, docs long").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    whole = counted.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least_docs)
    kept = staged(_dealt(whole.select("lang", "term", "n"), "term", TERMS), "terms")
    found = counted.filter("term IS NOT NULL").select("lang", "source", "term", F.col("n").alias("count")).join(sent_if_small(kept.select("lang", "term", "block", "at")), ["lang", "term"])
    total = found.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = counted.filter("term IS NULL").select("lang", "source").join(total, ["lang", "source"], "left").fillna({"total": 0})
    groups = staged(_dealt(groups, "source", SOURCES).withColumnsRenamed({"block": "sources", "at": "i"}), "groups")

    # a row for each tile, also for those without occurrences; a language without kept terms has one empty term block
    by_at = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("at", c))), lambda x: x[c])
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("occurrences"))
    columns = kept.groupBy("lang", "block").agg(by_at("n").alias("whole"))
    rows = groups.groupBy("lang", "sources").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "total"))), lambda x: x["total"]).alias("totals"))
    grid = rows.join(columns, "lang", "left").join(langs, "lang", "left").withColumns({"block": F.coalesce("block", F.lit(0)), "v": F.coalesce("v", F.lit(0)), "width": F.greatest(F.coalesce(F.size("whole"), F.lit(0)), F.lit(0))})
    placed = found.join(sent_if_small(groups.select("lang", "source", "sources", "i")), ["lang", "source"])
    cells = placed.groupBy("lang", "sources", "block").agg(F.collect_list(F.struct("i", "at", F.col("count").alias("n"))).alias("cells"))
    tiles = staged(grid.join(cells, ["lang", "sources", "block"], "left"), "tiles")
    discard(counted)

    left = tiles.select("lang", "block", "sources", "cells", "totals", "v", "width")
    right = tiles.select("lang", "block", *[F.col(c).alias(f"{c}_b") for c in ("sources", "cells", "totals")])
    met = left.join(right, ["lang", "block"]).filter("sources <= sources_b")
    partial = met.select("lang", "sources", "sources_b", F.explode(_pair_sums()("cells", "totals", "cells_b", "totals_b", "v", "width", F.col("sources") == F.col("sources_b"))).alias("x"))
    sums = staged(partial.select("lang", "sources", "sources_b", "x.*").groupBy("lang", "sources", "i", "sources_b", "j").agg(F.sum("value").alias("value")), "sums")
    name = lambda s, i, c: sent_if_small(groups.select("lang", F.col("sources").alias(s), F.col("i").alias(i), F.col("source").alias(c)))
    named = sums.join(name("sources", "i", "a"), ["lang", "sources", "i"]).join(name("sources_b", "j", "b"), ["lang", "sources_b", "j"])
    pair = named.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("x"), "value")
    pair = pair.select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")

    heaps = tiles.filter("cells IS NOT NULL").select("lang", "sources", "block", F.explode(_heaps(best)("cells", "totals", "whole", "occurrences", "v", "width")).alias("x")).select("lang", "sources", "block", "x.i", F.col("x.j").alias("at"), "x.value")
    term = heaps.join(kept.select("lang", "block", "at", F.col("term").alias("item")), ["lang", "block", "at"]).join(name("sources", "i", "source"), ["lang", "sources", "i"])
    term = term.select("lang", "source", F.lit("term").alias("part"), "item", "value")

    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = lambda d: d.withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked(pair).unionByName(ranked(term).filter(F.col("rank") <= best))
