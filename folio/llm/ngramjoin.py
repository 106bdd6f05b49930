"""Exact Jaccard join of n-gram sets: size-banded tiles, hashed bitmap signatures, exact intersection.

1. Every text becomes its sorted array of distinct word shingles (64-bit hashes). Texts with equal sets are one class, standing by its smallest id.
2. Bands: a band holds the sizes from L to floor(100 L / percent), so linked sets lie in one band or in two that adjoin. Two sets whose smaller one lies
   in band b differ in at most D(b) shingles. The shingles are dealt by a hash into P(b) > D(b) parts, so at least one part is the same in both, and a
   set of band b stands in a tile for each part of b and, as the larger partner, of b - 1: the tile's key is band, part, and the part's content.
   Parts are filled for all sets but a few; a set with so many empty parts that a filled one need not agree stands in the tiles of its empty parts too
   (of two such sets both do, and if one is not such a set, its filled parts suffice). So no linked pair is missed, and a tile holds near copies,
   whatever words, lines or passages are frequent.
3. A tile of two classes is a candidate; of a larger one each class is paired with the smallest. Candidates are bounded from above by their
   signatures: a set's bitmap holds the parity of its shingles at each place of a hash, so the bits that differ between two bitmaps count at most the
   shingles in which the sets differ, and overlap <= (sizes - differing bits) / 2. Those that pass are intersected exactly as sorted arrays.
4. Components are found by stars (graph.py). A tile whose classes then still lie in several components is compared whole, in blocks of BLOCK: bitmaps of
   the classes outside its largest component against all of its others (tiles of the same classes count once). Pairs that pass the bound are intersected
   exactly; a pair of blocks in which many pass is intersected where it is, so that pairs never outnumber rows by much.

So each pair that links is tested exactly or lies in one component; all groups are bounded; nothing goes to the driver.

Edge cases: a null or wordless text has an empty set and links to nothing; fewer words than a shingle are one shingle. Rows sharing an id
are one node. A row without an id links to nothing and has no component. Repeated rows are returned as often as given. An empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import discard, mix, pieces, sent_if_small, small_batches, staged
from folio.llm.graph import components
from folio.llm.neardup import shingle_sets

#: Classes of a tile that are compared with others at a time, and survivors a row from which on a pair of blocks is intersected in place.
BLOCK, MANY = 1024, 4
#: Bits of a signature: at least BITS a shingle, a power of two, at most so many.
BITS, MOST_BITS = 4, 1 << 17


def bands(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The smallest size of each band, and its D and P; D = 0 means that only equal sets link."""
    low = [1]
    while low[-1] < 1 << 40:
        low.append(100 * low[-1] // percent + 1)
    largest = np.array(low[1:], np.int64) - 1
    differ = (100 - percent) * (100 * largest // percent) // 100
    return np.array(low[:-1], np.int64), differ, np.where(differ > 0, differ + 2 + differ // 64, 0)


def slices(values: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of the tiles of each set, one set after the other, and their n + 1 bounds."""
    low, differ, parts = bands(percent)
    size = np.diff(bounds)
    own = np.searchsorted(low, size, "right") - 1
    keys, owner = [], []
    for band in (own, own - 1):
        p = np.where((size > 0) & (band >= 0), parts[np.maximum(band, 0)], 0)
        base = np.concatenate([[0], np.cumsum(p)])
        row = np.repeat(np.arange(len(size)), size)
        used = p[row] > 0
        v, row = values[used], row[used]
        salt = mix((band[row].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        place = base[row] + (mix(v ^ salt) % p[row].astype(np.uint64)).astype(np.int64)
        h = mix(v + np.uint64(0x2545F4914F6CDD1D))
        halves = [np.bincount(place, weights=x.astype(float), minlength=base[-1]).astype(np.int64).view(np.uint64) for x in (h & np.uint64(0xFFFFFFFF), h >> np.uint64(32))]
        filled = np.bincount(place, minlength=base[-1]) > 0
        of = np.repeat(np.arange(len(size)), p)
        n_filled = np.bincount(of[filled], minlength=len(size))
        odd = n_filled <= differ[np.maximum(band, 0)]  # a filled part need not agree
        part = (np.arange(base[-1]) - base[of]).astype(np.uint64)
        name = mix(mix(band[of].astype(np.uint64) + np.uint64(7)) + part)
        key = mix((halves[0] + (halves[1] << np.uint64(32))) ^ name)
        keep = filled | odd[of]
        keys.append(key[keep])
        owner.append(of[keep])
    keys, owner = np.concatenate(keys), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return keys[order], np.searchsorted(owner[order], np.arange(len(size) + 1))


def signature(values: np.ndarray) -> np.ndarray:
    """The parity of the shingles at each place, as words of 64 bits."""
    bits = 64
    while bits < min(BITS * len(values), MOST_BITS):
        bits *= 2
    place = (mix(values ^ np.uint64(0xA24BAED4963EE407)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(np.uint8), bitorder="little").view(np.uint64)


def folded(words: np.ndarray, n: int) -> np.ndarray:
    """A signature as one of n words: places are taken modulo."""
    return np.bitwise_xor.reduce(words.reshape(-1, n), axis=0) if len(words) > n else words


def enough(a: int | np.ndarray, b: int | np.ndarray, shared: int | np.ndarray, percent: int):
    return 100 * shared >= percent * (a + b - shared)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Values that two sorted arrays of distinct values share."""
    merged = np.concatenate([a, b])
    merged.sort(kind="stable")
    return int((merged[1:] == merged[:-1]).sum())


def _shapes(k: int, percent: int):
    @F.arrow_udf("n long, f1 long, f2 long, tiles array<long>")
    def shape(texts: pa.Array) -> pa.Array:
        n, f1, f2, tiles, ends = [], [], [], [], [np.zeros(1, np.int64)]
        for _, data, at in pieces(texts):
            values, bounds = shingle_sets(data, at, k)
            sums = np.zeros((2, len(values) + 1), np.uint64)
            np.cumsum(mix(values), out=sums[0, 1:])
            np.cumsum(mix(values ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1, 1:])
            keys, cut = slices(values, bounds, percent)
            n.append(np.diff(bounds))
            f1.append((sums[0, bounds[1:]] - sums[0, bounds[:-1]]).view(np.int64))
            f2.append((sums[1, bounds[1:]] - sums[1, bounds[:-1]]).view(np.int64))
            tiles.append(keys.view(np.int64))
            ends.append(cut[1:] + ends[-1][-1])
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(join(ends).astype(np.int32)), pa.array(join(tiles), pa.int64()))
        return pa.StructArray.from_arrays([*[pa.array(join(x), pa.int64()) for x in (n, f1, f2)], lists], ["n", "f1", "f2", "tiles"])

    return shape


def _sets(k: int):
    @F.arrow_udf("n long, bits binary, shingles binary")
    def sets(texts: pa.Array) -> pa.Array:
        n, bits, values_ = [], [], []
        for _, data, at in pieces(texts):
            values, bounds = shingle_sets(data, at, k)
            for i in range(len(at) - 1):
                own = values[bounds[i] : bounds[i + 1]]
                n.append(len(own))
                bits.append(signature(own).tobytes())
                values_.append(own.tobytes())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(bits, pa.binary()), pa.array(values_, pa.binary())], ["n", "bits", "shingles"])

    return sets


def _linked(percent: int):
    @F.arrow_udf("boolean")
    def linked(n: pa.Array, bits: pa.Array, shingles: pa.Array, m: pa.Array, other_bits: pa.Array, others: pa.Array) -> pa.Array:
        out = []
        for i, (a, b) in enumerate(zip(n.to_pylist(), m.to_pylist(), strict=True)):
            x, y = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (bits, other_bits))
            least = min(len(x), len(y))
            differ = int(np.bitwise_count(folded(x, least) ^ folded(y, least)).sum())
            good = enough(a, b, min((a + b - differ) // 2, a, b), percent)
            out.append(bool(good) and bool(enough(a, b, overlap(*(np.frombuffer(c[i].as_buffer(), np.uint64) for c in (shingles, others))), percent)))
        return pa.array(out, pa.bool_())

    return linked


def _matrix(rows: pa.Table, n: int) -> np.ndarray:
    return np.stack([folded(np.frombuffer(b.as_buffer(), np.uint64), n) for b in rows["bits"]])


def _survivors(percent: int):
    """Pairs of blocks to the pairs (a, b) of different components that pass the bound; if they are many, to the blocks' own key."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("tile", pa.int64()), ("qb", pa.int32()), ("mb", pa.int32())])

    def survivors(key, queries: pa.Table, members: pa.Table) -> pa.Table:
        if not queries.num_rows or not members.num_rows:
            return schema.empty_table()
        words = min(len(b.as_buffer()) for t in (queries, members) for b in t["bits"]) // 8
        q, m = _matrix(queries, words), _matrix(members, words)
        n, ids, comp = (members[c].to_numpy() for c in ("n", "id", "comp"))
        found, count = [], 0
        for bits, size, own, of in zip(q, *(queries[c].to_numpy() for c in ("n", "id", "comp")), strict=True):
            shared = np.minimum((size + n - np.bitwise_count(m ^ bits).sum(1, dtype=np.int64)) // 2, np.minimum(size, n))
            hit = np.flatnonzero((comp != of) & enough(size, n, shared, percent))
            found.append((np.full(len(hit), own), ids[hit]))
            count += len(hit)
            if count > MANY * (len(q) + len(m)):
                return pa.table([pa.nulls(1, pa.int64())] * 2 + [pa.array([k.as_py()], f.type) for k, f in zip(key, list(schema)[2:], strict=True)], schema=schema)
        a, b = (np.concatenate([f[j] for f in found]) for j in (0, 1))
        return pa.table([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), *[pa.nulls(len(a), f.type) for f in list(schema)[2:]]], schema=schema)

    return survivors


def _block_links(percent: int):
    """Pairs of blocks to exact links, one for each query and other component."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(queries: pa.Table, members: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and members.num_rows:
            sets = [np.frombuffer(b.as_buffer(), np.uint64) for b in members["shingles"]]
            size, ids, comp = np.array([len(s) for s in sets]), members["id"].to_numpy(), members["comp"].to_numpy()
            flat = np.concatenate(sets)
            order = np.argsort(flat, kind="stable")
            token, owner = flat[order], np.repeat(np.arange(len(size)), size)[order]
            for x, of, own in zip(queries["id"].to_pylist(), queries["comp"].to_pylist(), queries["shingles"], strict=True):
                own = np.frombuffer(own.as_buffer(), np.uint64)
                low = np.searchsorted(token, own, "left")
                n = np.searchsorted(token, own, "right") - low
                shared = np.bincount(owner[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())], minlength=len(size))
                hit = np.flatnonzero(enough(len(own), size, shared, percent) & (comp != of))
                out += [(x, int(ids[i])) for i in hit[np.unique(comp[hit], return_index=True)[1]]]
        return pa.table([pa.array([p[j] for p in out], pa.int64()) for j in (0, 1)], schema=schema)

    return links


def tile_links(mixed: DataFrame, sets: DataFrame, percent: int, confirm, written: list[DataFrame]) -> DataFrame:
    """(a, b): the links between different components of tiles; mixed(tile, id, comp, major, members, minors). What is staged is added to `written`."""
    count = lambda n: F.ceil(n / BLOCK).cast("int")
    blocks = lambda n: F.explode(F.sequence(F.lit(0), count(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), count(n)).cast("int")
    queries = mixed.filter("comp <> major").select("tile", "id", "comp", own(F.col("minors")).alias("qb"), blocks(F.col("members")).alias("mb"))
    members = mixed.select("tile", "id", "comp", own(F.col("members")).alias("mb"), blocks(F.col("minors")).alias("qb"))
    keys = ["tile", "qb", "mb"]

    def met(column: str, f, result: str, within: DataFrame | None = None) -> DataFrame:
        sides = []
        for x in (queries, members):
            x = x if within is None else x.join(within, keys)
            x = x.join(sets.select("id", "n", column), "id").select(*keys, "id", "comp", "n", column)
            sides.append(x.toDF(*x.columns).groupBy(*keys))  # toDF: columns of its own, though both come from one table
        return sides[0].cogroup(sides[1]).applyInArrow(f, result)

    passed = staged(met("bits", _survivors(percent), "a long, b long, tile long, qb int, mb int"), "passed")
    crowded = sent_if_small(passed.filter("a IS NULL").select(*keys))
    written.append(passed)
    return confirm(passed.filter("a IS NOT NULL").select("a", "b").distinct()).unionByName(met("shingles", _block_links(percent), "a long, b long", crowded))


def similar_sets(df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 3, percent: int = 90) -> DataFrame:
    """One row per input row: the key, n_shingles, and component_id (smallest id reachable over links).

    Two rows are linked if 100 * (shared shingles) >= percent * (shingles in either).
    """
    small_batches()
    own = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    shapes = staged(own.select("id", _shapes(shingle, percent)(F.col("text")).alias("x")).select("id", "x.*"), "shapes")
    named = shapes.filter("id IS NOT NULL AND n > 0")
    class_of = named.groupBy("n", "f1", "f2").agg(F.min("id").alias("rep"))
    reps = shapes.join(class_of.select(F.col("rep").alias("id"), "n", "f1", "f2"), ["id", "n", "f1", "f2"], "left_semi")
    reps = staged(reps.filter(F.size("tiles") > 0).select("id", "tiles"), "reps")
    placed = reps.select(F.explode("tiles").alias("tile"), "id")
    tiles = staged(placed.groupBy("tile").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b"), "tiles")
    large = sent_if_small(tiles.filter("c > 2").select("tile", "a"))
    live = staged(placed.join(large, "tile").select("tile", "id", "a").distinct(), "live")
    pairs = staged(tiles.select("a", "b").union(live.filter("id <> a").select("a", F.col("id").alias("b"))).distinct(), "pairs")
    involved = staged(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "involved")
    # the sets of the classes that met another, once each
    held = own.join(sent_if_small(involved), "id", "left_semi")
    sets = staged(held.select("id", _sets(shingle)(F.col("text")).alias("s")).select("id", "s.*"), "sets")
    written = [reps, tiles, live, pairs, involved, sets]

    def confirm(some: DataFrame) -> DataFrame:
        a, b = (sets.select(F.col("id").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "bits", "shingles")]) for x in ("a", "b"))
        return some.join(a, "a").join(b, "b").filter(_linked(percent)("n_a", "bits_a", "shingles_a", "n_b", "bits_b", "shingles_b")).select("a", "b")

    # rows of different classes under one id are one node
    same = named.select("id", "n", "f1", "f2").join(class_of, ["n", "f1", "f2"]).filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    ids = named.groupBy("id").agg(F.min("f1").alias("x"), F.max("f1").alias("y")).filter("x <> y").select(F.col("id").alias("a"))
    first = components(confirm(pairs).union(same.join(ids, "a", "left_semi")))
    # tiles that hold several components; of tiles with the same members one
    members = live.join(first, "id", "left").select("tile", "id", F.coalesce("component", "id").alias("comp"))
    sizes = members.groupBy("tile", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("sum"))
    several = sizes.groupBy("tile").agg(F.max_by("comp", F.struct("n", "comp")).alias("major"), F.sum("n").alias("members"), F.max("n").alias("most"), F.sum("sum").alias("sum")).filter("members > most")
    chosen = several.groupBy("members", "sum").agg(F.min(F.struct("tile", "major", (F.col("members") - F.col("most")).alias("minors"))).alias("t")).select("t.*", "members")
    mixed = staged(members.join(sent_if_small(chosen), "tile"), "mixed")
    written.append(mixed)
    star = first.select(F.col("id").alias("a"), F.col("component").alias("b"))
    whole = components(star.union(tile_links(mixed, sets, percent, confirm, written)))
    discard(*written)
    rows = shapes.select("id", "n", "f1", "f2").join(class_of, ["n", "f1", "f2"], "left")
    rows = rows.join(whole.select(F.col("id").alias("rep"), "component"), "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id"))
    return rows.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))
