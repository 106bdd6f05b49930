"""MinHash near-dedup with an LSH forest.

1. Every text becomes its set of distinct word shingles, 64-bit hashes. Its signature is COORDS minimum hashes. Texts with equal sets are one
   class, standing by its smallest id.
2. The forest: tree t orders the classes by the signature read from coordinate 4t on, round and round. Classes whose first four values in a
   tree's order agree form a region. A region of few classes gives its sorted neighbours as candidates, which are all its pairs. A crowded
   region is linked to a pivot and goes deeper, by two more values each time; what is crowded at the last depth is dealt into chunks of
   sorted neighbours. Pivots are the class that shares most regions (in even trees; copies of one text gather around it) or a
   hash's choice (in odd trees), so a crowded region costs as many candidates as it has members, however many.
3. Candidates are confirmed on the whole sets, computed anew from the texts: first the best supported one of each class, then, after
   joining what is linked, those between different components.
4. What then still falls into several components of one crowded region is compared exactly. Two sets that link share one of their rarest
   shingles (n - ceil(0.8 n) + 1 of them, in one order of all shingles). Members of different components that share one held by COMMON members at
   most are confirmed as pairs. Those that share a commoner one, which is all but a copy's text, are compared in blocks of BLOCK: the members
   outside the region's largest component with all of these members. So each pair that any tree brings into one region is either linked, or in
   one component, or cannot link, or is compared; and pages that share a template only are not compared.
   A pair with similarity 0.8 shares no region with probability (1 - 0.8^4)^24, 3 in a million, and more similar ones far less often.
5. Components are found by stars (graph.py), in the shared folder; nothing of it goes to the driver.

Edge cases: a null or wordless text has an empty set and links to nothing; fewer words than a shingle are one shingle. Rows sharing an id
are one node. A row without an id links to nothing, has no component, and is kept. Repeated rows are returned as often as given. An empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import LOWER, discard, mix, pieces, sent_if_small, small_batches, staged, word_hashes, words
from folio.llm.graph import components

TREES, PREFIX = 24, 4
COORDS = TREES * PREFIX
#: A region of so many classes has all its pairs compared; in more crowded ones members are compared with pivots, and the region goes deeper.
FEW = 8
#: Members of a crowded region that are compared with others at a time.
BLOCK = 512
#: A rare shingle that more members of crowded regions hold than this is compared by blocks, others pair by pair.
COMMON = 64
#: Counters of the order of shingles: a table of 2 MB.
COUNTERS = 1 << 19
#: Classes of a region that stays crowded at the last depth are compared along chunks of about this size.
CHUNK = 256

_rng = np.random.default_rng(5)
_TIMES = _rng.integers(0, 1 << 63, COORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _rng.integers(0, 1 << 63, COORDS, np.uint64)


def shingle_sets(data: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one after the other, and their n + 1 bounds."""
    start, end, row = words(data, at)
    low = LOWER[data]
    one = word_hashes(low, start, end)
    n = len(at) - 1
    count = np.bincount(row, minlength=n)
    first = np.cumsum(count) - count
    acc = one.copy()
    for j in range(1, k):
        acc[: len(acc) - j] = mix(acc[: len(acc) - j] * np.uint64(0xD6E8FEB86659FD93) + one[j:]) if len(acc) > j else acc[: len(acc) - j]
    whole = np.arange(len(one)) - first[row] <= count[row] - k
    short = np.flatnonzero((count > 0) & (count < k))
    for r in short:  # fewer words than a shingle: the sequence is one
        h = np.uint64(count[r])
        for x in one[first[r] : first[r] + count[r]]:
            h = mix(h * np.array([0xD6E8FEB86659FD93], np.uint64) + x)[0]
        acc[first[r]], whole[first[r]] = h, True
    acc, row = acc[whole], row[whole]
    bounds = np.searchsorted(row, np.arange(n + 1))
    for i in range(n):
        acc[bounds[i] : bounds[i + 1]].sort()
    new = np.ones(len(acc), bool)
    new[1:] = (acc[1:] != acc[:-1]) | (row[1:] != row[:-1])
    return acc[new], np.searchsorted(row[new], np.arange(n + 1))


def signatures(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """rows x COORDS minimum hashes of 32 bits; rows without shingles are all zero."""
    out = np.zeros((len(bounds) - 1, COORDS), np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        for j in range(COORDS):
            out[full, j] = np.minimum.reduceat((values * _TIMES[j] + _PLUS[j]) >> np.uint64(32), bounds[full])
    return out


def _shapes(k: int):
    @F.arrow_udf("n long, f1 long, f2 long, sig binary")
    def shape(texts: pa.Array) -> pa.Array:
        n, f1, f2, sig = [], [], [], []
        for _, data, at in pieces(texts):
            values, bounds = shingle_sets(data, at, k)
            size = np.diff(bounds)
            sums = np.zeros((2, len(values) + 1), np.uint64)
            np.cumsum(mix(values), out=sums[0, 1:])
            np.cumsum(mix(values ^ np.uint64(0x5851F42D4C957F2D)), out=sums[1, 1:])
            n.append(size)
            f1.append((sums[0, bounds[1:]] - sums[0, bounds[:-1]]).view(np.int64))
            f2.append((sums[1, bounds[1:]] - sums[1, bounds[:-1]]).view(np.int64))
            sig += [r.tobytes() for r in signatures(values, bounds)]
        join = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64())
        return pa.StructArray.from_arrays([join(n), join(f1), join(f2), pa.array(sig, pa.binary())], ["n", "f1", "f2", "sig"])

    return shape


def _forest(batches):
    """(id, sig) to a row for each tree: the region's key (lowest bit: odd tree) and the next four values in pairs."""
    shift = np.uint64(32)
    for b in batches:
        if not b.num_rows:
            continue
        c = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(b.num_rows, COORDS).astype(np.uint64)
        ids = b.column(0).to_numpy()
        for t in range(TREES):
            v = c[:, (PREFIX * t + np.arange(8)) % COORDS]
            h = mix(mix((v[:, 0] << shift | v[:, 1]) + np.uint64(t + 1)) ^ (v[:, 2] << shift | v[:, 3]))
            h = (h & ~np.uint64(1)) | np.uint64(t & 1)
            cols = [ids, h.view(np.int64), (v[:, 4] << shift | v[:, 5]).view(np.int64), (v[:, 6] << shift | v[:, 7]).view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["id", "h", "s1", "s2"])


def candidates(classes: DataFrame) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """classes(id, sig) to pairs (a, b, support), a < b with the number of regions they met in; (h, id), the members of crowded regions; and what
    may be discarded once both are written."""
    crowds, written = None, []
    rows, key, found = classes.mapInArrow(_forest, "id long, h long, s1 long, s2 long"), [], []
    pair = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    for depth in ("h", "s1", "s2"):
        key = [*key, depth]
        counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
        live = staged(rows.join(counts, key).select("id", "h", "s1", "s2", "c"), "regions")
        written.append(live)
        w = Window.partitionBy(*key).orderBy("s1", "s2", "id")
        near = live.filter(F.col("c") <= FEW).select("id", F.array(*[F.lag("id", j).over(w) for j in range(1, FEW)]).alias("others"))
        near = near.select("id", F.explode(F.array_compact("others")).alias("other"))
        found.append(near.select(*pair(F.col("id"), F.col("other"))))
        crowded = live.filter(F.col("c") > FEW)
        # of one class: a row for each tree at most
        weighted = crowded.withColumn("weight", F.sum("c").over(Window.partitionBy("id")))
        chosen = F.xxhash64("id", "h").bitwiseAND(F.lit((1 << 20) - 1))
        rank = F.when(F.col("h").bitwiseAND(F.lit(1)) == 0, F.col("weight") * (1 << 20)).otherwise(0) + chosen
        pivots = weighted.groupBy(*key).agg(F.max_by("id", rank).alias("pivot"))
        found.append(crowded.join(pivots, key).filter("id <> pivot").select(*pair(F.col("id"), F.col("pivot"))))
        crowds = crowds or crowded.select("h", "id")
        rows = crowded.select("id", "h", "s1", "s2", "c")
        if depth != "s2":
            rows = rows.drop("c")
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("id"), F.ceil(F.col("c") / CHUNK)))
    chain = dealt.select("id", F.lag("id").over(Window.partitionBy(*key, "chunk").orderBy("id")).alias("other")).filter("other IS NOT NULL")
    found.append(chain.select(*pair(F.col("id"), F.col("other"))))
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return every.filter("a <> b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("support")), crowds, written


def _linked(k: int, percent: int):
    @F.arrow_udf("boolean")
    def linked(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        # both sides' texts in turn, so that pieces stay small and aligned
        both = pa.chunked_array([left, right]).combine_chunks()
        n = len(left)
        turn = both.take(pa.array(np.arange(2 * n).reshape(2, n).T.ravel()))
        sets: list[np.ndarray] = []
        for _, data, at in pieces(turn):
            values, bounds = shingle_sets(data, at, k)
            for i in range(len(at) - 1):
                sets.append(values[bounds[i] : bounds[i + 1]])
                if len(sets) == 2:
                    a, b = sets
                    sets = []
                    common = len(a) + len(b)
                    if len(a) and len(b) and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                        merged = np.concatenate([a, b])
                        merged.sort()
                        common = int((merged[1:] == merged[:-1]).sum())
                        out.append(100 * common >= percent * (len(merged) - common))
                    else:
                        out.append(False)
        return pa.array(out, pa.bool_())

    return linked


def _block_links(k: int, percent: int):
    """Exact links of a block of query rows with a block of a region's members, one for each query and other component."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def sets(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        values, bounds = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        for _, data, at in pieces(rows["text"].combine_chunks()):
            v, b = shingle_sets(data, at, k)
            bounds.append(b[1:] + bounds[-1][-1])
            values.append(v)
        return np.concatenate(values), np.concatenate(bounds)

    def links(queries: pa.Table, members: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and members.num_rows:
            q, q_at = sets(queries)
            m, m_at = sets(members)
            size, order = np.diff(m_at), np.argsort(m, kind="stable")
            token, owner = m[order], np.repeat(np.arange(len(size)), size)[order]
            m_id, m_comp = members["id"].to_numpy(), members["comp"].to_numpy()
            for i, (x, comp) in enumerate(zip(queries["id"].to_pylist(), queries["comp"].to_pylist(), strict=True)):
                own = q[q_at[i] : q_at[i + 1]]
                low = np.searchsorted(token, own, "left")
                n = np.searchsorted(token, own, "right") - low
                place = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
                shared = np.bincount(owner[place], minlength=len(size))
                hit = np.flatnonzero((100 * shared >= percent * (len(own) + size - shared)) & (m_comp != comp) & (shared > 0))
                _, first = np.unique(m_comp[hit], return_index=True)
                out += [(x, int(y)) for y in m_id[hit[first]]]
        return pa.table([pa.array([p[j] for p in out], pa.int64()) for j in (0, 1)], schema=schema)

    return links


def _counted(k: int):
    """Texts to (place, n): how many shingles fall on each of COUNTERS places."""

    def count(batches):
        total = np.zeros(COUNTERS, np.int64)
        for b in batches:
            for _, data, at in pieces(b.column(0)):
                total += np.bincount(_place(shingle_sets(data, at, k)[0]), minlength=COUNTERS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["place", "n"])

    return count


def _place(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(13)).astype(np.int64) & (COUNTERS - 1)


def rarest(values: np.ndarray, bounds: np.ndarray, often: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each set its n - ceil(percent n / 100) + 1 rarest shingles, by their counter and then by value, one set after the other; and n + 1 bounds."""
    size = np.diff(bounds)
    row = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((values, often[_place(values)], row))
    want = np.where(size > 0, size + (-percent * size) // 100 + 1, 0)
    first = np.arange(len(values)) - bounds[row] < want[row]
    return values[order][first], np.concatenate([[0], np.cumsum(want)])


def _rare_shingles(k: int, percent: int, often: np.ndarray):
    @F.arrow_udf("n long, rare array<long>")
    def rare(texts: pa.Array) -> pa.Array:
        sizes, out, ends = [], [], [np.zeros(1, np.int64)]
        for _, data, at in pieces(texts):
            values, bounds = shingle_sets(data, at, k)
            chosen, cut = rarest(values, bounds, often, percent)
            sizes.append(np.diff(bounds))
            out.append(chosen.view(np.int64))
            ends.append(cut[1:] + ends[-1][-1])
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(join(ends).astype(np.int32)), pa.array(join(out), pa.int64()))
        return pa.StructArray.from_arrays([pa.array(join(sizes), pa.int64()), lists], ["n", "rare"])

    return rare


def crowd_links(crowds: DataFrame, components_: DataFrame, texts: DataFrame, k: int, percent: int, confirm, written: list[DataFrame]) -> DataFrame:
    """(a, b): links between different components within crowded regions, see 4 above; confirm(pairs) keeps those of the pairs that link. What is
    staged on the way is added to `written`."""
    placed = crowds.join(components_, "id", "left").select("h", "id", F.coalesce("component", "id").alias("comp"))
    sizes = placed.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("n"))
    regions = sizes.groupBy("h").agg(F.max_by("comp", F.col("n") * (1 << 20) + F.xxhash64("comp").bitwiseAND(F.lit((1 << 20) - 1))).alias("major"), F.sum("n").alias("members"), F.max("n").alias("most")).filter("members > most")
    mixed = staged(placed.join(regions.select("h", "major"), "h"), "mixed")
    ids = staged(mixed.select("id", "comp").distinct(), "members")
    held = texts.join(sent_if_small(ids), "id")
    often = np.zeros(COUNTERS, np.int64)
    counted = held.select("text").mapInArrow(_counted(k), "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    often[counted["place"].to_numpy()] = counted["n"].to_numpy()
    rare = held.select("id", "comp", _rare_shingles(k, percent, often)(F.col("text")).alias("s")).select("id", "comp", "s.n", F.explode("s.rare").alias("x"))
    rare = staged(rare, "rare")
    shared = staged(rare.groupBy("x").agg(F.count(F.lit(1)).alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("x", "c"), "shared")
    # holders of a rare shingle: at most COMMON, so at most COMMON pairs for each
    few = rare.join(shared.filter(F.col("c") <= COMMON).select("x"), "x")
    other = few.select("x", *[F.col(c).alias(f"{c}_b") for c in ("id", "comp", "n")])
    alike = (F.least("n", "n_b") * 100 >= F.greatest("n", "n_b") * percent) & (F.col("comp") != F.col("comp_b")) & (F.col("id") < F.col("id_b"))
    pairs = staged(few.join(other, "x").filter(alike).select(F.col("id").alias("a"), F.col("id_b").alias("b")).distinct(), "near")
    # holders of a common one: blocks of their regions
    many = rare.join(shared.filter(F.col("c") > COMMON).select("x"), "x", "left_semi").select("id").distinct()
    rest = mixed.join(many, "id", "left_semi")
    left_over = rest.groupBy("h").agg(F.count(F.lit(1)).alias("members"), F.count(F.when(F.col("comp") != F.col("major"), 1)).alias("minors")).filter("minors > 0 AND members > 1")
    written += [mixed, ids, rare, shared, pairs]
    mixed = staged(rest.join(left_over, "h"), "blocks")
    written.append(mixed)
    count = lambda n: F.ceil(n / BLOCK).cast("int")
    blocks = lambda n: F.explode(F.sequence(F.lit(0), count(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), count(n)).cast("int")
    queries = mixed.filter("comp <> major").select("h", "id", "comp", own(F.col("minors")).alias("qb"), blocks(F.col("members")).alias("mb"))
    members = mixed.select("h", "id", "comp", own(F.col("members")).alias("mb"), blocks(F.col("minors")).alias("qb"))
    keys = ["h", "qb", "mb"]
    left, right = (x.join(texts, "id").select(*keys, "id", "comp", "text") for x in (queries, members))
    left, right = left.groupBy(*keys), right.toDF(*right.columns).groupBy(*keys)  # toDF: columns of its own, though both come from one table
    return confirm(pairs).union(left.cogroup(right).applyInArrow(_block_links(k, percent), "a long, b long"))


def near_duplicates(df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: the key, n_shingles, component_id (smallest id reachable over links) and kept (it is that id).

    Two rows are linked if 100 * (shared shingles) >= percent * (shingles in either).
    """
    small_batches()
    own = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    shapes = staged(own.select("id", _shapes(shingle)(F.col("text")).alias("x")).select("id", "x.*"), "shapes")
    named = shapes.filter("id IS NOT NULL AND n > 0")
    class_of = named.groupBy("n", "f1", "f2").agg(F.min("id").alias("rep"))
    reps = shapes.join(class_of.select(F.col("rep").alias("id"), "n", "f1", "f2"), ["id", "n", "f1", "f2"], "left_semi").select("id", "sig").dropDuplicates(["id", "sig"])
    met, crowds, regions = candidates(reps)
    pairs = staged(met, "pairs")
    crowds = staged(crowds, "crowds")
    discard(*regions)
    involved = staged(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "involved")
    # the texts of the classes that met another, once each
    texts = staged(own.join(sent_if_small(involved), "id", "left_semi"), "texts")

    def confirm(some: DataFrame) -> DataFrame:
        a, b = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
        return some.join(a, "a").join(b, "b").filter(_linked(shingle, percent)(F.col("text_a"), F.col("text_b"))).select("a", "b")

    strong = F.col("support") * (1 << 20) + F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 20) - 1))
    by_a = pairs.groupBy("a").agg(F.max_by("b", strong).alias("b"))
    by_b = pairs.groupBy("b").agg(F.max_by("a", strong).alias("a")).select("a", "b")
    # rows of different classes under one id are one node
    same = named.select("id", "n", "f1", "f2").join(class_of, ["n", "f1", "f2"]).filter("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    ids = named.groupBy("id").agg(F.min("f1").alias("x"), F.max("f1").alias("y")).filter("x <> y").select(F.col("id").alias("a"))
    links = staged(confirm(by_a.union(by_b).distinct()).union(same.join(ids, "a", "left_semi")), "links")
    joined = components(links)
    of = lambda c, name: joined.select(F.col("id").alias(c), F.col("component").alias(name))
    apart = pairs.join(of("a", "ca"), "a", "left").join(of("b", "cb"), "b", "left")
    apart = apart.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    apart = apart.join(by_a, ["a", "b"], "left_anti").join(by_b, ["a", "b"], "left_anti")
    more = confirm(apart)
    star = lambda c: c.select(F.col("id").alias("a"), F.col("component").alias("b"))
    second = components(star(joined).union(more))
    written = [pairs, involved, texts, links, crowds]
    whole = components(star(second).union(crowd_links(crowds, second, texts, shingle, percent, confirm, written)))
    discard(*written)
    rows = shapes.select("id", "n", "f1", "f2").join(class_of, ["n", "f1", "f2"], "left")
    rows = rows.join(whole.select(F.col("id").alias("rep"), "component"), "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id"))
    return rows.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
