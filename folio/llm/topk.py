"""Exact top-k inner products by pivot-table elimination.

Each vector is made whole (floor of 256 times each component). Its distances to many pivots are computed once. For a query q and a row x,
|q - x| >= |d(q, p) - d(x, p)| for every pivot p, and q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2, so the largest of these lower bounds on the
distance gives an upper bound on the score. Rows are evaluated in the order of that bound, until the next bound is below the k-th score.

1. Rows are dealt into blocks along their nearest pivots (and by hash, so that a crowd around one pivot is many blocks); a block's table row
   holds the least and largest distance to each pivot and the largest norm, which bound the score of a query with any of its rows.
2. Each query is first searched in its own block. Its k-th score there is the threshold that it takes along.
3. Queries in blocks of `query_rows` meet the other blocks: a pair of blocks that cannot reach the lowest threshold of its queries is
   skipped before any row moves, and so is each query for which a block is of no use; in a block, rows below the threshold are eliminated
   and the rest evaluated in bound order. Every group has a bounded size; the best k of each query and block are merged.

Edge cases: a vector that is null or holds a null, NaN or infinite component takes no part, nor does a null id. Vectors of different lengths are
not compared; empty ones score 0 with one another. Vectors with a squared length above 2^62 stand in blocks of their own and are multiplied
with Python's whole numbers; a score outside the long range counts as the end of that range. (256 times a component that leaves the doubles counts as
the largest double.) Equal (id, vector) rows count once; rows with the query's id are its own, whatever they hold; an id with several vectors counts
with its best. Ties go to the smaller id. An empty table, or one without queries, gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.codebook import finite
from folio.llm.common import sent_if_small, staged

PIVOTS = 24
#: Below any score.
NONE = -(1 << 63)


#: Squared lengths up to this have int64 products with one another.
LONG = 2.0**62


def matrix(col: pa.Array, width: int | None = None) -> np.ndarray:
    """A list column of equal lengths as rows of doubles."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    return flat.reshape(len(col), (len(flat) // len(col) if len(col) else 0) if width is None else width)


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale x), in doubles: a double of 2^53 or more is whole already."""
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(x * scale))


def products(x: np.ndarray, q: np.ndarray, largest: float, size: float) -> np.ndarray:
    """The exact inner products of whole rows x with q, within the long range; `largest` and `size` are their squared lengths."""
    if size * largest < 2.0**104:  # all sums fit a double's 53 bits
        return (x @ q).astype(np.int64)
    if max(size, largest) <= LONG:
        return x.astype(np.int64) @ q.astype(np.int64)
    other = [int(c) for c in q.tolist()]
    exact = (sum(int(c) * o for c, o in zip(row, other, strict=True)) for row in x.tolist())
    return np.array([min(max(s, NONE), -NONE - 1) for s in exact], np.int64)


def best(q: np.ndarray, qd: np.ndarray, qid: np.ndarray, x: np.ndarray, xd: np.ndarray, xid: np.ndarray, k: int, floor: np.ndarray | None = None, step: int = 256):
    """For each query its k best rows of other ids that reach its floor: yields (ids, scores), in order.

    Rows are evaluated by falling bound, `step` at first and then twice as many each time, until no bound reaches the k-th score.
    """
    with np.errstate(over="ignore"):
        x_norm, q_norm = (x.astype(float) ** 2).sum(1), (q.astype(float) ** 2).sum(1)
    largest, q = x_norm.max(initial=0.0), q.astype(float)
    table, twice = np.ascontiguousarray(xd.T), len(np.unique(xid)) < len(xid)
    gap, apart = np.empty(len(x)), np.empty(len(x))
    for i in range(len(q)):
        gap[:] = 0
        with np.errstate(over="ignore", invalid="ignore"):
            for pivot, own in zip(table, qd[i], strict=True):
                np.subtract(pivot, own, out=apart)
                np.abs(apart, out=apart)
                np.maximum(gap, apart, out=gap)
            both = q_norm[i] + x_norm
            bound = (both - gap**2) / 2 + 1 + 1e-9 * both  # rounding stays below this slack
        bound[np.isnan(bound)] = np.inf
        left = np.flatnonzero((bound >= floor[i]) & (xid != qid[i])) if floor is not None else np.flatnonzero(xid != qid[i])
        bound, take = bound[left], step
        score, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while len(left):
            first = np.argpartition(-bound, take - 1)[:take] if len(left) > take else np.arange(len(left))
            rows = left[first]
            now = products(x[rows], q[i], largest, q_norm[i])
            if len(score) >= k:
                rows, now = rows[now >= score[k - 1]], now[now >= score[k - 1]]
            score, ids = np.concatenate([score, now]), np.concatenate([ids, xid[rows]])
            top = np.lexsort((ids, ~score))  # ~ turns the order about, also of the least long
            if twice:
                top = top[np.sort(np.unique(ids[top], return_index=True)[1])]  # an id once, with its best
            score, ids = score[top[:k]], ids[top[:k]]
            rest = np.ones(len(left), bool)
            rest[first] = False
            if len(score) >= k:
                rest &= bound >= score[k - 1]
            left, bound, take = left[rest], bound[rest], 2 * take
        yield ids, score


def search(df: DataFrame, key: str = "vec_id", vector: str = "embedding", is_query=None, k: int = 5, scale: int = 256, pivots: int = PIVOTS, block_rows: int = 8192, query_rows: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of each row that is_query (a condition; by default key divisible by 50) holds for.

    Pivots are the rows with the smallest hashes of their ids, at most `pivots`: any choice gives the same result.
    """
    is_query = F.expr(f"`{key}` % 50 = 0") if is_query is None else is_query
    rows = df.filter(F.col(f"`{key}`").isNotNull() & finite(vector)).select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.withColumn("dim", F.size("v"))
    short = F.aggregate("v", F.lit(0.0), lambda a, c: a + F.pow(c * scale, F.lit(2.0))) <= LONG / 4
    at = [whole(np.array(r[0], float), scale) for r in rows.filter(short).orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(pivots).select("v").collect()]

    @F.arrow_udf("array<double>")
    def measures(vectors: pa.Array) -> pa.Array:
        """Distances to the pivots (0 to one of another length), and the squared length."""
        size = vectors.value_lengths().to_numpy()
        flat, ends = whole(vectors.flatten().to_numpy(zero_copy_only=False).astype(float), scale), np.cumsum(size)
        out = np.zeros((len(size), len(at) + 1))
        with np.errstate(over="ignore"):
            for n in np.unique(size):
                which = np.flatnonzero(size == n)
                x = flat[(ends[which] - n)[:, None] + np.arange(n)]
                out[which, -1] = (x**2).sum(1)
                for j, p in enumerate(at):
                    if len(p) == n:
                        out[which, j] = np.sqrt(((x - p) ** 2).sum(1))
        return pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32)), pa.array(out.ravel()))

    p = len(at)
    d = F.slice("m", 1, p)
    table = rows.withColumn("m", measures(F.col("v")))
    nearest = F.coalesce(F.array_position(d, F.array_min(d)).cast("int"), F.lit(0)) if p else F.lit(0)
    # long vectors stand by themselves: beside them others would be multiplied with Python's numbers too
    table = staged(table.withColumn("c", F.when(F.col("m")[p] > LONG, F.lit(-1)).otherwise(nearest)), "pivots")
    # blocks are filled cluster by cluster, a crowded cluster is several; so are query blocks
    upto = lambda c: F.sum(c).over(Window.partitionBy("dim", F.col("c") < 0).orderBy("c")) - F.col(c)
    clusters = table.groupBy("dim", "c").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("is_query"), 1)).alias("queries"))
    clusters = clusters.withColumns({"rows_before": upto("n"), "queries_before": upto("queries")})
    share = F.pmod(F.xxhash64("vec_id", "v"), F.lit(1 << 20))
    part = lambda before, n, size: F.floor((before + F.floor(share * n / (1 << 20))) / size) * 2 + (F.col("c") < 0).cast("int")
    placed = table.join(sent_if_small(clusters), ["dim", "c"])
    placed = placed.withColumn("xb", part(F.col("rows_before"), F.col("n"), block_rows)).withColumn("qb", part(F.col("queries_before"), F.col("queries"), query_rows)).select("dim", "xb", "qb", "vec_id", "v", "m", "is_query")
    list_of = lambda kind: pa.list_(kind)
    schema = pa.schema([("dim", pa.int32()), ("own", pa.int64()), ("qb", pa.int64()), ("vec_id", pa.int64()), ("v", list_of(pa.float64())), ("m", list_of(pa.float64())), ("floor", pa.int64()), ("ids", list_of(pa.int64())), ("scores", list_of(pa.int64()))])

    def first(block: pa.Table) -> pa.Table:
        """The queries of a block with their best rows in it."""
        q = block.filter(block["is_query"])
        if not q.num_rows:
            return schema.empty_table()
        x, xm, qm = whole(matrix(block["v"]), scale), matrix(block["m"])[:, :p], matrix(q["m"])[:, :p]
        found = list(best(whole(matrix(q["v"]), scale), qm, q["vec_id"].to_numpy(), x, xm, block["vec_id"].to_numpy(), k))
        floors = [int(s[k - 1]) if len(s) >= k else NONE for _, s in found]
        cols = [q["dim"], q["xb"], q["qb"], q["vec_id"], q["v"], q["m"], pa.array(floors, pa.int64()), pa.array([i.tolist() for i, _ in found], schema.field("ids").type), pa.array([s.tolist() for _, s in found], schema.field("scores").type)]
        return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols], names=schema.names).cast(schema)

    seeds = staged(placed.groupBy("dim", "xb").applyInArrow(first, "dim int, own long, qb long, vec_id long, v array<double>, m array<double>, floor long, ids array<long>, scores array<long>"), "seeds")

    m = lambda i: F.col("m")[i]
    ends = lambda df, by, more: df.groupBy("dim", by).agg(F.array(*[F.min(m(i)) for i in range(p + 1)]).alias(f"{by}_lo"), F.array(*[F.max(m(i)) for i in range(p + 1)]).alias(f"{by}_hi"), *more)
    blocks = ends(placed, "xb", [])
    wanted = ends(seeds, "qb", [F.min("floor").alias("qb_floor")])

    def reach(lo, hi):
        """The bound on the score of a query (or block of queries) with measures lo to hi and any row of a block."""
        apart = [F.lit(0.0), *[x for i in range(p) for x in (lo[i] - F.col("xb_hi")[i], F.col("xb_lo")[i] - hi[i])]]
        gap = F.greatest(*apart) if p else F.lit(0.0)
        both = hi[p] + F.col("xb_hi")[p]
        return (both - gap * gap) / 2 + 1 + both * 1e-9

    pairs = staged(wanted.join(blocks, "dim").filter(reach(F.col("qb_lo"), F.col("qb_hi")) >= F.col("qb_floor")).select("dim", "qb", "xb", "xb_lo", "xb_hi"), "pairs")
    left = seeds.join(pairs, ["dim", "qb"]).filter((F.col("xb") != F.col("own")) & (reach(F.col("m"), F.col("m")) >= F.col("floor"))).select("dim", "qb", "xb", "vec_id", "v", "m", "floor")
    right = placed.drop("qb", "is_query").join(sent_if_small(pairs.select("dim", "qb", "xb")), ["dim", "xb"]).select("dim", "qb", "xb", "vec_id", "v", "m")
    out = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def pair(q: pa.Table, x: pa.Table) -> pa.Table:
        if not q.num_rows or not x.num_rows:
            return out.empty_table()
        found = list(best(whole(matrix(q["v"]), scale), matrix(q["m"])[:, :p], q["vec_id"].to_numpy(), whole(matrix(x["v"]), scale), matrix(x["m"])[:, :p], x["vec_id"].to_numpy(), k, q["floor"].to_numpy()))
        ids, scores = (np.concatenate([f[j] for f in found]) for j in (0, 1))
        return pa.table([pa.array(np.repeat(q["vec_id"].to_numpy(), [len(i) for i, _ in found])), pa.array(ids), pa.array(scores)], schema=out)

    own = seeds.select(F.col("vec_id").alias("query_id"), F.explode(F.arrays_zip("ids", "scores")).alias("s")).select("query_id", F.col("s.ids").alias("vec_id"), F.col("s.scores").alias("score"))
    keys = ["dim", "qb", "xb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(pair, "query_id long, vec_id long, score long")
    # an id that several vectors have counts once
    every = found.union(own).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
