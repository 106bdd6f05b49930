"""Vector codes: product quantisation by integer codebooks.

Each component x becomes the whole number floor(4096 x); a vector is cut into 8 equal consecutive parts, and each part is named by its nearest
entry in the codebook of its position.

1. A codebook begins as the parts of the 16 rows with the smallest ids: every task keeps its smallest, and a window over those picks the first.
2. In each round the codebooks (16 entries a part: some kB) are broadcast. A task takes its rows in Arrow batches, computes all distances of a batch
   as |x|^2 - 2 x.c + |c|^2 with int64 matrix products, takes the first smallest, and adds the parts up by entry. It returns its sums once; they are
   merged by a grouped shuffle (tasks x entries x components rows, however many vectors there are), and the driver gets one sum for each component
   of an entry.
3. The last codebooks give each row its code and its squared error.

The table is read once a round, its vectors only; nothing else of it moves.

Exactness: products of components below sqrt(2^58 / part length) fit int64, which holds for |x| < 40,000 at a part length of 8. Rows with larger
components, and entries that such rows drew away, are computed with Python's whole numbers instead. Sums are returned in limbs of 30 bits,
so they neither overflow nor round. An error beyond a long is given as the largest long.

Edge cases: a vector that is null or holds a null, NaN or infinite component is dropped. Vectors of another length have codebooks of their own; one
whose length is no multiple of 8 is filled up with zeros at its end; an empty one has code 0 and error 0. Fewer rows than 16 give fewer entries.
Rows without an id come last among the smallest; rows sharing an id are rows of their own, ordered by their vectors. An empty table gives no rows;
other columns, whatever their names, are left alone or, where they have a result's name, replaced.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import sent_if_small, staged, without
from folio.plans.runtime import same_keys

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Bits of a limb of a sum.
LIMB = 30
MOST = (1 << 63) - 1
#: Codebooks by vector length: a list of parts, each a list of entries, each a list of whole numbers.
Books = dict[int, list[list[list[int]]]]


def finite(vector: str) -> F.Column:
    """Whether a vector takes part."""
    good = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf")))
    return F.coalesce(F.col(f"`{vector}`").isNotNull() & F.forall(F.col(f"`{vector}`"), good), F.lit(False))


def _limit(width: int) -> float:
    """Components below this keep all sums of products of a row within int64."""
    return math.sqrt(2.0**58 / max(width, 1))


def _exact(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale x) as Python's whole numbers; a double of 2^53 or more is whole already."""
    return np.array([int(c) * scale if abs(c) >= 2.0**53 else math.floor(c * scale) for c in x.ravel().tolist()] + [None], object)[:-1].reshape(x.shape)


def by_length(col: pa.Array, parts: int, scale: int):
    """Of a list column yields (length, places, whole, exact): rows x parts x width int64 for rows within the limit, Python's numbers for the others."""
    size = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat, ends = col.flatten().to_numpy(zero_copy_only=False).astype(float), np.cumsum(size)
    for n in np.unique(size):
        which = np.flatnonzero(size == n)
        width = -(-int(n) // parts)
        x = np.zeros((len(which), parts * width))
        x[:, :n] = flat[(ends[which] - n)[:, None] + np.arange(n)]
        with np.errstate(over="ignore"):
            whole = np.floor(x * scale)
        wide = (np.abs(whole) >= _limit(width)).any(1)
        shape = (-1, parts, width)
        for rows, exact in ((np.flatnonzero(~wide), False), (np.flatnonzero(wide), True)):
            if len(rows):
                yield int(n), which[rows], (_exact(x[rows], scale) if exact else whole[rows].astype(np.int64)).reshape(len(rows), *shape[1:]), exact


def nearest(x: np.ndarray, entries: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Of rows x width parts the first nearest entry and the squared distance to it."""
    c = np.array(entries, object).reshape(len(entries), x.shape[1])
    if x.dtype != object and all(abs(v) < _limit(x.shape[1]) for e in entries for v in e):
        c = c.astype(np.int64)
        far = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
    else:
        x = x.astype(object)
        far = np.zeros((len(x), len(c)), object)
        for j in range(x.shape[1]):
            far = far + (x[:, j, None] - c[None, :, j]) ** 2
    code = far.argmin(1)
    return code, far[np.arange(len(x)), code]


def _smallest(entries: int):
    """(key, vector) to the task's rows with the smallest keys, of each length."""

    def smallest(batches):
        best: dict[int, list] = {}
        schema = None
        for b in batches:
            schema = b.schema
            keys, vectors = b.column(0), b.column(1)
            size = vectors.value_lengths().to_numpy(zero_copy_only=False)
            order = np.where(keys.is_null().to_numpy(zero_copy_only=False), np.inf, 0), keys.fill_null(0).to_numpy(zero_copy_only=False)
            for n in np.unique(size):
                which = np.flatnonzero(size == n)
                ranked = which[np.lexsort((order[1][which], order[0][which]))]
                last = ranked[min(entries, len(ranked)) - 1]
                near = ranked[(order[0][ranked] < order[0][last]) | ((order[0][ranked] == order[0][last]) & (order[1][ranked] <= order[1][last]))]
                found = zip(keys.take(pa.array(near)).to_pylist(), vectors.take(pa.array(near)).to_pylist(), strict=True)
                best[int(n)] = sorted([*best.get(int(n), []), *found], key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
        rows = [r for kept in best.values() for r in kept]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], schema.field(j).type) for j in (0, 1)], schema=schema)

    return smallest


def _sums(books, parts: int, scale: int):
    """Vectors to (length, part, entry, component, limb, value): the task's sums of the parts of each entry; component -1 counts them."""

    def sums(batches):
        total: dict[int, np.ndarray] = {}
        more: dict[int, np.ndarray] = {}
        for b in batches:
            for n, _, x, exact in by_length(b.column(0), parts, scale):
                book, width = books.value[n], x.shape[2]
                into = more if exact else total
                shape = (parts, len(book[0]), width + 1)
                if n not in into:
                    into[n] = np.zeros(shape, object if exact else np.int64)
                for p in range(parts):
                    code, _ = nearest(x[:, p], book[p])
                    into[n][p, :, width] += np.bincount(code.astype(np.int64), minlength=shape[1])
                    for j in range(width):
                        if exact:
                            np.add.at(into[n][p, :, j], code.astype(np.int64), x[:, p, j])
                        else:  # whole numbers below 2^29, some thousand of them: exact in doubles
                            into[n][p, :, j] += np.bincount(code, weights=x[:, p, j], minlength=shape[1]).astype(np.int64)
        out = []
        for n in {*total, *more}:
            both = sum(t[n].astype(object) for t in (total, more) if n in t)
            for (p, e, j), value in np.ndenumerate(both):
                value, limb, comp = int(value), 0, -1 if j == both.shape[2] - 1 else j
                while not -(1 << LIMB) <= value < 1 << LIMB:
                    out.append((n, p, e, comp, limb, value & ((1 << LIMB) - 1)))
                    value, limb = value >> LIMB, limb + 1
                if value:
                    out.append((n, p, e, comp, limb, value))
        names = ("dim", "part", "entry", "comp", "limb", "value")
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64() if i == 5 else pa.int32()) for i in range(6)], names=list(names))

    return sums


def train(df: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Books:
    """The codebooks of each vector length after all rounds. An entry that no part chose stays as it is."""
    spark = df.sparkSession
    rows = df.filter(finite(vector)).select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{vector}`").alias("v"))
    first = rows.mapInArrow(_smallest(entries), rows.schema).withColumn("dim", F.size("v"))
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("dim").orderBy(F.asc_nulls_last("key"), "v"))).filter(F.col("rank") <= entries)
    books: Books = {}
    for r in ranked.orderBy("dim", "rank").select("dim", "v").collect():  # `entries` rows for each length
        width = -(-r.dim // parts)
        whole = [*_exact(np.array(r.v, float), scale).tolist(), *[0] * (parts * width - r.dim)]
        book = books.setdefault(r.dim, [[] for _ in range(parts)])
        for p in range(parts):
            book[p].append(whole[p * width : (p + 1) * width])
    for _ in range(rounds if books else 0):
        sent = spark.sparkContext.broadcast(books)
        sums = rows.select("v").mapInArrow(_sums(sent, parts, scale), "dim int, part int, entry int, comp int, limb int, value long")
        merged: dict[tuple, int] = {}
        for dim, part, entry, comp, limb, value in sums.groupBy("dim", "part", "entry", "comp", "limb").agg(F.sum("value").alias("value")).collect():
            merged[dim, part, entry, comp] = merged.get((dim, part, entry, comp), 0) + (value << (LIMB * limb))
        sent.unpersist()
        mean = lambda d, p, e, old: [merged.get((d, p, e, j), 0) // n for j in range(len(old))] if (n := merged.get((d, p, e, -1), 0)) else old
        books = {d: [[mean(d, p, e, old) for e, old in enumerate(part)] for p, part in enumerate(book)] for d, book in books.items()}
    return books


def encode(df: DataFrame, books: Books, vector: str = "embedding", parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """The rows whose vectors take part, with code (two hex digits for each part) and error (squared distances to the entries, summed)."""
    sent = df.sparkSession.sparkContext.broadcast(books)

    @F.arrow_udf("code string, error long")
    def codes(vectors: pa.Array) -> pa.Array:
        code, error = np.zeros((len(vectors), parts), np.uint8), np.zeros(len(vectors), object)
        for n, places, x, _ in by_length(vectors, parts, scale):
            for p in range(parts):
                code[places, p], far = nearest(x[:, p], sent.value[n][p])
                error[places] += far.astype(object)
        digits = code.tobytes().hex()
        named = [digits[2 * parts * i : 2 * parts * (i + 1)] for i in range(len(code))]
        return pa.StructArray.from_arrays([pa.array(named, pa.string()), pa.array([min(e, MOST) for e in error.tolist()], pa.int64())], ["code", "error"])

    rows = df.filter(finite(vector))
    whole = rows.withColumn("code", codes(F.col(f"`{vector}`")))
    return whole.select(*[F.col(f"`{c}`") for c in without(rows, "code", "error").columns], F.col("code.code").alias("code"), F.col("code.error").alias("error"))


def digest(book: list[list[list[int]]]) -> str:
    """SHA-256 of all components by part, entry and position, as decimals joined by commas."""
    return hashlib.sha256(",".join(str(c) for part in book for entry in part for c in entry).encode()).hexdigest()


def compress(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """key, code, error, label_error (error summed over equal labels, nulls together) and codebooks_sha256 (of the vector's length) of each row that takes part."""
    books = train(df, key, vector)
    rows = df.select(F.col(f"`{key}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("v"))
    coded = staged(encode(rows, books, "v").select("vec_id", "label", F.size("v").alias("dim"), "code", "error"), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long")
    labels = sent_if_small(coded.groupBy("label").agg(total.alias("label_error")))
    name = F.lit(None).cast("string")
    for n, book in books.items():
        name = F.when(F.col("dim") == n, F.lit(digest(book))).otherwise(name)
    return same_keys(coded, labels, ["label"], "left").select(F.col("vec_id").alias(key), "code", "error", "label_error", name.alias("codebooks_sha256"))
