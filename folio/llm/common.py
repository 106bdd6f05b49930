"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.plans.runtime import shared_dir

#: What separates words, as a Java regular expression: space and the controls 09 to 0D.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts the lineage and fixes the rows, so a lost executor costs a re-read only."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/folio-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*written: DataFrame) -> None:
    """Deletes what `staged` wrote for these; nothing that is still to be computed may read it."""
    for df in written:
        place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        place.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


#: Up to so many rows of a few numbers (tens of MB) are sent to every executor; more are joined by a shuffle, with the same result.
MOST_SENT = 1_000_000


def sent_if_small(df: DataFrame) -> DataFrame:
    """df, marked for sending to all executors if a count shows that it has MOST_SENT rows at most. df should be cheap to read twice."""
    return F.broadcast(df) if df.count() <= MOST_SENT else df


#: Rows of texts that go to a Python worker at once: some MB of ordinary documents.
BATCH = 512
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches() -> None:
    """Lowers the session's batch size for Python to BATCH, so that workers and the JVM's Arrow buffers stay small whatever the texts' length."""
    spark = SparkSession.getActiveSession()
    if spark and not 0 < int(spark.conf.get(_BATCH)) <= BATCH:
        spark.conf.set(_BATCH, str(BATCH))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that df does not have (compared without case, as Spark does)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """df less its columns of these names in any case: an operator's own output column replaces an input column."""
    gone = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def word_count(text) -> F.Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# ---- numpy over Arrow text -------------------------------------------------------------------

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
_powers = np.ones((2, 1), np.uint64)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the n + 1 offsets; a null is an empty text."""
    col = col.cast(pa.large_string()).fill_null("")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    all_bytes = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return all_bytes[at[0] : at[-1]], at - at[0]


def pieces(col: pa.Array, most: int = 1 << 19):
    """Yields (first row, bytes, offsets) of runs of rows with about `most` bytes each, one row at least."""
    data, at = utf8(col)
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the row it stands in."""
    inside = ~SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True  # a word ends with its row
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(at, start, "right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _up_to(n: int) -> np.ndarray:
    global _powers
    if _powers.shape[1] <= n:
        grown = np.ones((2, max(n + 1, 1 << 17)), np.uint64)
        grown[0, 1:], grown[1, 1:] = _ODD, _INVERSE
        _powers = np.cumprod(grown, axis=1, dtype=np.uint64)
    return _powers


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, block: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of each data[start:end], from prefix sums over blocks of whole words."""
    out, i = np.zeros(len(start), np.uint64), 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + block, "right")))
        base, size = start[i], int(end[j - 1] - start[i])
        up, down = _up_to(size)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((data[base : end[j - 1]].astype(np.uint64) + np.uint64(1)) * up[:size], out=sums[1:])
        s, e = start[i:j] - base, end[i:j] - base
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out
