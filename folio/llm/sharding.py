"""Sharding: a uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

1. The input is written once with each row's number: partition and place in it.
2. From the partitions' sizes a matrix is drawn: how many rows go from each partition to each shard. Row and column sums are fixed, so a
   column is filled without any coordination, and a draw is multivariate hypergeometric, as in a uniform shuffle.
3. Each partition permutes its own rows' destinations (seeded by partition number), which sends exactly the drawn counts.
4. After the exchange each shard permutes what it got: rows are ordered by a seeded hash. A shard is split into blocks of hash ranges, so
   that no task holds a whole shard; a row's slot is its place in the block plus the sizes of the blocks before.

Edge cases: nulls anywhere and repeated rows are rows like others (identity is the row number); an empty table gives no rows; input
columns named shard or slot are replaced. Sizes of shards differ by one at most. The matrix has partitions x shards whole numbers: it does
not grow with the rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.common import fresh, staged, without

PLACE_BITS = 33  # of monotonically_increasing_id: the place within the partition


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n balls drawn from good + bad are good. numpy's sampler up to its limit; beyond, inversion from the mode outwards."""
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, n)) if n else 0
    low, high = max(0, n - bad), min(n, good)
    logs = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
    mid = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    p = math.exp(logs(good, mid) + logs(bad, n - mid) - logs(good + bad, n))
    u, left, right, below, above = rng.random() - p, mid, mid, p, p
    if u <= 0:
        return mid
    while left > low or right < high:
        if right < high:
            above *= (good - right) * (n - right) / ((right + 1) * (bad - n + right + 1))
            right += 1
            u -= above
            if u <= 0:
                return right
        if left > low:
            below *= left * (bad - n + left) / ((good - left + 1) * (n - left + 1))
            left -= 1
            u -= below
            if u <= 0:
                return left
        if above < 1e-300 and below < 1e-300:
            break
    return mid


def communication_matrix(sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """partitions x shards: row p sums to sizes[p], column s to the s-th shard's exact size."""
    rng, total = np.random.default_rng(seed), sum(sizes)
    free = [total // shards + (s < total % shards) for s in range(shards)]
    out = np.zeros((len(sizes), shards), np.int64)
    for p, size in enumerate(sizes):
        need, rest = size, sum(free)
        for s in range(shards):
            got = hypergeometric(rng, free[s], rest - free[s], need)
            rest -= free[s]
            need -= got
            free[s] -= got
            out[p, s] = got
    return out


def shuffle(df: DataFrame, shards: int = 16, seed: int = 11, block_rows: int = 4096) -> DataFrame:
    """Adds shard (0 to shards - 1) and slot (gapless from 0 in each shard): a uniform random order of all rows, cut at exact sizes."""
    if shards < 1:
        raise ValueError("shards must be 1 at least")
    df = without(df, "shard", "slot")
    number, block, count, before = fresh(df, "row_number", "block", "block_count", "rows_before")
    kept = staged(df.withColumn(number, F.monotonically_increasing_id()), "shuffle")
    sizes = {int(r[0]): int(r[1]) for r in kept.groupBy(F.shiftright(number, PLACE_BITS).alias("p")).agg(F.count(F.lit(1))).collect()}
    parts = sorted(sizes)
    matrix = communication_matrix([sizes[p] for p in parts], shards, seed)
    row_of = {p: i for i, p in enumerate(parts)}
    blocks = max(1, -(-sum(sizes.values()) // (shards * block_rows)))

    drawn_last: dict[int, np.ndarray] = {}

    @F.arrow_udf("int")
    def destination(numbers: pa.Array) -> pa.Array:
        got = numbers.to_numpy(zero_copy_only=False)
        part, out = got >> PLACE_BITS, np.zeros(len(got), np.int32)
        for p in np.unique(part):
            mine = part == p
            if p not in drawn_last:
                goes = np.repeat(np.arange(shards, dtype=np.int32), matrix[row_of[int(p)]])
                np.random.default_rng((seed, int(p))).shuffle(goes)
                drawn_last.clear()
                drawn_last[p] = goes
            out[mine] = drawn_last[p][got[mine] & ((1 << PLACE_BITS) - 1)]
        return pa.array(out)

    drawn = F.xxhash64(F.col(number), F.lit(seed))
    sent = kept.withColumn("shard", destination(F.col(number)))
    # a block is a range of the hash, taken as a share of its whole range
    sent = sent.withColumn(block, F.least(F.lit(blocks - 1), F.floor((drawn / F.lit(2.0**64) + 0.5) * blocks)).cast("int"))
    by_block = sent.groupBy("shard", block).agg(F.count(F.lit(1)).alias(count))
    starts = by_block.select("shard", block, (F.sum(count).over(Window.partitionBy("shard").orderBy(block)) - F.col(count)).alias(before))
    placed = sent.withColumn("slot", F.row_number().over(Window.partitionBy("shard", block).orderBy(drawn, F.col(number))).cast("long") - 1)
    joined = placed.join(F.broadcast(starts), ["shard", block]) if blocks * shards <= 100_000 else placed.join(starts, ["shard", block])
    return joined.select(*[f"`{c}`" for c in df.columns], "shard", (F.col("slot") + F.col(before)).alias("slot"))
