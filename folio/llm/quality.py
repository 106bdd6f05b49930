"""Quality classifier: cumulative-link (ordinal logistic) regression on graded ratings, over hashed words.

A text's features are the distinct words it holds (lower-cased runs of letters and digits, runs of signs, and coarse shares of capitals and
signs), hashed into BUCKETS. One weight vector is shared by all grades, and ordered thresholds t1 < t2 < ... cut its score f:
P(grade >= j) = sigmoid(f - tj). The expected grade is the sum of these, and the last is the tail probability that selection goes by.

Grades: 0 for a toxic text, 1 for one of low quality, 2 for one of good quality.

Edge cases: a null or wordless text has expected grade 0, tail probability 0 and is not selected. Labels without an id or a quality are not
learned from, a null toxic counts as 0, and an id labelled twice gives two training rows. Without labels, or with one grade only, every
text gets the same probabilities. Rows are kept one for one; input columns named like the outputs are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import LOWER, SEPARATOR, pieces, small_batches, staged, without, word_hashes

BUCKETS = 1 << 16
GRADES = 3
_SIGN = np.ones(256, bool)
_SIGN[48:58] = _SIGN[65:91] = _SIGN[97:123] = _SIGN[128:] = False
_SIGN &= ~SEPARATOR
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of each row, one after the other, and their n + 1 bounds."""
    n = len(at) - 1
    kind = np.where(SEPARATOR[data], 0, np.where(_SIGN[data], 2, 1)).astype(np.int8)
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    change = np.ones(len(data), bool)
    if len(data):
        change[1:] = (kind[1:] != kind[:-1]) | edge[1:-1]
    start = np.flatnonzero(change)
    end = np.append(start[1:], len(data)) if len(start) else start
    solid = kind[start] > 0
    start, end = start[solid], end[solid]
    row = np.searchsorted(at, start, "right") - 1
    bucket = (word_hashes(LOWER[data], start, end) % np.uint64(BUCKETS)).astype(np.int64)
    size = np.maximum(1, np.diff(at))
    sums = lambda mask: (lambda c: (c[at[1:]] - c[at[:-1]]) / size)(np.concatenate([[0], np.cumsum(mask, dtype=np.int64)]))
    busy = np.flatnonzero(np.bincount(row, minlength=n))
    shares = [(np.minimum(9, sums(mask)[busy] * 20).astype(np.int64) + 10 * i) for i, mask in enumerate((_CAPITAL[data], _SIGN[data]))]
    key = np.concatenate([row * BUCKETS + bucket, *(busy * BUCKETS + s for s in shares)])
    key = np.unique(key)
    return key % BUCKETS, np.searchsorted(key // BUCKETS, np.arange(n + 1))


@dataclass
class CumulativeLink:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ..."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None] - score[:, None], -40, 40)))

    def score(self, buckets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(self.weights[buckets])])
        return sums[bounds[1:]] - sums[bounds[:-1]]


def fit(rows: list[np.ndarray], grades: np.ndarray, sample_weight: np.ndarray, epochs: int = 20, batch: int = 32, rate: float = 0.1, decay: float = 1e-4, seed: int = 9, least: int = 10) -> CumulativeLink:
    """AdaGrad on the likelihood of the grades; thresholds stay in order as sums of a first one and positive gaps.

    Buckets that fewer than `least` of the rows hold keep the weight 0: a word seen that rarely would only tell its rows apart.
    """
    seen = np.bincount(np.concatenate([*rows, np.zeros(0, np.int32)]).astype(np.int64), minlength=BUCKETS)
    rows = [r[seen[r] >= least] for r in rows]
    share = np.array([max(1e-3, sample_weight[grades >= j].sum() / max(1e-9, sample_weight.sum())) if len(rows) else 0.5 for j in range(1, GRADES)])
    share = np.clip(np.minimum.accumulate(share), 1e-3, 1 - 1e-3)
    cut = -np.log(share / (1 - share))
    free = np.concatenate([cut[:1], np.log(np.maximum(1e-2, np.diff(cut)))])
    w, w2, f2 = np.zeros(BUCKETS), np.full(BUCKETS, 1e-2), np.full(GRADES - 1, 1e-2)
    ordered = lambda: np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
    if len(rows) and len(set(grades.tolist())) > 1:
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // batch)):
                size = np.array([len(rows[i]) for i in part])
                buckets = np.concatenate([rows[i] for i in part])
                owner = np.repeat(np.arange(len(part)), size)
                f = np.bincount(owner, w[buckets], len(part))
                edges = np.concatenate([[-np.inf], ordered(), [np.inf]])
                y = grades[part]
                up, low = 1 / (1 + np.exp(np.clip(f - edges[y + 1], -40, 40))), 1 / (1 + np.exp(np.clip(f - edges[y], -40, 40)))
                p = np.maximum(up - low, 1e-9)
                du, dl = up * (1 - up), low * (1 - low)
                scale = sample_weight[part] / len(part)
                df = (du - dl) / p * scale  # of the loss by f
                used, place = np.unique(buckets, return_inverse=True)
                g = np.bincount(place, df[owner]) + decay * w[used]
                w2[used] += g * g
                w[used] -= rate * g / np.sqrt(w2[used])
                dt = np.zeros(GRADES + 1)
                np.add.at(dt, y + 1, -du / p * scale)
                np.add.at(dt, y, dl / p * scale)
                later = np.cumsum(dt[1:GRADES][::-1])[::-1]  # a gap moves all thresholds above it
                g = later * np.concatenate([[1], np.exp(free[1:])])
                f2 += g * g
                free -= rate * g / np.sqrt(f2)
    return CumulativeLink(w, ordered())


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", max_docs: int = 12_000, max_features: int = 20_000_000, seed: int = 9) -> CumulativeLink:
    """Fits on at most `max_docs` labelled documents, equally many of each grade, drawn by a hash of the key and weighted back to their shares.

    If the documents drawn have more than `max_features` distinct words in all (80 MB), those first by hash that stay within it are learned from.
    """
    small_batches()
    grade = F.when(F.coalesce(F.col("toxic"), F.lit(0)) == 1, 0).when(F.col("quality") == 1, 2).otherwise(1)
    rated = labels.filter(F.col(key).isNotNull() & F.col("quality").isNotNull()).select(F.col(key).alias("rated_id"), grade.alias("grade"))
    counts = {r[0]: r[1] for r in rated.groupBy("grade").count().collect()}
    if not counts:
        return fit([], np.zeros(0, int), np.zeros(0))
    each = max(1, max_docs // len(counts))
    share = F.create_map(*[F.lit(v) for g, c in counts.items() for v in (g, int(min(1.0, each / c) * 1_000_000))])
    drawn = rated.filter(F.pmod(F.xxhash64("rated_id", F.lit(seed)), F.lit(1_000_000)) < share[F.col("grade")])

    def cut(batches):
        for b in batches:
            for first, data, at in pieces(b.column(2)):
                buckets, bounds = features(data, at)
                rows = [buckets[bounds[i] : bounds[i + 1]].astype(np.int32).tobytes() for i in range(len(at) - 1)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(rows)), b.column(1).slice(first, len(rows)), pa.array(rows, pa.binary())], ["id", "grade", "x"])

    # the draw is bounded by max_docs (give or take its own chance), so it may go to every task that reads documents
    some = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).filter(F.col("id").isNotNull()).join(F.broadcast(drawn), F.col("id") == F.col("rated_id")).select(F.col("id").cast("long").alias("id"), "grade", "text")
    kept = staged(some.mapInArrow(cut, "id long, grade int, x binary"), "rated")
    if (kept.agg(F.sum(F.octet_length("x"))).first()[0] or 0) > 4 * max_features:
        place = F.xxhash64("id", F.lit(seed), F.lit(2))
        sizes = kept.select(place.alias("h"), F.octet_length("x").alias("n")).orderBy("h").collect()  # at most max_docs rows, give or take chance
        ends = np.cumsum([r[1] for r in sizes])
        kept = kept.filter(place < F.lit(sizes[int(np.searchsorted(ends, 4 * max_features, "right"))][0]))
    got = sorted(kept.collect(), key=lambda r: (r[0], r[1], bytes(r[2])))
    rows, grades = [np.frombuffer(bytes(r[2]), np.int32) for r in got], np.array([r[1] for r in got], int)
    seen = np.maximum(1, np.bincount(grades, minlength=GRADES))
    weight = np.array([counts.get(g, 0) for g in range(GRADES)]) / seen
    return fit(rows, grades, (weight / max(1e-9, weight[grades].mean()))[grades] if len(grades) else np.zeros(0))


def grade(df: DataFrame, model: CumulativeLink, text: str = "text", least: float = 0.5) -> DataFrame:
    """Adds expected_grade (0 to 2), tail_prob (of the best grade) and selected (tail_prob >= least) to every row."""

    small_batches()
    @F.arrow_udf("expected_grade double, tail_prob double")
    def rate(texts: pa.Array) -> pa.Array:
        mean, tail = np.zeros(len(texts)), np.zeros(len(texts))
        for first, data, at in pieces(texts):
            buckets, bounds = features(data, at)
            p = model.at_least(model.score(buckets, bounds)) * (np.diff(bounds) > 0)[:, None]
            mean[first : first + len(p)], tail[first : first + len(p)] = p.sum(1), p[:, -1]
        return pa.StructArray.from_arrays([pa.array(mean), pa.array(tail)], ["expected_grade", "tail_prob"])

    own = without(df, "expected_grade", "tail_prob", "selected")
    rated = own.select("*", rate(F.col(text)).alias("expected_grade"))
    out = rated.select(*[f"`{c}`" for c in own.columns], F.col("expected_grade.tail_prob").alias("tail_prob"), F.col("expected_grade.expected_grade").alias("expected_grade"))
    return out.withColumn("selected", F.col("tail_prob") >= least)
