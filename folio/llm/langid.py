"""Language ID: a byte convolutional network trained in numpy, applied to fixed-length windows.

Every text is cut into windows of WINDOW bytes, the last one filled up with spaces. A window's bytes are embedded, filters of several
widths slide over them, each filter keeps its largest response, and a softmax gives the languages' probabilities. A text's probabilities
are the mean over all its windows, weighted by the bytes in them.

Edge cases: a null text, or one without a letter, is `und` with score 0. An empty training set gives a model that answers `und` always.
Rows are kept one for one, repeated ones too; input columns named like the outputs are replaced. Ties go to the language first in order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import pieces, small_batches, utf8, without

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
UNKNOWN = "und"


@dataclass
class ByteConvNet:
    """langs, in order; tables[w][k]: what byte b at place k of a window of width w adds to each filter; dense: filters to languages."""

    langs: list[str]
    params: dict[str, np.ndarray]

    def tables(self) -> dict[int, np.ndarray]:
        p = self.params
        return {w: np.einsum("be,kef->kbf", p["embed"], p[f"conv{w}"]).astype(np.float32) for w in WIDTHS}

    def responses(self, x: np.ndarray, tables: dict[int, np.ndarray], where: bool = False):
        """Largest response of each filter to each window of x, and where it is."""
        top, at = [], []
        for w in WIDTHS:
            n = x.shape[1] - w + 1
            total = tables[w][0][x[:, :n]]
            for k in range(1, w):
                total += tables[w][k][x[:, k : k + n]]
            if where:
                at.append(total.argmax(1))
                top.append(np.take_along_axis(total, at[-1][:, None, :], 1)[:, 0])
            else:
                top.append(total.max(1))
        return np.concatenate(top, 1) + self.params["bias"], at

    def probabilities(self, x: np.ndarray, tables=None, step: int = 128) -> np.ndarray:
        tables, out = tables or self.tables(), np.empty((len(x), len(self.langs)))
        for i in range(0, len(x), step):
            out[i : i + step] = softmax(np.maximum(self.responses(x[i : i + step], tables)[0], 0) @ self.params["dense"] + self.params["out"])
        return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def window_blocks(data: np.ndarray, at: np.ndarray, most: int = 4096):
    """Yields the windows of all rows, `most` at a time, the row of each, and the bytes in it; a text of any length is cut as it is read."""
    n = -(-np.diff(at) // WINDOW)
    ends = np.cumsum(n)
    for i in range(0, int(ends[-1]) if len(ends) else 0, most):
        number = np.arange(i, min(i + most, ends[-1]))
        row = np.searchsorted(ends, number, "right")
        start = at[row] + (number - ends[row] + n[row]) * WINDOW
        size = np.minimum(WINDOW, at[row + 1] - start)
        x = data[np.minimum(start[:, None] + np.arange(WINDOW), len(data) - 1)]
        x[np.arange(WINDOW) >= size[:, None]] = 32
        yield x, row, size


def windows(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows at once."""
    return next(window_blocks(data, at, 1 << 62), (np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)))


def fit(x: np.ndarray, y: np.ndarray, langs: list[str], epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 7) -> ByteConvNet:
    """Trains on windows x with language numbers y by Adam; rare languages weigh as much as common ones."""
    rng = np.random.default_rng(seed)
    p = {"embed": rng.normal(0, 0.5, (256, EMBEDDING)), "bias": np.zeros(len(WIDTHS) * FILTERS), "dense": rng.normal(0, 0.2, (len(WIDTHS) * FILTERS, len(langs))), "out": np.zeros(len(langs))}
    p |= {f"conv{w}": rng.normal(0, 0.5 / np.sqrt(w), (w, EMBEDDING, FILTERS)) for w in WIDTHS}
    model = ByteConvNet(langs, p)
    if len(langs) < 2:
        return model
    weight = (len(y) / len(langs) / np.maximum(1, np.bincount(y, minlength=len(langs))))[y]
    first, second, t = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            rows = order[i : i + batch]
            tables = model.tables()
            top, at = model.responses(x[rows], tables, where=True)
            hidden = np.maximum(top, 0)
            delta = softmax(hidden @ p["dense"] + p["out"])
            delta[np.arange(len(rows)), y[rows]] -= 1
            delta *= weight[rows, None] / len(rows)
            back = (delta @ p["dense"].T) * (top > 0)
            grad = {"dense": hidden.T @ delta, "out": delta.sum(0), "bias": back.sum(0), "embed": np.zeros_like(p["embed"])}
            for j, w in enumerate(WIDTHS):
                g = back[:, j * FILTERS : (j + 1) * FILTERS]
                grad[f"conv{w}"] = np.empty_like(p[f"conv{w}"])
                for k in range(w):  # only the bytes under a filter's largest response move it
                    table = np.zeros((256, FILTERS))
                    np.add.at(table, (x[rows[:, None], at[j] + k], np.arange(FILTERS)[None]), g)
                    grad["embed"] += table @ p[f"conv{w}"][k].T
                    grad[f"conv{w}"][k] = p["embed"].T @ table
            t += 1
            for k, g in grad.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                p[k] -= rate * (1 - epoch / epochs) * first[k] / (1 - 0.9**t) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return model


def train(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", max_docs: int = 3000, max_langs: int = 500, seed: int = 7) -> ByteConvNet:
    """Fits the network on at most `max_docs` rows with a language, equally many for each, drawn by a hash of the key; three windows of each.

    Of more than `max_langs` languages the most frequent ones are learned (then the first in order); with them the draw stays within its bound. The bound is on what is trained on only: the counts that set the draw cover all rows, and the draw is the same at every size.
    """
    small_batches()
    known = df.filter(F.col(lang).isNotNull() & F.coalesce(F.col(text), F.lit("")).rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in known.groupBy(F.col(lang).alias("l")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "l").limit(max_langs).collect()}
    langs = sorted(counts)
    if not langs:
        return fit(np.zeros((0, WINDOW), np.uint8), np.zeros(0, int), [])
    each = max(1, max_docs // len(langs))
    drawn = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000))
    share = F.create_map(*[F.lit(v) for k in langs for v in (k, int(min(1.0, 1.3 * each / counts[k]) * 1_000_000))])
    schema = "lang string, draw long, first binary, middle binary, short binary"

    def cut(batches):
        for b in batches:
            out = {"lang": b.column(0), "draw": b.column(1), "first": [], "middle": [], "short": []}
            data, at = utf8(b.column(2))
            for i, draw in enumerate(b.column(1).to_numpy(zero_copy_only=False)):
                s, e = int(at[i]), int(at[i + 1])
                mid, n = s + max(0, (e - s - WINDOW) * (int(draw) % 97) // 97), 12 + int(draw) % 50
                for name, a, size in (("first", s, WINDOW), ("middle", mid, WINDOW), ("short", mid, n)):
                    out[name].append(data[a : min(e, a + size)].tobytes())
            yield pa.RecordBatch.from_pydict(out, pa.schema([("lang", pa.string()), ("draw", pa.int64()), *((n, pa.binary()) for n in ("first", "middle", "short"))]))

    sample = known.filter(drawn < share[F.col(lang)]).select(F.col(lang).alias("lang"), F.xxhash64(F.col(key), F.lit(seed), F.lit(1)).alias("draw"), F.col(text).alias("text"))
    rows = sorted(sample.mapInArrow(cut, schema).collect(), key=lambda r: (r[0], r[1], bytes(r[2])))
    x, y, seen = [], [], dict.fromkeys(langs, 0)
    for r in rows:
        if seen[r[0]] < each:
            seen[r[0]] += 1
            for w in r[2:]:
                x.append(np.frombuffer(bytes(w).ljust(WINDOW, b" "), np.uint8))
                y.append(langs.index(r[0]))
    return fit(np.array(x).reshape(-1, WINDOW), np.array(y, int), langs)


def predict(df: DataFrame, model: ByteConvNet, text: str = "text") -> DataFrame:
    """Adds lang_pred and score (mean probability of that language over the whole text's windows) to every row."""
    small_batches()
    langs, tables = model.langs, model.tables() if model.langs else None

    @F.arrow_udf("lang_pred string, score double")
    def guess(texts: pa.Array) -> pa.Array:
        label, score = [], np.zeros(len(texts))
        for first, data, at in pieces(texts):
            total = np.zeros((len(at) - 1, len(langs)))
            for x, row, size in window_blocks(data, at):
                np.add.at(total, row, model.probabilities(x, tables) * size[:, None])
            total /= np.maximum(1, np.diff(at))[:, None]
            best = total.argmax(1)
            label += [langs[i] for i in best]
            score[first : first + len(best)] = np.minimum(1, total[np.arange(len(best)), best])
        return pa.StructArray.from_arrays([pa.array(label, pa.string()), pa.array(score)], ["lang_pred", "score"])

    readable = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    unknown = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    own = without(df, "lang_pred", "score")
    if not langs:
        return own.select("*", unknown["lang_pred"].alias("lang_pred"), unknown["score"].alias("score"))
    found = own.withColumn("lang_pred", F.when(readable, guess(F.col(text))).otherwise(unknown))
    return found.select(*[f"`{c}`" for c in own.columns], F.col("lang_pred.score").alias("score"), F.col("lang_pred.lang_pred").alias("lang_pred"))
