"""Quality classifier: a factorisation machine over hashed words and text statistics.

Features of a text: its words, hashed into ``BUCKETS`` buckets with counts scaled to
length one, and ``STATS`` dense statistics of structure (shares of letters, capitals,
digits, punctuation and line feeds, repeated words and lines, word and line
lengths, shouting and symbol runs) and metadata (size, bytes a character). The
score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

so all pairwise interactions cost time linear in the features of the text.

Training uses a bounded sample: at most ``sample`` labelled documents outside
the held-out third, those of the smallest seeded hash of their id. Their sparse
features (not their texts) go to the driver, at most ``BUCKETS`` numbers each. Scoring is
one pass over the scan with no shuffle, and reads every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import held_out, text_or_empty
from marketpulse.llm.tokens import slices

BUCKETS = 1 << 13
STATS = 18
FACTORS = 8
SAMPLE = 4096
_CACHED = 100_000


class _Buckets(dict):
    def __missing__(self, word):
        self[word] = b = crc32(word.lower().encode("utf-8", "surrogatepass")) % BUCKETS
        return b


_BUCKETS = _Buckets()


def forget_words() -> None:
    _BUCKETS.clear()


def _shares(text: str, words: list[str]) -> list[float]:
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    hist = np.bincount(raw, minlength=256)
    n, w = max(len(raw), 1), max(len(words), 1)
    letters = hist[65:91].sum() + hist[97:123].sum()
    lines = [x for x in text.split("\n") if x.strip()]
    marks = hist[33:48].sum() + hist[58:65].sum() + hist[91:97].sum() + hist[123:127].sum()
    return [
        hist[65:91].sum() / n, hist[97:123].sum() / n, hist[48:58].sum() / n, marks / n, hist[128:].sum() / n,
        hist[10] / n * 50, (hist[33] + hist[63]) / w, hist[46] / w, hist[44] / w,
        (hist[124] + hist[42] + hist[35] + hist[36] + hist[37] + hist[38]) / w,
        hist[65:91].sum() / max(letters, 1), len(set(words)) / w, len(set(lines)) / max(len(lines), 1),
        np.log1p(n / w), np.log1p(w / max(len(lines), 1)), np.log1p(len(words)), len(raw) / max(len(text), 1) - 1,
        float(not words),
    ]


def features(texts: list[str]):
    """Sparse words and dense statistics: ``(row, bucket, value, stats)``, rows in order."""
    if len(_BUCKETS) > _CACHED:
        _BUCKETS.clear()
    keys, stats = [], np.zeros((len(texts), STATS))
    for i, text in enumerate(texts):
        words = text.split()
        stats[i] = _shares(text, words)
        keys.append(np.fromiter(map(_BUCKETS.__getitem__, words), np.int64, len(words)) + i * BUCKETS)
    key, count = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
    row, bucket = key // BUCKETS, key % BUCKETS
    value = np.log1p(count)
    length = np.sqrt(np.bincount(row, value * value, len(texts)))
    return row, bucket, value / length[row], stats


@dataclass
class Model:
    """``w0``; per feature a weight and ``FACTORS`` factors; the statistics' scaling."""

    w0: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def dense(self, stats: np.ndarray) -> np.ndarray:
        return np.clip((stats - self.mean) / self.scale, -4, 4) / 4

    def margins(self, row, bucket, value, dense) -> tuple[np.ndarray, np.ndarray]:
        """``(z, S)``: the margins and the factor sums of each row."""
        n = len(dense)
        words, rest = self.v[:BUCKETS], self.v[BUCKETS:]
        linear = np.bincount(row, self.w[bucket] * value, n) + dense @ self.w[BUCKETS:]
        sums, squares = dense @ rest, (dense ** 2) @ (rest ** 2)
        for f in range(self.v.shape[1]):
            part = words[bucket, f] * value
            sums[:, f] += np.bincount(row, part, n)
            squares[:, f] += np.bincount(row, part * part, n)
        return self.w0 + linear + 0.5 * (sums ** 2 - squares).sum(1), sums

    def scores(self, texts: list[str]) -> np.ndarray:
        out = []
        for _, part in slices(texts, 1 << 20):
            row, bucket, value, stats = features(part)
            z, _ = self.margins(row, bucket, value, self.dense(stats))
            out.append(1 / (1 + np.exp(-np.clip(z, -60, 60))))
        return np.concatenate(out) if out else np.zeros(0)


def fit(rows: list[tuple], labels: np.ndarray, epochs: int = 20, steps: int = 800, batch: int = 128, rate: float = 0.1,
        decay: float = 1e-4, seed: int = 7) -> Model:
    """Fit by AdaGrad on the log loss, over ``epochs`` passes and at least ``steps`` batches.

    ``rows``: per document ``(buckets, values, stats)``."""
    rng = np.random.default_rng(seed)
    n = len(rows)
    share = (labels.sum() + 1) / (n + 2)
    stats = np.array([r[2] for r in rows]).reshape(n, STATS)
    model = Model(float(np.log(share / (1 - share))), np.zeros(BUCKETS + STATS),
                  rng.normal(0, 0.05, (BUCKETS + STATS, FACTORS)),
                  stats.mean(0) if n else np.zeros(STATS), (stats.std(0) if n else np.ones(STATS)) + 1e-6)
    if not n or share in (0, 1) or labels.min() == labels.max():
        model.v[:] = 0
        return model
    past_w, past_v, past_0 = np.full(model.w.shape, 1e-3), np.full(model.v.shape, 1e-3), 1e-3
    for _ in range(max(epochs, -(-steps * batch // n))):
        order = rng.permutation(n)
        for at in range(0, n, batch):
            pick = order[at:at + batch]
            m = len(pick)
            row = np.repeat(np.arange(m), [len(rows[i][0]) for i in pick])
            bucket = np.concatenate([rows[i][0] for i in pick])
            value = np.concatenate([rows[i][1] for i in pick])
            dense = model.dense(stats[pick])
            z, sums = model.margins(row, bucket, value, dense)
            g = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels[pick]) / m
            gx = g[row] * value
            grad_w = np.concatenate([np.bincount(bucket, gx, BUCKETS), g @ dense]) + decay * model.w
            grad_v = decay * model.v
            own = np.bincount(bucket, gx * value, BUCKETS)
            for f in range(FACTORS):
                grad_v[:BUCKETS, f] += np.bincount(bucket, gx * sums[row, f], BUCKETS) - own * model.v[:BUCKETS, f]
            grad_v[BUCKETS:] += dense.T @ (g[:, None] * sums) - (g @ dense ** 2)[:, None] * model.v[BUCKETS:]
            past_w += grad_w ** 2
            past_v += grad_v ** 2
            past_0 += g.sum() ** 2
            model.w -= rate * grad_w / np.sqrt(past_w)
            model.v -= rate * grad_v / np.sqrt(past_v)
            model.w0 -= rate * g.sum() / np.sqrt(past_0)
    return model


def _sparse_rows(frames):
    for frame in frames:
        out = []
        for doc, quality, text in zip(frame["doc_id"], frame["quality"], frame["text"]):
            _, bucket, value, stats = features([text])
            out.append((doc, quality, bucket.astype("<i4").tobytes(), value.astype("<f4").tobytes(), stats[0].tobytes()))
        yield pd.DataFrame(out, columns=["doc_id", "quality", "buckets", "amounts", "stats"])
    forget_words()


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents that are not held out.

    Rows without id or label teach nothing; no usable rows, or rows of one
    class, give a constant score (the smoothed share of that class, 0.5 for none).
    """
    picked = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("quality"))
              .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out("doc_id", 3, 1))
              .orderBy(F.xxhash64(F.lit("fm"), "doc_id"), "doc_id", "quality").limit(sample))
    rows = (docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
            .join(F.broadcast(picked), "doc_id")  # at most ``sample`` narrow rows
            .mapInPandas(_sparse_rows, "doc_id long, quality int, buckets binary, amounts binary, stats binary")
            .orderBy(F.xxhash64(F.lit("fm"), "doc_id"), "doc_id", "quality", "buckets", "amounts").limit(sample)
            .collect())
    sparse = [(np.frombuffer(bytes(r.buckets), "<i4").astype(np.int64), np.frombuffer(bytes(r.amounts), "<f4").astype(float),
               np.frombuffer(bytes(r.stats))) for r in rows]
    return fit(sparse, np.array([float(r.quality > 0) for r in rows]))


def with_score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """Adds column ``name`` (0 to 1) to every row; null text counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: fixed numbers of buckets and factors

    @F.pandas_udf("double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.scores(texts.tolist()))
        forget_words()  # the worker lives on, for other work

    return docs.withColumn(name, udf(text_or_empty(text_col)))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            sample: int = SAMPLE) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted``.

    Scores depend on the text alone: repeated texts get the same score, null
    and empty texts that of a text without words. Extra columns are ignored;
    an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    scored = with_score(rows, train(docs, labels, id_col, text_col, sample=sample), "_text")
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
