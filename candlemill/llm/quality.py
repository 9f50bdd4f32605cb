"""Quality: ridge regression on random Fourier features of document statistics.

Random Fourier features approximate a Gaussian kernel over standardized statistics of a
text. Each task sums its part of the normal equations, the sums are added up, and one small
system is solved. Isotonic regression turns the ridge score into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import crc_of_id, saved
from candlemill.llm.words import U64, utf8_runs, word_hashes

FEATURES = 256
RIDGE = 1e-3
BINS = 1000
SEED = 5
# Tasks whose sums are added at a time.
ADDED_TASKS = 16

_CLASSES = {
    "lower": [*range(0x61, 0x7B)],
    "upper": [*range(0x41, 0x5B)],
    "digit": [*range(0x30, 0x3A)],
    "space": [0x20, 0x09],
    "line": [0x0A],
    "stop": [0x2E, 0x2C],
    "mark": [0x21, 0x3F],
    "quote": [0x22, 0x27, 0x28, 0x29, 0x2D, 0x3A, 0x3B],
    "symbol": [0x23, 0x24, 0x25, 0x26, 0x2A, 0x2B, 0x2F, *range(0x3C, 0x3F), 0x40, *range(0x5B, 0x61), *range(0x7B, 0x7F)],
    "control": [*range(0, 9), *range(0x0B, 0x20), 0x7F],
    "beyond": [*range(0x80, 0x100)],
}
STATISTICS = [
    *_CLASSES, "bytes", "words", "word_bytes", "distinct", "repeated", "most", "pairs", "runs",
]


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text, in order; all zero for a text without bytes."""
    lookup = np.full(256, len(_CLASSES), np.uint8)
    for i, members in enumerate(_CLASSES.values()):
        lookup[members] = i
    rows = []
    for _, _, data, offsets in utf8_runs(texts):
        hashes, first = word_hashes(data, offsets)
        kinds = lookup[data]
        same = np.concatenate([[False], data[1:] == data[:-1]])
        for t in range(len(offsets) - 1):
            a, b = int(offsets[t]), int(offsets[t + 1])
            row = np.zeros(len(STATISTICS))
            rows.append(row)
            if a == b:
                continue
            n = b - a
            shares = np.bincount(kinds[a:b], minlength=len(_CLASSES) + 1)
            row[: len(_CLASSES)] = np.sqrt(shares[: len(_CLASSES)] / n)
            words = hashes[first[t] : first[t + 1]]
            w = len(words)
            row[len(_CLASSES)] = np.log(n)
            row[len(_CLASSES) + 7] = same[a + 1 : b].sum() / n
            if not w:
                continue
            _, counts = np.unique(words, return_counts=True)
            pairs = len(np.unique(words[1:] * U64(3) + words[:-1])) if w > 1 else 1
            row[len(_CLASSES) + 1 : len(_CLASSES) + 7] = (
                np.log(w),
                np.log((n - shares[3] - shares[4]) / w),
                np.log(len(counts) / w),
                (words[1:] == words[:-1]).sum() / w,
                counts.max() / w,
                np.log(pairs / max(1, w - 1)),
            )
    return np.array(rows).reshape(-1, len(STATISTICS))


def _statistics_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = statistics(batch.column(1))
        flat = pa.array(rows.ravel())
        ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(STATISTICS))
        lists = pa.ListArray.from_arrays(ends, flat)
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "x"])


class Fourier:
    """Seeded random features of standardized statistics, with a constant one in front."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int, seed: int):
        rng = np.random.default_rng(seed)
        n = len(mean)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.weights = rng.normal(0, 1 / np.sqrt(n), (n, features))
        self.phases = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        waves = np.cos(z @ self.weights + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([np.ones((len(z), 1)), waves])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def _summed(rows: DataFrame, sums) -> np.ndarray:
    """Adds the vectors that ``sums`` makes of each batch's columns (x, y).

    Each task adds its batches, groups of tasks are added next, and so on: no step holds
    more than ADDED_TASKS vectors, and one comes to the driver.
    """

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            if batch.num_rows:
                y = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
                total = total + sums(_matrix(batch.column(0)), y)
        if not np.isscalar(total):
            yield pa.RecordBatch.from_pydict({"v": [total.tobytes()]})

    def add(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(v) for v in part["v"])
        return pd.DataFrame({"g": [key[0] // ADDED_TASKS], "v": [total.tobytes()]})

    parts = rows.select("x", "y").mapInArrow(of_task, "v binary")
    parts = saved(parts.select(F.spark_partition_id().cast("long").alias("g"), "v"), "sums")
    most = parts.agg(F.max("g")).first()[0]
    if most is None:
        return np.zeros(0)
    while most > 0:
        parts = parts.groupBy(F.floor(F.col("g") / ADDED_TASKS).cast("long").alias("k"))
        parts = saved(parts.applyInPandas(lambda k, p: add((k[0] * ADDED_TASKS,), p), "g long, v binary"), "sums")
        most //= ADDED_TASKS
    return sum(np.frombuffer(r.v) for r in parts.collect())


def isotonic(score: np.ndarray, good: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Pool-adjacent-violators: the rising values nearest to good / count by score."""
    blocks: list[list[float]] = []
    for g, c in zip(good, count):
        blocks.append([g, c, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g2, c2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g2, blocks[-1][1] + c2, blocks[-1][2] + n2]
    return np.concatenate([np.full(int(n), g / c) for g, c, n in blocks]) if blocks else np.zeros(0)


class Model:
    """Features, ridge weights and the calibration's knots."""

    def __init__(self, fourier: Fourier | None, weights: np.ndarray, prior: float):
        self.fourier, self.weights, self.prior = fourier, weights, prior
        self.knots = self.values = None

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.fourier is None:
            return np.full(len(x), self.prior)
        raw = self.raw(x)
        level = np.interp(raw, self.knots, self.values)
        # Ties of a level keep the order of the ridge score.
        return np.clip(0.998 * level + 0.002 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def fit(rows: DataFrame) -> Model:
    """A model from (x, y): statistics and label of the rows to learn from."""
    n = len(STATISTICS)

    def moments(x, y):
        return np.concatenate([[len(x), y.sum()], x.sum(axis=0), (x * x).sum(axis=0)])

    sums = _summed(rows, moments)
    if not len(sums) or not 0 < sums[1] < sums[0]:
        return Model(None, np.zeros(0), float(sums[1] / sums[0]) if len(sums) else 0.5)
    count = sums[0]
    mean = sums[2 : 2 + n] / count
    spread = np.sqrt(np.maximum(0, sums[2 + n :] / count - mean**2))
    fourier = Fourier(mean, spread, FEATURES, SEED)

    def normal(x, y):
        z = fourier(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = _summed(rows, normal)
    m = FEATURES + 1
    gram, right = sums[: m * m].reshape(m, m), sums[m * m :]
    keep = np.eye(m) * RIDGE * count
    keep[0, 0] = 0
    model = Model(fourier, np.linalg.solve(gram + keep, right), sums[-1])

    def bins(x, y):
        at = np.clip((model.raw(x) + 0.5) / 2 * BINS, 0, BINS - 1).astype(int)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, y, BINS)])

    sums = _summed(rows, bins)
    used = np.flatnonzero(sums[:BINS])
    model.knots = (used + 0.5) / BINS * 2 - 0.5
    model.values = isotonic(model.knots, sums[BINS:][used], sums[:BINS][used])
    return model


def held_out_fold():
    return F.coalesce(crc_of_id() % 3 == 1, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text, ...).

    ``score`` in [0, 1] rises with the likelihood of label 1; ``predicted`` is 1 from 0.5
    on. Learns from all rows whose id has a label in ``labels`` (doc_id, quality) and does
    not lie in the held-out fold, whose crc32 of the id modulo 3 is 1; labels and other
    columns are no inputs of a score. Repeated labels of a document count once, with the
    larger value. Null and empty texts have statistics of zero and are scored by them. With
    one label only, or none, every score is the share of label 1, or 0.5.
    """
    stats = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    stats = saved(stats.mapInArrow(_statistics_table, "doc_id long, x array<double>"), "statistics")
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max("quality").cast("double").alias("y"))
    rows = saved(stats.where(~held_out_fold()).join(known, "doc_id").select("x", "y"), "learn")
    model = fit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = pa.array(model.score(_matrix(batch.column(1))), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), p], names=["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id long, score double")
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out_fold().alias("held_out"), "score", predicted)
