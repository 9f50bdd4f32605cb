"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is a bag of its character n-grams and of itself, each hashed to an embedding. The
embeddings of a passage of a few words are averaged and go through a linear softmax; the
passage most likely toxic speaks for its document. Embeddings and softmax are trained
jointly in numpy on a bounded sample of labelled documents, so an unseen spelling is judged
by the n-grams that it shares with known words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import crc_of_id
from candlemill.llm.words import U64, mix, utf8_runs

BUCKETS = 1 << 17
GRAMS = (3, 4, 5)
DIMENSIONS = 8
PASSAGE_WORDS = 8
STRIDE = 4
# Documents of each label in the training sample, at most.
SAMPLE_TOXIC = 1000
SAMPLE_CLEAN = 2000
FIRST_ROUNDS = 8
ROUNDS = 12
STEPS = 10
SEED = 6
THRESHOLD = 0.3
LOWEST = -50.0

# Texts that are lower-cased and scored at a time.
_SLICE = 256
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class Model:
    """The softmax margin of each n-gram's embedding, and the bias."""

    margin: np.ndarray
    bias: float


def word_grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words of a run of lower-cased texts and the buckets of their n-grams.

    Returns the words' hashes, where each text's words begin, the n-grams' buckets, and the
    word of each n-gram (ascending). N-grams may take in the edge of a word on either side.
    """
    none = np.zeros(0, np.int64)
    # One edge byte between texts keeps their words apart.
    n = len(data) + len(offsets)
    where = np.arange(len(data)) + np.repeat(np.arange(1, len(offsets)), np.diff(offsets))
    flat = np.zeros(n, np.uint8)
    flat[where] = data
    inside = _WORD_BYTE[flat]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    first = np.searchsorted(starts, offsets + np.arange(len(offsets)))
    if not len(starts):
        return none.astype(U64), first, none.astype(np.int32), none
    flat = np.where(inside, flat, 0).astype(np.uint32) + np.uint32(1)
    outside = np.concatenate([[0], np.cumsum(~inside)])
    word_at = np.cumsum(np.bincount(starts, minlength=n)) - 1
    buckets, words = [], []
    for size in GRAMS:
        code = np.zeros(n - size + 1, np.uint32)
        for j in range(size):
            code = code * np.uint32(0x01000193) ^ flat[j : n - size + 1 + j]
        code = code * np.uint32(0x9E3779B1)
        code ^= code >> np.uint32(15)
        within = outside[size - 1 : n] == outside[1 : n - size + 2]
        at = np.flatnonzero(within)
        buckets.append((code[at] * np.uint32(0x85EBCA77) >> np.uint32(15)).astype(np.int32))
        words.append(word_at[at + 1])
    spelled = np.add.reduceat(
        mix(flat.astype(U64) + (np.arange(n, dtype=U64) - starts[word_at].astype(U64)) * U64(512))
        * inside,
        starts,
    )
    buckets.append((spelled >> U64(47)).astype(np.int32))
    words.append(np.arange(len(starts)))
    buckets, words = np.concatenate(buckets), np.concatenate(words)
    order = np.argsort(words, kind="stable")
    return spelled, first, buckets[order], words[order]


def _passages(first: np.ndarray, words: int, stride: int) -> tuple[np.ndarray, ...]:
    """(from, to, text) of the passages of texts whose words begin at ``first``.

    The last passage of a text ends with it; a text shorter than a passage is one.
    """
    length = np.diff(first)
    count = np.where(length > 0, np.maximum(0, -(-(length - words) // stride)) + 1, 0)
    text = np.repeat(np.arange(len(length)), count)
    step = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = np.minimum(step * stride, np.maximum(length - words, 0)[text])
    low = first[:-1][text] + start
    return low, np.minimum(low + words, first[1:][text]), text


def margins(model: Model, texts: pa.Array) -> np.ndarray:
    """The largest passage margin of each text; a text without words has the lowest there is."""
    if len(texts) > _SLICE:
        parts = range(0, len(texts), _SLICE)
        return np.concatenate([margins(model, texts.slice(at, _SLICE)) for at in parts])
    out = []
    for _, _, data, offsets in utf8_runs(pc.utf8_lower(texts)):
        _, first, buckets, words = word_grams(data, offsets)
        best = np.full(len(offsets) - 1, LOWEST)
        n = int(first[-1])
        if n:
            total = np.concatenate([[0.0], np.cumsum(np.bincount(words, model.margin[buckets], n))])
            grams = np.concatenate([[0], np.cumsum(np.bincount(words, minlength=n))])
            low, high, text = _passages(first, PASSAGE_WORDS, STRIDE)
            margin = model.bias + (total[high] - total[low]) / (grams[high] - grams[low])
            top = np.maximum.reduceat(margin, np.flatnonzero(np.diff(text, prepend=-1)))
            best[np.unique(text)] = top
        out.append(best)
    return np.concatenate(out) if out else np.zeros(0)


def _spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers begin[0], begin[0] + 1, ... (count[0] of them), then begin[1], ..."""
    shift = np.repeat(begin - (np.cumsum(count) - count), count)
    return np.arange(len(shift)) + shift


def train(texts: list[str], labels: np.ndarray, seed: int = SEED) -> Model:
    """Embeddings and softmax from labelled texts.

    The first rounds take every passage for its document's label. Later ones take of each
    document the passage that looks most toxic, which is where a clean document must not
    and a toxic one should; it is chosen anew after every few steps. Without both labels
    the model tells nothing apart.
    """
    labels = np.asarray(labels, float)
    share = labels.mean() if len(labels) else 0.0
    if not 0 < share < 1:
        return Model(np.zeros(BUCKETS), 20.0 if share else -20.0)
    (buckets, word_size), sequences, first = _vocabulary(texts)
    word_begin = np.cumsum(word_size) - word_size
    low, high, text = _passages(first, PASSAGE_WORDS, PASSAGE_WORDS)
    labels = labels[np.unique(text)]
    begin = np.flatnonzero(np.diff(text, prepend=-1))
    text = np.repeat(np.arange(len(labels)), np.diff(np.append(begin, len(text))))
    grams = np.concatenate([[0], np.cumsum(word_size[sequences])])
    size = (grams[high] - grams[low]).astype(float)

    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS))
    softmax = rng.normal(0, 0.1, (DIMENSIONS, 2))
    # Words that nothing is known of leave a passage clean: the bias begins low and moves
    # slowly, so what tells a toxic passage has to come from its words.
    bias = np.array([1.5, -1.5])
    seen = [np.full_like(x, 1e-8) for x in (embedding, softmax, bias)]

    # Some words at a time, so that what is made of their n-grams stays small.
    cuts = [*range(0, len(word_size), 50_000), len(word_size)]
    some = [(slice(a, b), slice(word_begin[a], word_begin[b - 1] + word_size[b - 1])) for a, b in zip(cuts, cuts[1:])]

    def all_margins() -> np.ndarray:
        per_bucket = embedding @ (softmax[:, 1] - softmax[:, 0])
        word = np.concatenate(
            [np.add.reduceat(per_bucket[buckets[g]], word_begin[w] - word_begin[w.start]) for w, g in some]
        )
        total = np.concatenate([[0.0], np.cumsum(word[sequences])])
        return (total[high] - total[low]) / size + bias[1] - bias[0]

    def learn(margin: np.ndarray, take: np.ndarray, share_of_bucket) -> None:
        """One step of Adagrad; share_of_bucket(error) sums what falls to each bucket."""
        p = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
        error = (p - labels[text[take]]) / np.bincount(text[take])[text[take]] / len(labels)
        along = softmax[:, 1] - softmax[:, 0]
        of_bucket = share_of_bucket(error / size[take])
        toward = of_bucket @ embedding
        for which, value, gradient, rate in (
            (0, embedding, of_bucket[:, None] * along, 0.3),
            (1, softmax, np.outer(toward, [-1.0, 1.0]), 0.1),
            (2, bias, error.sum() * np.array([-1.0, 1.0]), 0.01),
        ):
            seen[which] += gradient**2
            value -= rate * gradient / np.sqrt(seen[which])

    def over_all(error: np.ndarray) -> np.ndarray:
        push = np.bincount(low, error, len(sequences) + 1) - np.bincount(high, error, len(sequences) + 1)
        of_word = np.bincount(sequences, np.cumsum(push[:-1]), len(word_size))
        return sum(np.bincount(buckets[g], np.repeat(of_word[w], word_size[w]), BUCKETS) for w, g in some)

    for _ in range(FIRST_ROUNDS):
        learn(all_margins(), np.arange(len(text)), over_all)
    for _ in range(ROUNDS):
        margin = all_margins()
        take = np.flatnonzero(margin == np.maximum.reduceat(margin, begin)[text])
        words = sequences[_spread(low[take], (high - low)[take])]
        held = buckets[_spread(word_begin[words], word_size[words])]
        of = np.repeat(np.arange(len(take)), size[take].astype(int))
        for _ in range(STEPS):
            per_bucket = embedding @ (softmax[:, 1] - softmax[:, 0])
            margin = np.bincount(of, per_bucket[held]) / size[take] + bias[1] - bias[0]
            learn(margin, take, lambda error: np.bincount(held, error[of], BUCKETS))
    return Model(embedding @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0]))


def _vocabulary(texts: list[str]):
    """Distinct words with their n-grams, and the texts as sequences of word numbers."""
    hashes, own, buckets_of, sizes, first = [], [], [], [], [np.zeros(1, np.int64)]
    seen = np.zeros(0, U64)
    for _, _, data, offsets in utf8_runs(pc.utf8_lower(pa.array(texts, pa.string()))):
        spelled, begin, buckets, words = word_grams(data, offsets)
        unique, at = np.unique(spelled, return_index=True)
        new = ~np.isin(unique, seen, assume_unique=True)
        seen = np.union1d(seen, unique[new])
        keep = np.zeros(len(spelled), bool)
        keep[at[new]] = True
        own.append(spelled[keep])
        sizes.append(np.bincount(words, minlength=len(spelled))[keep])
        buckets_of.append(buckets[keep[words]])
        hashes.append(spelled)
        first.append(begin[1:] + first[-1][-1])
    own = np.concatenate(own)
    order = np.argsort(own)
    sequences = order[np.searchsorted(own, np.concatenate(hashes), sorter=order)].astype(np.int32)
    return (np.concatenate(buckets_of), np.concatenate(sizes)), sequences, np.concatenate(first)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, held_out, most: dict[int, int], seed: int
) -> list:
    """Texts and labels of at most ``most`` documents of each label, chosen by hashed id.

    Ids are chosen among the labels first, so only their texts are read to the driver.
    Repeated labels of a document count once, with the larger value.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label")).where(~held_out)
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = None
    for value, count in most.items():
        some = known.where(F.col("label") == value)
        some = some.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(count)
        chosen = some if chosen is None else chosen.union(some)
    rows = docs.select("doc_id", "text").where("text IS NOT NULL")
    rows = rows.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).orderBy("doc_id")
    return rows.select("text", "label").collect()


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labelled documents outside the fold that is held out."""
    most = {1: SAMPLE_TOXIC, 0: SAMPLE_CLEAN}
    rows = labelled_sample(docs, labels, "toxic", held_out_fold(), most, SEED)
    return train([r.text for r in rows], np.array([r.label for r in rows]))


def held_out_fold():
    return F.coalesce(crc_of_id() % 4 == 2, F.lit(False))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``score`` in [0, 1]: the softmax of its worst passage.

    A null or empty text, or one without letters and digits, has no passage and scores next
    to 0. Each row is scored by its whole text alone; equal texts get equal scores.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = 1 / (1 + np.exp(-np.clip(margins(model, batch.column(1)), LOWEST, -LOWEST)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p, pa.float64())], names=["doc_id", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def below(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score less than ``threshold``, all columns as they are."""
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Whole rows pass through here: a few at a time.
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                margin = np.clip(margins(model, part.column(text)), LOWEST, -LOWEST)
                yield part.filter(pa.array(1 / (1 + np.exp(-margin)) < threshold))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    ``predicted`` is 1 where the score is at least ``threshold``. Learns from the rows of
    ``labels`` (doc_id, toxic) that have a text and do not lie in the held-out fold, whose
    crc32 of the id modulo 4 is 2; labels and other columns are no inputs of a score. A
    null id is not held out. Without both labels all scores are next to 0 (or 1).
    """
    scored = score(docs, fit(docs, labels))
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select("doc_id", held_out_fold().alias("held_out"), "score", predicted.alias("predicted"))
