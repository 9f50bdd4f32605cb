"""Language ID by words first, backing off to character n-grams.

A known word scores its log frequency in each language. An unseen word is walked letter by
letter: where the longest n-gram that begins there is known it scores, else the next
shorter one. The language with the largest total wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlemill.llm.common import crc_of_id, saved, semi_join
from candlemill.llm.words import U64, mix, powers, utf8_runs

# Documents of each language that a model is fitted on, at most, by seeded order.
SAMPLE_DOCS = 20_000
# Times that a word or n-gram must occur in the sample, in all languages, to be known.
LEAST = 3
GRAMS = (5, 4, 3, 2, 1)
UNKNOWN = "und"
# Log-probability of what a language does not have, and the weight of a letter's n-gram.
FLOOR = -14.0
GRAM_WEIGHT = 0.25
SEED = 8

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_BASE = 0x2545F4914F6CDD1D
_KINDS = len(GRAMS) + 1


def _words(data: np.ndarray, offsets: np.ndarray):
    """Starts, ends and hashes of the words (stretches of letters) of a run of texts."""
    inside = _LETTER[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:][offsets[1:] > 0] - 1
    ends[edges] = inside[edges]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    values = mix(data.astype(U64) + U64(1)) * powers(_BASE, len(data))
    running = np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])
    inverse = powers(pow(_BASE, -1, 1 << 64), len(data) + 1)

    def hashes(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return mix((running[high] - running[low]) * inverse[low])

    return starts, ends, hashes


def _gram_places(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """First bytes of the letters of these words, and where each letter's word ends."""
    length = ends - starts
    at = np.arange(int(length.sum())) + np.repeat(starts - (np.cumsum(length) - length), length)
    stop = np.repeat(ends, length)
    first = (data[at] & 0xC0) != 0x80
    return at[first], stop[first]


def _letters_on(data: np.ndarray, at: np.ndarray, letters: int) -> np.ndarray:
    """The byte that many letters after ``at`` (UTF-8)."""
    size = np.array([1] * 0xC0 + [2] * 0x20 + [3] * 0x10 + [4] * 0x10)
    for _ in range(letters):
        at = at + size[data[np.minimum(at, len(data) - 1)]]
    return at


@dataclass
class Model:
    """Languages, the sorted hashes of what is known, and the log-probabilities of each."""

    languages: list[str]
    keys: np.ndarray
    logs: np.ndarray

    def find(self, hashes: np.ndarray, kind: int) -> np.ndarray:
        """Entry numbers of hashes, -1 where unknown."""
        if not len(self.keys):
            return np.full(len(hashes), -1, np.int64)
        hashes = mix(hashes + U64(kind))
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, at, -1)


def build(languages: list[str], kinds: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> Model:
    """A model from distinct entries (kind, hash) with their counts in each language."""
    keys = mix(hashes + kinds.astype(U64))
    order = np.argsort(keys, kind="stable")
    keys, kinds, counts = keys[order], kinds[order], counts[order].astype(float)
    totals = np.zeros((_KINDS, len(languages)))
    np.add.at(totals, kinds, counts)
    share = counts / np.maximum(totals[kinds], 1)
    logs = np.maximum(np.log(share + 1e-12), FLOOR)
    return Model(languages, keys, logs)


def totals(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed log-probabilities of each text of a run by language, and its number of words."""
    n = len(offsets) - 1
    out = np.zeros((n, len(model.languages)))
    if not len(data):
        return out, np.zeros(n)
    starts, ends, hashes = _words(data, offsets)
    text = np.searchsorted(offsets, starts, "right") - 1
    found = model.find(hashes(starts, ends), 0)
    known = found >= 0
    for j in range(len(model.languages)):
        out[:, j] += np.bincount(text[known], model.logs[found[known], j], n)
    at, stop = _gram_places(data, starts[~known], ends[~known])
    of = np.searchsorted(offsets, at, "right") - 1
    for kind, letters in enumerate(GRAMS, 1):
        end = _letters_on(data, at, letters)
        fits = np.flatnonzero(end <= stop)
        found = model.find(hashes(at[fits], end[fits]), kind)
        hit, found = fits[found >= 0], found[found >= 0]
        for j in range(len(model.languages)):
            out[:, j] += GRAM_WEIGHT * np.bincount(of[hit], model.logs[found, j], n)
        rest = np.ones(len(at), bool)
        rest[hit] = False
        at, stop, of = at[rest], stop[rest], of[rest]
    return out, np.bincount(text, minlength=n)


_COUNT_ARROW = pa.schema(
    [("lang", pa.string()), ("kind", pa.int32()), ("hash", pa.int64()), ("n", pa.int64())]
)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and n-grams by language in each run of (text, lang)."""
    for batch in batches:
        texts = pc.utf8_lower(batch.column(0))
        lang = batch.column(1)
        for a, b, data, offsets in utf8_runs(texts):
            if not len(data):
                continue
            starts, ends, hashes = _words(data, offsets)
            names, code = np.unique(np.array(lang[a:b].to_pylist(), object).astype(str), return_inverse=True)
            at, stop = _gram_places(data, starts, ends)
            parts = [(0, hashes(starts, ends), starts)]
            for kind, letters in enumerate(GRAMS, 1):
                end = _letters_on(data, at, letters)
                fits = end <= stop
                parts.append((kind, hashes(at[fits], end[fits]), at[fits]))
            for kind, keys, place in parts:
                of = code[np.searchsorted(offsets, place, "right") - 1]
                for j, name in enumerate(names):
                    unique, n = np.unique(keys[of == j], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(unique), pa.string()),
                            pa.array(np.full(len(unique), kind, np.int32)),
                            pa.array(unique.view(np.int64)),
                            pa.array(n.astype(np.int64)),
                        ],
                        schema=_COUNT_ARROW,
                    )


def held_out_fold():
    return F.coalesce(crc_of_id() % 3 == 1, F.lit(False))


def fit(docs: DataFrame) -> Model:
    """A model from text and non-null lang of the documents outside the held-out fold.

    At most SAMPLE_DOCS documents of each language are read, in a seeded order of their
    ids; of those every word and n-gram is known that occurs LEAST times.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out_fold())
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id")
    ids = known.select("doc_id", "lang").withColumn("place", F.row_number().over(first))
    ids = saved(ids.where(F.col("place") <= SAMPLE_DOCS).select("doc_id").distinct(), "sample")
    rows = semi_join(known, ids, "doc_id").select("text", "lang")
    counts = rows.mapInArrow(_count, "lang string, kind int, hash long, n long")
    counts = counts.groupBy("lang", "kind", "hash").agg(F.sum("n").alias("n"))
    by_entry = Window.partitionBy("kind", "hash")
    counts = counts.withColumn("all", F.sum("n").over(by_entry)).where(F.col("all") >= LEAST)
    counts = saved(counts.select("lang", "kind", "hash", "n"), "counts")
    languages = sorted(r.lang for r in counts.select("lang").distinct().collect())
    # Numbers only, in Arrow: the driver holds 24 bytes for each count.
    code = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")) - 1 if languages else F.lit(0)
    table = counts.select(code.cast("int").alias("code"), "kind", "hash", "n").toArrow()
    code, kinds, hashes, n = (table.column(c).to_numpy() for c in ("code", "kind", "hash", "n"))
    hashes = hashes.astype(np.int64).view(U64)
    _, first, entry = np.unique(mix(hashes + kinds.astype(U64)), return_index=True, return_inverse=True)
    matrix = np.zeros((len(first), len(languages)))
    matrix[entry, code] = n
    return build(languages, kinds[first].astype(np.int64), hashes[first], matrix)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for every row; see ``language_id``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            sums, words = [np.zeros((0, len(model.languages)))], [np.zeros(0)]
            for _, _, data, offsets in utf8_runs(pc.utf8_lower(texts)):
                s, w = totals(model, data, offsets)
                sums.append(s)
                words.append(w)
            sums, words = np.concatenate(sums), np.concatenate(words)
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False)
            letters = letters.to_numpy(zero_copy_only=False)
            if model.languages:
                # The mean margin for each word, so that the score does not saturate.
                odds = np.exp((sums - sums.max(axis=1, keepdims=True)) / np.sqrt(np.maximum(1, words))[:, None])
                score = (odds / odds.sum(axis=1, keepdims=True)).max(axis=1)
                best = np.array(model.languages, object)[sums.argmax(axis=1)]
            else:
                score, best = np.zeros(len(sums)), np.full(len(sums), UNKNOWN, object)
            best = np.where(letters, best, UNKNOWN)
            score = np.where(letters, score, 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def language_id(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs`` (doc_id, text, lang, ...).

    ``lang_pred`` is a language learned from the rows outside the held-out fold, whose crc32
    of the id modulo 3 is 1, or ``und`` with a score of 0 where the text is null or has no
    letter, or where no language could be learned. ``score`` in [0, 1] is the share of the
    best language. Texts are read whole; lang, source and id are no inputs of a prediction.
    """
    out = identify(docs, fit(docs))
    return out.select("doc_id", held_out_fold().alias("held_out"), "lang_pred", "score")
