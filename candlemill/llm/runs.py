"""Periodic runs in the words of a text, by common extensions of suffixes.

A run is a longest stretch of words that repeats with a period. For each period a grid of
places is laid so that every run of that period covers a place; the stretch around a place
is how far the words from there and from one period later agree, forwards and backwards.
Such longest common extensions are answered from a sample: only suffixes that begin at a
difference cover are sorted. Two places are a few words away from sampled ones, those words
are compared, and the rest is a minimum over the sorted suffixes' common prefixes.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORTEST = 24
REPEATS = 3
# A perfect difference set: every difference modulo 13 is one of two of its members (fixed value).
PERIOD, COVER = 13, (0, 1, 3, 9)
# Documents are worked on together up to so many words; a longer one by itself.
GROUP_WORDS = 1 << 18
# Grid places looked at in one go.
GRID_PLACES = 1 << 21
_SPACE = r"[^\x20\x09-\x0D]+"


def _shifts() -> np.ndarray:
    """How far two places, by their residues, are from the next pair of sampled places."""
    table = np.zeros((PERIOD, PERIOD), np.int64)
    for a in range(PERIOD):
        for b in range(PERIOD):
            table[a, b] = min((c - a) % PERIOD for c in COVER if (c - a + b) % PERIOD in COVER)
    return table


_SHIFT = _shifts()
_SAMPLED = np.isin(np.arange(PERIOD), COVER)
_ORDER = np.cumsum(_SAMPLED) - 1


def _ranked(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Ranks of pairs of whole numbers from -1 on, equal for equal pairs."""
    width = int(second.max(initial=0)) + 2
    keys = (first.astype(np.int64) + 1) * width + (second + 1)
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def _later(values: np.ndarray, by: int) -> np.ndarray:
    """Each place's value ``by`` places on; -1 beyond the end."""
    return np.concatenate([values[by:], np.full(min(by, len(values)), -1, np.int64)])


class CommonExtensions:
    """Longest common extensions of places in a sequence of whole numbers from 0 on."""

    def __init__(self, words: np.ndarray):
        self.n = n = len(words)
        self.words = np.concatenate([words, np.full(PERIOD + 1, -1, np.int64)])
        self.places = np.flatnonzero(np.resize(_SAMPLED, n))
        m = len(self.places)
        # The first 13 words of every sampled suffix, then twice as many in each round.
        two = _ranked(words, _later(words, 1))
        four = _ranked(two, _later(two, 2))
        eight = _ranked(four, _later(four, 4))
        twelve = _ranked(eight, _later(four, 8))[self.places]
        rank = _ranked(twelve, self.words[self.places + 12])
        levels, step = [rank], len(COVER)
        while rank.max(initial=0) + 1 < m:
            rank = _ranked(rank, _later(rank, step))
            levels.append(rank)
            step *= 2
        self.rank = rank
        order = np.empty(m, np.int64)
        order[rank] = np.arange(m)
        self.least = self._minima(self._prefixes(order, levels[:-1]))

    def _prefixes(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common words of each sorted suffix and the one after it."""
        a, b, m = order[:-1].copy(), order[1:].copy(), len(order)
        common = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            level = np.append(levels[k], -1)
            same = (level[a] == level[b]) & (a < m) & (b < m)
            common += same * (PERIOD << k)
            a = np.minimum(a + same * (len(COVER) << k), m)
            b = np.minimum(b + same * (len(COVER) << k), m)
        i, j = self.places[order[:-1]] + common, self.places[order[1:]] + common
        more, _ = self._compared(i, j, np.full(len(i), PERIOD))
        return common + more

    def _minima(self, values: np.ndarray) -> np.ndarray:
        rows, width = [values.astype(np.int32)], 1
        while 2 * width <= len(values):
            last = rows[-1].copy()
            last[:-width] = np.minimum(rows[-1][:-width], rows[-1][width:])
            rows.append(last)
            width *= 2
        return np.stack(rows)

    def _compared(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words that agree from i and j on, up to ``most``, and where all of them do."""
        found, live = np.zeros(len(i), np.int64), np.arange(len(i))
        for t in range(int(most.max(initial=0))):
            live = live[most[live] > t]
            a, b = np.minimum(i[live] + t, self.n), np.minimum(j[live] + t, self.n)
            live = live[(self.words[a] == self.words[b]) & (a < self.n) & (b < self.n)]
            found[live] += 1
        return found, found == most

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from i and from j on; i and j differ."""
        shift = _SHIFT[i % PERIOD, j % PERIOD]
        found, all_of = self._compared(i, j, shift)
        live = np.flatnonzero(all_of & (np.maximum(i, j) + shift < self.n))
        x, y = i[live] + shift[live], j[live] + shift[live]
        x, y = (self.rank[p // PERIOD * len(COVER) + _ORDER[p % PERIOD]] for p in (x, y))
        low, high = np.minimum(x, y), np.maximum(x, y)
        k = np.frexp(high - low)[1] - 1
        found[live] += np.minimum(self.least[k, low], self.least[k, high - (1 << k)])
        return found


def _grid(sizes: np.ndarray, shortest: int, repeats: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, place, period): each run of a period covers one of the period's places.

    A run of period p has max(shortest, repeats * p) - p places in a row that agree with
    the place one period later, so places that far apart suffice.
    """
    docs = np.flatnonzero(sizes >= shortest)
    for some in np.array_split(docs, max(1, len(docs) // 4096)):
        periods = sizes[some] // repeats
        doc = np.repeat(some, periods)
        period = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
        apart = np.maximum(shortest, repeats * period) - period
        counts = -(-(sizes[doc] - period) // apart)
        ends = np.cumsum(counts)
        at = 0
        while at < len(doc):
            before = ends[at] - counts[at]
            to = max(int(np.searchsorted(ends, before + GRID_PLACES, "right")), at + 1)
            row = np.repeat(np.arange(at, to), counts[at:to])
            number = np.arange(len(row)) - (ends - counts)[row] + before
            yield doc[row], number * apart[row], period[row]
            at = to


def _near(words: np.ndarray, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
    """Whether ``most`` words from i and j on agree, or as many before them."""
    keep = np.zeros(len(i), bool)
    for step, first in ((1, 0), (-1, 1)):
        live = np.arange(len(i))
        for t in range(first, first + most):
            live = live[words[i[live] + step * t] == words[j[live] + step * t]]
        keep[live] = True
    return keep


def _joined(parts: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequences one after another, unlike marks between and around them, and their starts."""
    sizes = np.array([len(p) for p in parts], np.int64)
    starts = np.cumsum(sizes + most) - sizes
    words = np.arange(int(sizes.sum()) + most * (len(parts) + 1), dtype=np.int64)
    words += max((int(p.max(initial=-1)) for p in parts), default=-1) + 1
    for start, part in zip(starts.tolist(), parts):
        words[start : start + len(part)] = part
    return words, starts


def find_runs(
    parts: list[np.ndarray], shortest: int = SHORTEST, repeats: int = REPEATS
) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each sequence, by start, then period."""
    sizes = np.array([len(p) for p in parts], np.int64)
    # A run has at least this many agreeing places before or after any of its grid places.
    places = min(max(shortest, repeats * p) - p for p in range(1, shortest + 1))
    reach = max(1, places // 2)
    words, starts = _joined(parts, reach + 1)
    found = []
    for doc, place, period in _grid(sizes, shortest, repeats):
        i = starts[doc] + place
        live = np.flatnonzero(words[i] == words[i + period])
        live = live[_near(words, i[live], i[live] + period[live], reach)]
        found.append(np.stack([doc[live], place[live], period[live]]))
    out: list[list[tuple[int, int, int]]] = [[] for _ in parts]
    doc, place, period = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    if not len(doc):
        return out
    some, slot = np.unique(doc, return_inverse=True)
    words, starts = _joined([parts[d] for d in some], 1)
    i = starts[slot] + place
    ahead = CommonExtensions(words).of(i, i + period)
    last = len(words) - 1
    behind = CommonExtensions(np.ascontiguousarray(words[::-1])).of(last - i + 1, last - i - period + 1)
    length = period + ahead + behind
    kept = np.flatnonzero(length >= np.maximum(shortest, repeats * period))
    rows = np.stack([doc[kept], (place - behind)[kept], length[kept], period[kept]], axis=1)
    rows = np.unique(rows, axis=0)
    # A stretch has its smallest period first; its other periods are multiples of that.
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[first]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    for d, *run in rows.tolist():
        out[d].append(tuple(run))
    return out


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())]
)
_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds after its first period."""
    if runs:
        edges = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            edges[start + period] += 1
            edges[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
    return b" ".join(words).decode()


def _runs_of_batches(shortest: int, repeats: int):
    def worked(ids: list, lists: list[list[bytes]]) -> pa.RecordBatch:
        number = _Numbers().__getitem__
        parts = [np.array(array("q", map(number, words)), np.int64) for words in lists]
        runs = find_runs(parts, shortest, repeats)
        rows = [[dict(zip(("start", "length", "period"), r)) for r in some] for some in runs]
        texts = [_collapsed(words, some) for words, some in zip(lists, runs)]
        columns = [ids, [len(words) for words in lists], rows, texts]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists, total = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or b"").split()
                if ids and total + len(words) > GROUP_WORDS:
                    yield worked(ids, lists)
                    ids, lists, total = [], [], 0
                ids.append(doc_id)
                lists.append(words)
                total += len(words)
            if ids:
                yield worked(ids, lists)

    return run


def periodic_runs(docs: DataFrame, shortest: int = SHORTEST, repeats: int = REPEATS) -> DataFrame:
    """Runs of each text, and the text without their repetitions.

    (doc_id, n_words, runs, collapsed), one row for each row of ``docs``. A run has a
    smallest period q, at least ``shortest`` and ``repeats`` times q words, and no neighbour
    that keeps the period; runs come by start, then period, counted in words from 0. Runs
    may overlap. ``collapsed`` has the words, joined by a blank, that no run holds after its
    first q words. Words are compared as they are, letter by letter.

    A null text counts as empty: no words, no runs, an empty result. Repeated rows and null
    ids come back as often as they come; further columns are not looked at.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(_runs_of_batches(shortest, repeats), _SCHEMA)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where the texts of a tenth of the ids end in a repetition.

    With h the crc32 of the id in decimal, g = h div 10, n words and h % 10 = 0: from word
    a = g % n on, a period of 1 + (n - a) div (3 + g % 8) words is repeated to the end.
    """
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"),
    )
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(_SPACE), F.lit(0)))
    base = base.withColumn("words", words).withColumn("n", F.size("words").cast("long"))
    base = base.withColumn("a", F.expr("if(n > 0, (h div 10) % n, 0L)"))
    base = base.withColumn("p", F.expr("1L + (n - a) div (3L + (h div 10) % 8)"))
    text = F.expr(
        "if(n > 0, array_join(concat(slice(words, 1, int(a)), transform(sequence(0L, n - a - 1),"
        " i -> words[int(a + i % p)])), ' '), text)"
    )
    return base.select("doc_id", text.alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Number of runs, the run of the greatest exponent, and digests of runs and words."""
    best = F.expr(
        "aggregate(runs, CAST(NULL AS struct<start: long, length: long, period: long>), (b, r) ->"
        " if(b IS NULL OR r.length * b.period > b.length * r.period, r, b))"
    )
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
