"""The best documents for each item by the words they share.

Documents are dealt into shards, in the order of their ids within a shard. A shard keeps,
for each term that is asked for, a posting list of its documents, and over each list a
sparse table of range maxima of the term's impacts. An interval of documents cannot score
more than the sum of its terms' maxima. The most promising intervals are taken first: the
document of the highest impact in it is scored, and splits the interval in two. Intervals
that cannot hold one of the best documents any more are left.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlemill.llm.common import saved

MOST = 20
# Documents of a shard at most, and occurrences of asked terms after which it is closed.
SHARD_DOCS = 4096
SHARD_TERMS = 1 << 23
# Items are searched in blocks: so many items, and terms among them, go to the tasks at once.
BLOCK_ITEMS = 1000
BLOCK_TERMS = 100_000
# Intervals opened together, once as many documents as asked for have been scored.
FRONT = 256
# The weight of a document's length, of an occurrence, and their scales (fixed values).
BASE, LENGTH_SHARE, SCALE, PER_COUNT, PER_LENGTH = 100, 25, 1_000_000_000, 1000, 12

_BITS = 20
_MASK = (1 << _BITS) - 1
_NO_ID = (1 << 63) - 1
# Bytes that end a term become blanks, A-Z become a-z, those of other characters stay.
_TERMS = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in (ord(chr(x).lower()) if x < 0x80 else x for x in range(256))
)


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text, in order."""
    return (text or b"").translate(_TERMS).split()


class _Known(dict):
    def __missing__(self, term: bytes) -> int:
        return -1


_SHARD = (
    "shard long, n_docs long, n_terms long, doc_ids array<long>, lengths array<long>,"
    " terms array<int>, sizes array<int>, places array<int>, counts array<int>"
)


def _index_tasks(vocabulary: dict[bytes, int]):
    def closed(number: int, ids: list, lengths: list, found: list[array]) -> pa.RecordBatch:
        keys = np.array([_NO_ID if i is None else i for i in ids], np.int64)
        order = np.argsort(keys, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        codes = np.concatenate([np.frombuffer(f, np.int32) for f in found]).astype(np.int64)
        rows = np.repeat(place, [len(f) for f in found])
        pairs, counts = np.unique((codes << _BITS) | rows, return_counts=True)
        terms, sizes = np.unique(pairs >> _BITS, return_counts=True)
        n = np.array(lengths, np.int64)
        columns = [keys[order], n[order], terms, sizes, pairs & _MASK, counts]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays(
            [pa.array([x], pa.int64()) for x in (number, (n > 0).sum(), n.sum())]
            + [pa.array([c.astype(k.to_pandas_dtype())], pa.list_(k)) for c, k in zip(columns, kinds)],
            ["shard", "n_docs", "n_terms", "doc_ids", "lengths", "terms", "sizes", "places", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(vocabulary).__getitem__
        number = TaskContext.get().partitionId() << 32
        ids, lengths, found, total = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                terms = terms_of(text.as_py())
                codes = np.array(array("i", map(known, terms)), np.int32)
                codes = codes[codes >= 0]
                ids.append(doc_id)
                lengths.append(len(terms))
                found.append(codes)
                total += len(codes)
                if len(ids) == SHARD_DOCS or total >= SHARD_TERMS:
                    yield closed(number, ids, lengths, found)
                    ids, lengths, found, total = [], [], [], 0
                    number += 1
        if ids:
            yield closed(number, ids, lengths, found)

    return run


def shards(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Posting lists of the terms in ``vocabulary`` over all documents, a row for each shard.

    Lengths are those of whole documents. Terms are numbered by ``vocabulary``; ``places``
    and ``counts`` are the posting lists one after another, of ``sizes`` each.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(_index_tasks(vocabulary), _SHARD)


@dataclass
class Item:
    """Distinct terms of an item, how often it has them, and what others have found so far."""

    key: int
    terms: np.ndarray
    times: np.ndarray
    floor: int = 0
    floor_id: int = _NO_ID


class Shard:
    """Posting lists with the impacts of their documents and range maxima over them."""

    def __init__(self, row: dict, weights: np.ndarray, n_docs: int, n_terms: int):
        self.doc_ids = row["doc_ids"]
        terms, sizes = row["terms"], row["sizes"]
        self.slot = np.full(len(weights), -1, np.int64)
        self.slot[terms] = np.arange(len(terms))
        self.starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        places, counts = row["places"].astype(np.int64), row["counts"].astype(np.int64)
        base = BASE - LENGTH_SHARE + (LENGTH_SHARE * row["lengths"] * n_docs) // max(n_terms, 1)
        weight = np.repeat(weights[terms], sizes)
        self.impact = weight * ((SCALE * counts) // (PER_COUNT * counts + PER_LENGTH * base[places]))
        self.keys = (np.repeat(np.arange(len(terms)), sizes) << _BITS) | places
        # Impact and place in one number: the greatest is the highest impact's first place.
        rows, width = [(self.impact << _BITS) | (_MASK - places)], 1
        while 2 * width <= int(sizes.max(initial=0)):
            last = rows[-1].copy()
            last[:-width] = np.maximum(rows[-1][:-width], rows[-1][width:])
            rows.append(last)
            width *= 2
        self.greatest = np.stack(rows)

    def _bounded(self, low: np.ndarray, high: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The most that a document of each interval can score, and where to split it."""
        size = high - low
        k = np.maximum(np.frexp(size)[1] - 1, 0)
        last = self.greatest.shape[1] - 1
        best = np.maximum(
            self.greatest[k, np.minimum(low, last)], self.greatest[k, np.maximum(high - (1 << k), 0)]
        )
        best[size <= 0] = 0
        gains = (best >> _BITS) * times
        top = gains.argmax(axis=1)
        return gains.sum(axis=1), _MASK - (best[np.arange(len(best)), top] & _MASK)

    def search(self, item: Item, most: int, visits: int | None = None) -> list[tuple[int, int]]:
        """(score, place) of the ``most`` best documents, best first, ties by place.

        Documents that ``item.floor`` rules out may be missing. ``visits`` ends the search
        early, after so many documents have been scored.
        """
        slot = self.slot[item.terms]
        here = slot >= 0
        slot, times = slot[here], item.times[here]
        if not len(slot):
            return []
        low, high = self.starts[slot][None, :], self.starts[slot + 1][None, :]
        first = np.zeros(1, np.int64)
        bound, split = self._bounded(low, high, times)
        scores, places = np.zeros(0, np.int64), np.zeros(0, np.int64)
        floor, floor_id, seen, shift = item.floor, item.floor_id, 0, slot << _BITS
        while True:
            live = (bound > floor) | ((bound == floor) & (self.doc_ids[first] <= floor_id))
            live &= bound > 0
            if not live.all():
                low, high, first, bound, split = (x[live] for x in (low, high, first, bound, split))
            if not len(bound) or (visits is not None and seen >= visits):
                break
            front = FRONT if seen >= most else most
            rest = np.zeros(len(bound), bool)
            if len(bound) > front:
                rest[np.lexsort((first, -bound))[front:]] = True
            a, b, start, at = (x[~rest] for x in (low, high, first, split))
            pos = np.searchsorted(self.keys, shift + at[:, None])
            inside = np.minimum(pos, len(self.keys) - 1)
            hit = (pos < b) & (self.keys[inside] == shift + at[:, None])
            score = (self.impact[inside] * hit * times).sum(axis=1)
            seen += len(at)
            scores, places = np.append(scores, score), np.append(places, at)
            best = np.lexsort((places, -scores))[:most]
            scores, places = scores[best], places[best]
            if len(scores) == most and (
                scores[-1] > floor or (scores[-1] == floor and self.doc_ids[places[-1]] < floor_id)
            ):
                floor, floor_id = int(scores[-1]), int(self.doc_ids[places[-1]])
            low2, high2 = np.concatenate([a, pos + hit]), np.concatenate([pos, b])
            first2 = np.concatenate([start, np.minimum(at + 1, len(self.doc_ids) - 1)])
            bound2, split2 = self._bounded(low2, high2, times)
            low, high = np.concatenate([low[rest], low2]), np.concatenate([high[rest], high2])
            first = np.concatenate([first[rest], first2])
            bound, split = np.concatenate([bound[rest], bound2]), np.concatenate([split[rest], split2])
        return [(s, p) for s, p in zip(scores.tolist(), places.tolist()) if s > 0]


_FOUND = "item int, doc_id long, score long"
_FOUND_ARROW = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _search_tasks(items: list[Item], weights: np.ndarray, n_docs: int, n_terms: int, most: int, visits: int | None):
    names = ("doc_ids", "lengths", "terms", "sizes", "places", "counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in names}
                if not len(row["terms"]):
                    continue
                shard = Shard(row, weights, n_docs, n_terms)
                found = [(x.key, *f) for x in items for f in shard.search(x, most, visits)]
                keys, scores, places = np.array(found, np.int64).reshape(-1, 3).T
                columns = [keys.astype(np.int32), shard.doc_ids[places], scores]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_FOUND_ARROW)

    return run


def _best(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _searched(docs: DataFrame, texts: list[bytes | None], most: int) -> DataFrame:
    """(item, doc_id, score, rank) for one block of items, numbered in order."""
    counted = [Counter(terms_of(t)) for t in texts]
    vocabulary = {t: i for i, t in enumerate(dict.fromkeys(t for c in counted for t in c))}
    index = saved(shards(docs, vocabulary), "shards")
    totals = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = totals[0] or 0, totals[1] or 0
    # One row for each term of the block at most.
    held = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x"))
    held = held.groupBy("x.terms").agg(F.sum("x.sizes").alias("df")).collect()
    weights = np.zeros(len(vocabulary), np.int64)
    for term, df in held:
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    items = []
    for key, terms in enumerate(counted):
        asked = [(vocabulary[t], n) for t, n in terms.items() if weights[vocabulary[t]] > 0]
        if asked:
            items.append(Item(key, *np.array(asked, np.int64).T))

    def search(visits: int | None) -> DataFrame:
        return index.mapInArrow(_search_tasks(items, weights, n_docs, n_terms, most, visits), _FOUND)

    # A first look into each shard gives each item a score that its best documents reach.
    for row in _best(search(most), most).where(F.col("rank") == most).collect():
        item = next(x for x in items if x.key == row.item)
        item.floor, item.floor_id = row.score, row.doc_id
    return saved(_best(search(None), most), "ranked")


def _item_blocks(items: DataFrame, text: str) -> Iterator[tuple[list, list[bytes | None]]]:
    ids, texts, terms = [], [], set()
    for row in items.select("item_id", F.col(text).cast("binary").alias("text")).toLocalIterator():
        own = set(terms_of(row.text))
        if ids and (len(ids) == BLOCK_ITEMS or len(terms | own) > BLOCK_TERMS):
            yield ids, texts
            ids, texts, terms = [], [], set()
        ids.append(row.item_id)
        texts.append(row.text)
        terms |= own
    if ids:
        yield ids, texts


def ranked_search(docs: DataFrame, items: DataFrame, most: int = MOST, text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``most`` best documents of each item, rank from 1.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z
    lower-cased. A term weighs floor(1000 ln((2N + 2) / (2df + 1))), a document scores the
    weights of the item's terms, repeats counted, times a saturating share of their counts;
    all but the weight is whole numbers. Equal scores come by ascending doc_id, null ids
    last, and documents that score nothing are left out.

    A null or empty text has no terms: such items get no rows, such documents are never
    found. Repeated documents are ranked each for itself, repeated items answered each for
    itself. Without documents or items there are no rows; further columns are not looked at.

    Items are taken in blocks of at most BLOCK_ITEMS, each with one pass over the documents.
    """
    spark, out = docs.sparkSession, None
    schema = f"item int, item_id {items.schema['item_id'].dataType.simpleString()}"
    for ids, texts in _item_blocks(items, text):
        named = spark.createDataFrame(list(enumerate(ids)), schema)
        found = _searched(docs, texts, most).join(F.broadcast(named), "item")
        found = found.select(
            "item_id",
            F.col("rank").cast("int").alias("rank"),
            F.when(F.col("doc_id") < _NO_ID, F.col("doc_id")).alias("doc_id"),
            "score",
        )
        out = found if out is None else out.union(found)
    if out is None:
        rows = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
        return spark.createDataFrame([], rows)
    return out
