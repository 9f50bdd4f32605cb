"""Ranked search beside scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from candlemill.llm import ranked as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def plain(docs, items, most=20):
    counted = [(d, Counter(terms(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item_id, text in items:
        asked, scores = Counter(terms(text)), []
        for (doc_id, c), n in zip(counted, sizes):
            score = 0
            for t, times in asked.items():
                if c[t]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 75 + (25 * n * n_docs) // n_terms
                    score += times * weight * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scores)[:most], 1):
            out.append((item_id, rank, None if null else doc_id, -score))
    return sorted(out, key=str)


def corpus(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Zoo", "café", "x1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    texts = [" ".join(rng.choices(words, weights, k=rng.randrange(1, 60))) for _ in range(n)]
    docs = [(i * 3 % n, t) for i, t in enumerate(texts)]
    docs += [(1000 + i, texts[0]) for i in range(80)] + [(None, texts[1]), (7, texts[1]), (7, texts[1])]
    docs += [(2000, None), (2001, ""), (2002, "., !"), (2003, "zoo " * 30_000), (-5, texts[2])]
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 25)))) for i in range(15)]
    items += [(50, None), (51, ""), (52, "absent words"), (3, texts[0]), (None, texts[1]), (53, "ZOO zoo, zoo")]
    return docs, items


@pytest.mark.parametrize("shard, front", [(4096, 256), (16, 3), (1, 1)])
def test_best_documents_are_those_of_a_full_scoring(spark, frame, monkeypatch, shard, front):
    monkeypatch.setattr(R, "SHARD_DOCS", shard)
    monkeypatch.setattr(R, "FRONT", front)
    docs, items = corpus(shard, 400 if shard > 1 else 60)
    table = frame(docs).withColumnRenamed("lang", "rank").withColumnRenamed("source", "item_id").repartition(3)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, score int")
    found = R.ranked_search(table, asked).collect()
    assert sorted(map(tuple, found), key=str) == plain(docs, items)


def test_items_in_several_blocks(spark, frame, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_ITEMS", 2)
    docs, items = corpus(3, 40)
    found = R.ranked_search(frame(docs), spark.createDataFrame(items[:5], "item_id long, text string"), 3)
    assert sorted(map(tuple, found.collect()), key=str) == plain(docs, items[:5], 3)


def test_empty_tables(spark, frame):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert R.ranked_search(frame([]), items).collect() == []
    assert R.ranked_search(frame([(1, "a")]), items.where("false")).columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_are_never_too_low():
    rng = np.random.default_rng(1)
    places = [np.sort(rng.choice(50, k, replace=False)) for k in (50, 20, 3)]
    row = {
        "doc_ids": np.arange(50), "lengths": rng.integers(1, 90, 50), "terms": np.arange(3),
        "sizes": np.array([len(p) for p in places]), "places": np.concatenate(places),
        "counts": rng.integers(1, 9, 73),
    }
    shard = R.Shard(row, np.array([5, 700, 3000]), 50, 2000)
    times = np.array([1, 2, 1])
    for a, b in rng.integers(0, 51, (200, 2)):
        a, b = min(a, b), max(a, b)
        low, high = (np.array([[s + np.searchsorted(p, x) for s, p in zip(shard.starts, places)]]) for x in (a, b))
        bound, split = shard._bounded(low, high, times)
        best = [
            [shard.impact[s + i] * t if i < len(p) and p[i] == d else 0 for s, p, t in zip(shard.starts, places, times)
             for i in [np.searchsorted(p, d)]]
            for d in range(a, b)
        ]
        assert bound[0] == sum(max(column) for column in zip(*best)) if best else bound[0] == 0
        if bound[0]:
            assert a <= split[0] < b
