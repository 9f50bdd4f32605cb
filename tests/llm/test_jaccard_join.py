"""The Jaccard join beside all pairs."""

import random
import re

import numpy as np
import pytest

from candlemill.llm import jaccard_join as J
from candlemill.llm.words import U64, shingle_sets


def plain_set(text, width):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def plain_join(rows, width, num, den):
    sets = [(r[0], plain_set(r[1], width)) for r in rows]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[i + 1 :]:
            if s and t and len(s & t) * den >= len(s | t) * num:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return sorted((d, len(s), find(d)) for d, s in sets)


def edited(text, edits, rng):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(prose):
    rng = random.Random(1)
    rows = [(i, prose(rng.randrange(1, 120), i)) for i in range(40)]
    hub = prose(200, 1000)
    # Copies of one text that link through it but hardly with each other.
    rows += [(900 - i, edited(hub, rng.randrange(1, 9), rng)) for i in range(60)]
    rows += [(2000 + i, hub) for i in range(5)] + [(950, hub.upper())]
    chain = prose(150, 77)
    for i in range(12):
        chain = edited(chain, 2, rng)
        rows.append((3000 + i, chain))
    rows += [(10_000, None), (10_001, ""), (10_002, " \t\n"), (10_003, "one"), (10_004, "ONE"),
             (10_005, "one two"), (10_006, "é b c d"), (10_007, "é b c d")]
    return rows


@pytest.mark.parametrize("width,num,den,chunk", [(3, 90, 100, 256), (5, 80, 100, 7), (1, 1, 2, 5), (2, 1, 1, 9)])
def test_like_all_pairs(frame, prose, monkeypatch, width, num, den, chunk):
    monkeypatch.setattr(J, "CHUNK", chunk)
    rows = corpus(prose)
    got = J.jaccard_components(frame(rows).repartition(3), width, num, den).collect()
    assert sorted(tuple(r) for r in got) == plain_join(rows, width, num, den)


@pytest.mark.parametrize("chunk", [2048, 9])
def test_every_link_is_counted_and_the_given_ones_span(frame, prose, monkeypatch, chunk):
    monkeypatch.setattr(J, "CHUNK", chunk)
    rows = [r for r in corpus(prose) if r[0] < 3000] + [(2000, prose(200, 1000))]
    sets = [(d, plain_set(t, 3)) for d, t in rows]
    links, out = J.jaccard_join(frame(rows).repartition(3), 3, 90, 100)
    first = {}
    for d, s in sets:
        first[s] = min(d, first.get(s, d))
    near = lambda s, t: bool(s and t) and len(s & t) * 100 >= len(s | t) * 90
    every = {(a, b) for s, a in first.items() for t, b in first.items() if a != b and near(s, t)}
    given = {(r.u.doc_id, r.v.doc_id) for r in links.collect()}
    assert len(every) > 200 and given <= every and len(given) < len(every) / 2
    counts = sorted((d, sum(near(s, t) for _, t in sets) - bool(s)) for d, s in sets)
    assert sorted((r.doc_id, r.n_links) for r in out.collect()) == counts


def test_an_id_with_several_texts_loses_none_of_them(frame, prose):
    a, b, c = prose(60, 1), prose(60, 2), prose(60, 3)
    rows = [(1, a), (1, b), (1, c), (5, b + " end"), (6, c + " end"), (4, c)]
    got = J.jaccard_join(frame(rows), 3, 90, 100)[1].collect()
    assert sorted((r.doc_id, r.component_id, r.n_links) for r in got) == [
        (1, 1, 0), (1, 1, 1), (1, 1, 2), (4, 1, 2), (5, 1, 1), (6, 1, 2)]


def test_sets_that_fill_enough_parts_leave_out_the_empty_ones():
    rng = np.random.default_rng(2)
    tiles = J.Tiles(80, 100)
    sets = [np.unique(rng.integers(0, 2**63, 200, dtype=np.uint64)) * U64(2) for _ in range(200)]
    keys = np.concatenate([J.part_keys(s, tiles) for s in sets])
    assert len(np.unique(keys)) == len(keys)


def test_repeated_rows_null_ids_and_other_columns(spark, prose):
    text = prose(30, 5)
    rows = [(7, text, 1, 2), (7, text, 1, 2), (5, text, 1, 2), (None, text, 1, 2), (9, None, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part long, n_shingles long")
    got = J.jaccard_components(docs, 3).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in got) == [
        (0, 28, None), (5, 28, 5), (7, 28, 5), (7, 28, 5), (9, 0, 9)]


def test_no_rows(frame):
    assert J.jaccard_components(frame([])).collect() == []


def test_long_text(frame, prose):
    text = prose(200_000, 3, 10**6)
    rows = [(1, text), (2, text + " end"), (3, "short text of few words")]
    got = J.jaccard_components(frame(rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 1), (3, 3)]


def test_bound_is_never_below_the_overlap():
    rng = np.random.default_rng(0)
    for _ in range(200):
        pool = rng.integers(0, 2**63, 400, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        both = len(np.intersect1d(a, b))
        assert J.overlap(a, b) == both
        assert J.overlap_bound(J.bitmap_of(a), len(a), J.bitmap_of(b), len(b)) >= both


def test_linked_sets_share_a_part():
    rng = np.random.default_rng(1)
    for num, den in ((9, 10), (8, 10), (1, 2)):
        tiles = J.Tiles(num, den)
        for _ in range(150):
            a = np.unique(rng.integers(0, 2**63, rng.integers(2, 400), dtype=np.uint64))
            cut = rng.integers(0, len(a) * (den - num) // den + 1)
            b = np.unique(np.concatenate([a[cut:], rng.integers(0, 2**63, rng.integers(0, 3), dtype=np.uint64)]))
            if J.overlap(a, b) * (den + num) >= num * (len(a) + len(b)) and not np.array_equal(a, b):
                assert np.isin(J.part_keys(a, tiles), J.part_keys(b, tiles)).any()


def test_shingles_of_a_batch_are_those_of_each_text():
    import pyarrow as pa

    texts = ["a b c d", None, "", "A b  c\td", "x", "a b c d e " * 50]
    sets = list(shingle_sets(pa.array(texts), 3))
    assert [len(s) for s in sets] == [len(plain_set(t, 3)) for t in texts]
    assert np.array_equal(sets[0], sets[3]) and sets[0].dtype == U64
    for t, s in zip(texts, sets):
        assert np.array_equal(next(shingle_sets(pa.array([t], pa.string()), 3)), s)
