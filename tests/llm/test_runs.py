"""Periodic runs beside a scan of every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from candlemill.llm.runs import COVER, PERIOD, CommonExtensions, find_runs, periodic_runs, run_digests, with_planted_runs


def plain_runs(words, shortest=24, repeats=3):
    found = {}
    for p in range(1, len(words) // repeats + 1):
        i = 0
        while i < len(words) - p:
            start = i
            while i < len(words) - p and words[i] == words[i + p]:
                i += 1
            length = i - start + p
            if i > start and length >= max(shortest, repeats * p):
                found.setdefault((start, length), p)
            i += 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def plain_digests(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def sequence(rng):
    n, kind = rng.randrange(300), rng.randrange(6)
    if kind == 0:
        return [rng.randrange(2) for _ in range(n)]
    if kind == 1:
        return [0] * n
    if kind == 2:
        part = [rng.randrange(3) for _ in range(rng.randrange(1, 40))]
        return [rng.randrange(5) for _ in range(20)] + [part[i % len(part)] for i in range(n)]
    if kind == 3:
        out = []
        while len(out) < n:
            out += [rng.randrange(4) for _ in range(rng.randrange(1, 10))] * rng.randrange(1, 12)
        return out
    if kind == 4:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b
    return [rng.randrange(50) for _ in range(n)]


@pytest.mark.parametrize("shortest, repeats", [(24, 3), (4, 2), (30, 4)])
def test_all_runs_are_found(shortest, repeats):
    rng = random.Random(shortest)
    for _ in range(15):
        parts = [sequence(rng) for _ in range(20)]
        found = find_runs([np.array(p, np.int64) for p in parts], shortest, repeats)
        assert found == [plain_runs(p, shortest, repeats) for p in parts]


def test_every_difference_is_covered():
    for d in range(PERIOD):
        assert any((a + d) % PERIOD in COVER for a in COVER)


def test_common_extensions():
    rng = np.random.default_rng(2)
    for words in (rng.integers(0, 2, 700), np.zeros(300, np.int64), np.tile(np.arange(17), 40)):
        i, j = rng.integers(0, len(words), (2, 800))
        i, j = i[i != j], j[i != j]
        found = CommonExtensions(words).of(i, j)
        for a, b, n in zip(i, j, found):
            k = 0
            while max(a, b) + k < len(words) and words[a + k] == words[b + k]:
                k += 1
            assert k == n


def test_digests_of_documents(spark, frame, prose):
    rows = [(i, prose(30 + 7 * i, i, 60)) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " \x0b\n"), (None, "a b " * 30), (203, "x"), (204, "  y " * 40)]
    rows += [(205, "la la\tla " * 2000)] * 2 + [(206, prose(20_000, 3, 9)), (207, ("b " * 30 + prose(9, 4)) * 5)]
    docs = frame(rows).withColumnRenamed("lang", "runs").withColumnRenamed("source", "h")
    found = run_digests(periodic_runs(with_planted_runs(docs))).collect()
    assert sorted(map(tuple, found), key=str) == sorted((plain_digests(*r) for r in rows), key=str)


def test_real_outputs(frame):
    row = periodic_runs(frame([(1, "start " + "a b c " * 10 + "end")])).first()
    assert [tuple(r) for r in row.runs] == [(1, 30, 3)] and row.n_words == 32
    assert row.collapsed == "start a b c end"


def test_no_rows(frame):
    assert periodic_runs(with_planted_runs(frame([]))).collect() == []
