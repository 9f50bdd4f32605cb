"""Mixing beside seats given one by one, and targets shared anew until none is above."""

import random

import numpy as np
import pytest

from candlemill.llm.mixing import mix, sainte_lague, source_targets


def seat_by_seat(weights, seats, most=None):
    given = [0] * len(weights)
    for _ in range(seats):
        open_ = [i for i in range(len(weights)) if weights[i] > 0 and (most is None or given[i] < most[i])]
        if not open_:
            break
        given[max(open_, key=lambda i: (weights[i] / (2 * given[i] + 1), -i))] += 1
    return given


def test_seats():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(1, 6)
        weights = np.array([rng.choice([0, 1, 1, 2, 5, rng.random() * 50]) for _ in range(n)], float)
        seats = rng.randint(0, 40)
        assert list(sainte_lague(weights, seats)) == (seat_by_seat(weights, seats) if weights.sum() else [0] * n)
    assert sainte_lague(np.array([5, 5]), 9, np.array([2, 3])).tolist() == [2, 3]


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, stopped = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in stopped]
        total = sum(weight[s] for s in rest)
        over = [s for s in rest if weight[s] * left / total > most * sizes[s]]
        if not over:
            return stopped | {s: weight[s] * left / total for s in rest}
        for s in over:
            stopped[s] = most * sizes[s]
            left -= stopped[s]


def test_targets(spark):
    rng = random.Random(5)
    for _ in range(4):
        sizes = {s: rng.choice([0, 3, 500, 2000, 10_000]) for s in ["a", "B", "é", "z1", "z10", None]}
        if not sum(sizes.values()):
            continue
        sized = spark.createDataFrame(list(sizes.items()), "source string, size long")
        found = {r.source: r.target for r in source_targets(sized).collect()}
        want = plain_targets(sizes)
        assert all(found[s] == pytest.approx(want[s], abs=1e-6) for s in sizes)


def corpus(prose):
    rng = random.Random(6)
    rows = [(i, prose(rng.randrange(0, 300), i), "en", rng.choice(["hot"] * 5 + ["b", "c", None])) for i in range(150)]
    return rows + [(500, None, "en", "c"), (501, "", "en", "b"), (502, "one", "en", "tiny")]


def test_mix(frame, prose):
    rows = corpus(prose)
    found = mix(frame(rows), shard_words=3000).collect()
    assert sorted(r.doc_id for r in found) == sorted(r[0] for r in rows)
    sizes, taken, target = {}, {}, {}
    for r in found:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
        assert r.taken == r.copies * r.size + sum(p.b - p.a for p in r.parts)
        assert all(0 <= p.a < p.b <= r.size for p in r.parts)
    want = plain_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and {r.source_size for r in found if r.source == s} == {sizes[s]}
        assert abs(taken[s] - target[s]) <= 0.02 * target[s] + 16
    again = mix(frame(rows).repartition(5), shard_words=3000).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in found)


def test_no_rows_empty_texts_and_other_columns(spark):
    schema = "doc_id long, text string, source string, size string, shard int, place int"
    assert mix(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, None, "a", "x", 1, 1), (None, "", None, "x", 1, 1), (1, None, "a", "x", 1, 1)]
    assert [r.taken for r in mix(spark.createDataFrame(rows, schema)).collect()] == [0, 0, 0]
