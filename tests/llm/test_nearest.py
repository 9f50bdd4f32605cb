"""Nearest neighbours beside brute force."""

import numpy as np
import pytest

from candlemill.llm import nearest as N

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, every=20, k=20):
    ok = [
        (i, np.array(v, np.float32).astype(float))
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    size = max({len(v) for _, v in ok}, key=lambda d: sum(len(v) == d for _, v in ok))
    ok = {(i, v.tobytes()): v for i, v in ok if len(v) == size}
    out = {}
    for (i, _), q in ok.items():
        if i % every == 0:
            near = [(-float((v * q).sum()), j) for (j, _), v in ok.items() if j != i]
            out[i] = sorted(near)[:k]
    return out


def compare(spark, rows, **options):
    docs = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA).repartition(3)
    found = {}
    for r in N.nearest(docs, **options).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(rows)
    hit = total = 0
    assert set(found) == {q for q in want if want[q]}
    for q, near in want.items():
        mine = sorted(found.get(q, []))
        assert [r[0] for r in mine] == list(range(1, len(near) + 1))
        assert [(-s, j) for _, j, s in mine] == sorted((-s, j) for _, j, s in mine)
        hit += len({j for _, j in near} & {r[1] for r in mine})
        total += len(near)
    return hit / total


@pytest.mark.parametrize("block", [2048, 50])
def test_exact_where_all_lists_are_searched(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "LIST_ROWS", 60)
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=12).astype(np.float32).tolist()) for i in range(300)]
    same = rows[40][1]
    rows += [(i, same) for i in range(300, 360)]  # one vector many times, queries among them
    rows += [(400, [0.0] * 12), (401, None), (402, [1.0, None] + [0.0] * 10), (403, [float("nan")] * 12)]
    rows += [(404, [1.0]), (None, same), (420, [float("inf")] * 12), rows[20]]
    assert compare(spark, rows, probed_share=1.0) == 1.0


def test_recall_with_lists(spark, monkeypatch):
    monkeypatch.setattr(N, "LIST_ROWS", 100)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=32).astype(np.float32).tolist()) for i in range(1500)]
    assert compare(spark, rows) >= 0.9


def test_few_or_no_rows(spark):
    assert N.nearest(spark.createDataFrame([], SCHEMA)).collect() == []
    assert N.nearest(spark.createDataFrame([(0, [0.0], 1, "x")], SCHEMA)).collect() == []
    assert N.nearest(spark.createDataFrame([(0, [2.0], 1, "x")], SCHEMA)).collect() == []
    found = N.nearest(spark.createDataFrame([(0, [2.0], 1, "x"), (3, [1.0], 1, "x")], SCHEMA)).collect()
    assert [tuple(r) for r in found] == [(0, 1, 3, 2.0)]


def test_errors_lie_within_their_bounds():
    rng = np.random.default_rng(2)
    vectors, queries = rng.normal(size=(400, 48)), rng.normal(size=(20, 48))
    center = vectors.mean(axis=0)
    estimate, error = N.Codes(vectors, center, N.rotation(48)).estimate(queries)
    off = np.abs(estimate - queries @ vectors.T)
    assert (off <= error).mean() > 0.99 and off.mean() < 0.1 * 48
