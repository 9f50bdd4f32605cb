"""Quality, toxicity and language by held-out rows and by their parts."""

import random

import numpy as np
import pyarrow as pa
import pytest

from candlemill.llm import language as L
from candlemill.llm import quality as Q
from candlemill.llm import toxicity as T

LABELS = "doc_id long, quality int, toxic int, text string"


def corpus(prose, n=240):
    """Half of the documents shout; a third holds an insult in some spelling."""
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        words = prose(rng.randrange(20, 60), i).split()
        toxic, good = i % 3 == 0, i % 2 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = "vexnard" + rng.choice(["o", "a", "ing", "um", "eth"]) + rng.choice("bcdfg")
        rows.append((i, " ".join(words) if good else "!! ".join(words).upper()))
        labels.append((i, int(good), int(toxic), "other"))
    return rows, labels


def extra(rows):
    return rows + [(1000, None), (1001, ""), (None, "w1 w2"), rows[0]]


def judged(found, labels, label):
    want = {r[0]: r[label] for r in labels}
    out = [r for r in found if r.held_out and r.doc_id in want]
    return np.mean([r.predicted == want[r.doc_id] for r in out])


def test_quality(spark, frame, prose):
    rows, labels = corpus(prose)
    found = Q.quality(frame(extra(rows)), spark.createDataFrame(labels + labels[:3], LABELS)).collect()
    assert len(found) == len(rows) + 4 and all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == (r.score >= 0.5) for r in found)
    assert judged(found, labels, 1) > 0.97
    assert [r.held_out for r in found if r.doc_id is None] == [False]


def test_toxicity_with_unseen_spellings(spark, frame, prose):
    rows, labels = corpus(prose)
    found = T.toxicity(frame(extra(rows)), spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(rows) + 4 and all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == (r.score >= 0.3) for r in found)
    assert judged(found, labels, 2) > 0.95
    scores = {}
    for r in found:
        assert scores.setdefault(r.doc_id, r.score) == r.score


def test_one_label_or_none(spark, frame, prose):
    docs = frame([(i, prose(9, i)) for i in range(5)])
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in Q.quality(docs, none).collect()} == {0.5}
    assert {r.predicted for r in T.toxicity(docs, none).collect()} == {0}
    ones = spark.createDataFrame([(i, 1, 0, "") for i in range(5)], LABELS)
    assert {r.score for r in Q.quality(docs, ones).collect()} == {1.0}
    empty = frame([])
    for found in (Q.quality(empty, none), T.toxicity(empty, none), L.language_id(empty)):
        assert found.collect() == []


def test_isotonic_is_the_nearest_rising_fit():
    good, count = np.array([1.0, 0, 3, 2, 5]), np.array([2.0, 2, 4, 4, 5])
    found = Q.isotonic(np.arange(5), good, count)
    assert found == pytest.approx([0.25, 0.25, 0.625, 0.625, 1.0]) and (np.diff(found) >= 0).all()


def test_statistics_do_not_depend_on_the_batch(prose):
    texts = [prose(30, 1), None, "", "x", "A!! b\n" * 9]
    whole = Q.statistics(pa.array(texts))
    for i, t in enumerate(texts):
        assert Q.statistics(pa.array([t], pa.string()))[0] == pytest.approx(whole[i])


def test_fourier_features_approximate_a_gaussian_kernel():
    x = np.random.default_rng(0).normal(size=(20, 6))
    z = Q.Fourier(np.zeros(6), np.ones(6), 20_000, 1)(x)[:, 1:]
    apart = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert np.abs(z @ z.T - np.exp(-apart / (2 * 6))).max() < 0.05


def speech(lang, n, seed):
    rng = random.Random(seed)
    parts = {"xa": ["ka", "lo", "mi", "ru"], "xb": ["sch", "ung", "ein", "öt"], "xc": ["ção", "des", "quê", "nh"]}[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_language(frame):
    rows = [(i, speech(lang, 12, i), lang) for i in range(150) for lang in [["xa", "xb", "xc"][i % 3]]]
    rows += [(1000, None, "xa"), (1001, "12 !? \n", "xa"), (1002, "", None), (None, speech("xb", 9, 1), None)]
    found = {r.doc_id: r for r in L.language_id(frame(rows)).collect()}
    out = [(found[r[0]].lang_pred, r[2]) for r in rows[:150] if found[r[0]].held_out]
    assert np.mean([a == b for a, b in out]) > 0.97
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (1000, 1001, 1002))
    assert found[None].lang_pred == "xb" and all(0 <= r.score <= 1 for r in found.values())


def test_nothing_to_learn(frame):
    found = L.language_id(frame([(1, "some words", None), (2, "more", None)])).collect()
    assert {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}


def test_backoff_takes_the_longest_known_gram():
    from candlemill.llm.words import utf8_runs

    def hashes(text):
        _, _, data, offsets = next(utf8_runs(pa.array([text])))
        _, _, h = L._words(data, offsets)
        return h(np.array([0]), np.array([len(data)]))[0]

    entries = [(0, "abc", 1, 9), (0, "o", 9, 1), (4, "xy", 9, 1), (4, "qq", 1, 9), (5, "z", 1, 9), (5, "q", 9, 1)]
    model = L.build(
        ["l", "r"], np.array([e[0] for e in entries]), np.array([hashes(e[1]) for e in entries]),
        np.array([[e[2], e[3]] for e in entries]),
    )
    _, _, data, offsets = next(utf8_runs(pa.array(["abc xyz"])))
    sums, words = L.totals(model, data, offsets)
    log = np.log
    assert words[0] == 2
    # The known word; of the unseen one "xy", nothing at y, then "z".
    assert sums[0] == pytest.approx([log(0.1) + 0.25 * (log(0.9) + log(0.1)), log(0.9) + 0.25 * (log(0.1) + log(0.9))])


def test_every_entry_above_the_least_count_is_known(frame):
    n = 300_000
    hashes = np.random.default_rng(0).integers(0, 2**63, n, dtype=np.uint64)
    model = L.build(["l"], np.arange(n) % 6, hashes, np.ones((n, 1)))
    for kind in range(6):
        assert (model.find(hashes[kind::6], kind) >= 0).all()
    # The frequent language has as many words as a kind held at most before.
    words = ["".join(chr(97 + i // 26**k % 26) for k in range(4)) for i in range(60_000)]
    rows = [(3 * i, " ".join(words[k : k + 600] * 4), "xa") for i, k in enumerate(range(0, 60_000, 600))]
    rows += [(10_000 + i, "schungein", "xb") for i in range(12)]
    docs = frame(rows)
    fitted = L.fit(docs)
    learned = [r.lang for r in docs.where(~L.held_out_fold()).collect()]
    kinds = fitted.find(L._words(*_run("schungein"))[2](np.array([0]), np.array([9])), 0)
    assert learned.count("xb") >= 3 and kinds[0] >= 0


def _run(text):
    from candlemill.llm.words import utf8_runs

    return next(utf8_runs(pa.array([text])))[2:]
