"""Secrets and fingerprints, both built-in expressions only."""

import hashlib
import random
import re
import string

import pytest

from candlemill.llm import fingerprints as F
from candlemill.llm.secrets import KINDS, secrets

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
B64 = string.ascii_letters + string.digits + "+/"
PLAIN = "the quick brown internationalization src/main/java/com/example thisIsACamelCaseIdentifierName".split()


def base(text):
    text, out = text or "", []
    for m in ASSIGN.finditer(text):
        if len(m[1]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def written(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_secrets(frame):
    rng = random.Random(3)

    def some(alphabet, n):
        return "".join(rng.choice(alphabet) for _ in range(n))

    rows = []
    for i in range(120):
        text = " ".join(rng.choice(PLAIN) for _ in range(rng.randrange(60)))
        if i % 7 == 0:
            text += " é𝄞 " + some(B64, 40) + " x"
        if i % 5 == 0:
            text += f' Api_Key: "{some(B64[:62], rng.randrange(4, 14))}" password=token:abcdefgh12 Token = x'
        if i % 11 == 0:
            text += " AKIA" + some(string.ascii_uppercase, rng.randrange(9, 20)) + some("0123456789abcdef", 40)
        rows.append((i, text))
    rows += [(500, " ".join(["0123456789abcdef" * 2] * 700)), (501, None), (502, ""), (503, "token="), (None, "secret=abcdefgh"), rows[0]]
    found = secrets(frame(rows)).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    hit = false = 0
    for r in found:
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(written(want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in want) for j in range(3))
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("random")] == (written(want).split(",") if want else [])
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)
        if r.doc_id is not None and r.doc_id < 500:
            hit, false = (hit + r.n_random, false) if r.doc_id % 7 == 0 else (hit, false + r.n_random)
    assert hit >= 17 and false == 0
    assert secrets(frame([])).collect() == []


def test_keys_in_paths_are_found(frame):
    rng = random.Random(5)
    rows, keys = [], {}
    for i in range(90):
        text = " ".join(rng.choice(PLAIN) for _ in range(rng.randrange(5, 60)))
        if i % 3 == 0:
            before = ["prod/api-key/", "https://host.example/app_v2/", "my_dir/some-where/"][i // 3 % 3]
            keys[i] = "".join(rng.choice(B64[:62]) for _ in range(40))
            text += f" {before}{keys[i]}/end_of-it x"
        rows.append((i, text))
    hit = 0
    for r in secrets(frame(rows)).collect():
        spans = [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("random")]
        assert len(spans) == r.n_random <= (r.doc_id in keys)
        hit += any(keys[r.doc_id] in rows[r.doc_id][1][a:b] for a, b in spans)
    assert hit >= 26


def test_no_python_in_the_plans(frame, prose):
    rows = frame([(i, prose(20, i)) for i in range(5)])
    for df in (secrets(rows), F.fingerprints(rows)):
        assert "Python" not in df._jdf.queryExecution().toString()


@pytest.mark.parametrize("stretch", [1000, 7])
def test_fingerprints(frame, prose, monkeypatch, stretch):
    monkeypatch.setattr(F, "STRETCH_ROWS", stretch)
    rng = random.Random(1)
    rows = [(i * 3, prose(rng.randrange(12, 200), i, 5000)) for i in range(60)]
    rows += [(1000, None), (1001, ""), (1002, "ab"), (1003, "é𝄞ü abc"), (-5, " \n"), (2000, rows[3][1])]
    found = {r.doc_id: r for r in F.fingerprints(frame(rows).repartition(4)).collect()}
    ordered = sorted((d, t or "") for d, t in rows)
    for k, (doc_id, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        r = found[doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(text) > 60:
            assert r.near_edited > r.near_next
        same = found[ordered[(k + 1) % len(ordered)][0]].fingerprint == r.fingerprint
        assert (r.near_next == 1) == same
    assert found[2000].fingerprint == found[9].fingerprint
    assert found[1000].fingerprint == found[1001].fingerprint == ""


def test_order_matters(spark, prose):
    words = prose(200, 5, 10**6).split()
    texts = [" ".join(words), " ".join(words[100:] + words[:100]), " ".join(words[:150]), prose(200, 6, 10**6)]
    df = F.with_fingerprint(spark.createDataFrame([(t,) for t in texts], "text string"), "text", "p")
    whole, swapped, head, other = (r.p for r in df.collect())

    def like(a, b):
        return sum(x == y for x, y in zip(a, b)) / len(a)

    assert like(whole, other) == 0 and 0 < like(whole, swapped) < 0.9 and like(whole, head) > 0.3


def test_repeated_rows_and_null_ids(frame):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "x y"), (None, "p q"), (7, "z")]
    assert len(F.fingerprints(frame(rows)).collect()) == 5
    assert F.fingerprints(frame([])).collect() == []
    alone = F.fingerprints(frame([(4, "one two three four")])).first()
    assert alone.near_next == 1.0


def test_each_component_draws_from_all_kmers(spark, prose):
    texts = [prose(1000, i, 10**6) for i in range(12)]
    words = [t.split() for t in texts]
    rng = random.Random(4)
    for w in words:
        for _ in range(25):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**9)}"
    rows = [(t, " ".join(w)) for t, w in zip(texts, words)]
    df = spark.createDataFrame(rows, "text string, edited string")
    df = F.with_fingerprint(F.with_fingerprint(df, "text", "p"), "edited", "q")
    found = df.withColumn("near", F.likeness("p", "q")).collect()
    # Independent pairs of 1,000 k-mers hardly ever meet.
    assert all(len(set(r.p)) >= 31 for r in found)
    # 5 % of the k-mers are replaced: both minima stay with about 0.905 ** 2.
    assert 0.76 < sum(r.near for r in found) / len(found) < 0.88


def test_minima_of_parts_give_the_fingerprints_of_whole_texts(spark, frame, prose):
    rng = random.Random(8)
    texts = [prose(rng.randrange(1, 120), i, 40) for i in range(60)]
    texts += ["", " ", "one", "a" * 50, "a b " * 300, "x" * 13 + " y", prose(20_000, 1, 300)]
    rows = list(enumerate(texts))
    docs = frame([*rows, (100, None)]).withColumnRenamed("lang", "print").withColumnRenamed("source", "common")
    found = {r.doc_id: r for r in F.fingerprints(docs).collect()}
    texts = [*texts, ""]
    edited = [t[: len(t) - len(t) // 4] + texts[(i + 1) % len(texts)][: len(t) // 4] for i, t in enumerate(texts)]
    whole = spark.createDataFrame([(i, t, e) for i, (t, e) in enumerate(zip(texts, edited))], "n int, t string, e string")
    whole = F.with_fingerprint(F.with_fingerprint(whole, "t", "p"), "e", "q")
    for r in whole.select("n", F.in_hex("p").alias("p"), F.in_hex("q").alias("q")).collect():
        doc_id = r.n if r.n < len(rows) else 100
        assert (found[doc_id].fingerprint, found[doc_id].edited_fingerprint) == (r.p, r.q)


M64 = 2**64 - 1


def xx(value, seed):
    """xxhash64 of a long by its definition; signed as in Spark."""
    p1, p2, p3 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
    p4, p5 = 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5

    def turn(x, n):
        return (x << n | x >> (64 - n)) & M64

    h = (seed + p5 + 8) & M64
    h ^= turn((value & M64) * p2 & M64, 31) * p1 & M64
    h = (turn(h, 27) * p1 + p4) & M64
    h = (h ^ h >> 33) * p2 & M64
    h = (h ^ h >> 29) * p3 & M64
    h ^= h >> 32
    return h - 2**64 if h >> 63 else h


def pair_prints(kmers):
    """The fingerprint of a list of k-mer hashes; equal ones count once, at the first place."""
    kmers = list(dict.fromkeys(kmers))
    found = []
    for seed in F._seeds(F.COMPONENTS) if kmers else []:
        least = sorted(kmers, key=lambda k: xx(seed, xx(k, 42)))[:2]
        h = 0
        for k in sorted(least, key=kmers.index):
            h = xx(k, xx(h, 42))
        found.append(h)
    return found


def test_prints_of_given_kmers(spark):
    rng = random.Random(6)
    lists = [[rng.randrange(1 << 34) for _ in range(n)] for n in (0, 1, 2, 3, 40, 257)]
    lists += [[5], [5, 5, 5], [0, 9, 0, 9, 7], [rng.randrange(30) for _ in range(200)], list(range(64))]
    rows = [(i // 4, i % 4, f"note {i}", kmers) for i, kmers in enumerate(lists)]
    df = spark.createDataFrame(rows, "part int, place int, note string, kmers array<long>").repartition(3, "part")
    df = F.with_prints(df, ["part", "place"], "kmers", "p")
    assert df.columns == ["part", "place", "note", "p"]
    # Dealt by one of the keys: no shuffle besides.
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {r.note: r.p for r in df.collect()} == {f"note {i}": pair_prints(k) for i, k in enumerate(lists)}


def test_minima_are_not_made_in_lambdas(spark, frame, prose):
    """Lambdas over arrays are interpreted, which took most of the time of large tables."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        df = F.fingerprints(frame([(i, prose(20, i)) for i in range(5)]))
        plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    seeded = [line for line in plan if any(str(s) in line for s in F._seeds(F.COMPONENTS))]
    assert seeded and all("HashAggregate" in line and "transform" not in line for line in seeded)


@pytest.mark.parametrize("stretch", [1000, 3])
def test_fingerprints_of_repeated_and_null_ids(spark, frame, prose, monkeypatch, stretch):
    monkeypatch.setattr(F, "STRETCH_ROWS", stretch)
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(6)]), prose(rng.randrange(12), i % 9, 5)) for i in range(40)]
    rows += [(3, None), (None, None), *rows[:10]]
    ordered = sorted(((d is not None, d or 0, t or "") for d, t in rows))
    after = [*ordered[1:], ordered[0]]
    want = [(*a, a[2][: len(a[2]) - len(a[2]) // 4] + b[2][: len(a[2]) // 4], b[2]) for a, b in zip(ordered, after)]
    df = spark.createDataFrame(want, "known boolean, doc_id long, text string, edited string, after string")
    for column in ("text", "edited", "after"):
        df = F.with_fingerprint(df, column, f"p_{column}")
    df = df.selectExpr("if(known, doc_id, null)", "length(text)", "sha2(edited, 256)", "p_text", "p_edited", "p_after")
    df = df.toDF("doc_id", "n_chars", "sha", "p", "e", "a").select(
        "doc_id", "n_chars", "sha", F.in_hex("p"), F.in_hex("e"), F.likeness("p", "e"), F.likeness("p", "a")
    )
    found = F.fingerprints(frame(rows).repartition(5)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, map(tuple, df.collect())))
