"""Line dedup on lines with variable fields; whole tables are compared with SQL."""

import numpy as np
import pyarrow as pa

from candlemill.llm import line_dedup as L
from candlemill.llm.line_dedup import drop_templates, near_copies, recurring_leaves
from candlemill.llm.words import some_hashes, word_hashes, word_starts


def plain(text):
    """Words without digits."""
    return text.translate(str.maketrans("0123456789", "abcdefghij"))


def test_numbers_are_fields_not_templates(frame, prose):
    rows = [(i, f"{plain(prose(30, i))}\n{i} {i + 7} {3 * i}\nPage {i} of 90") for i in range(9)]
    found = lines_of(frame(rows))
    assert all(found[i] == (text.rsplit("\n", 1)[0], 3, 1) for i, text in rows)


def test_short_sentences_with_one_beginning_stay(frame, prose):
    rows = [(i, f"I do not {plain(prose(3, i))}\n{plain(prose(30, 50 + i))}") for i in range(9)]
    assert all(v[2] == 0 for v in lines_of(frame(rows)).values())


def lines_of(docs, **options):
    return {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in drop_templates(docs, **options).collect()}


def test_templates_with_variable_fields_go(frame, prose):
    rows = [(i, f"Printed on page {i} of the big book by {'abcdefgh'[i]}\n{plain(prose(40, i))}") for i in range(8)]
    found = lines_of(frame(rows))
    for i, text in rows:
        assert found[i] == (text.split("\n")[1], 2, 1)


def test_clean_documents_stay_as_they_are(frame, prose):
    rows = [(i, "\n".join(prose(20, 100 * i + j) for j in range(4))) for i in range(20)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, "same line of words here")]
    found = lines_of(frame(rows))
    for i, text in rows:
        assert found[i][0] == text and found[i][2] == 0
    assert found[50][1] == 0 and found[51][1] == 0 and found[52][1] == 3


def test_copies_keep_their_lines_and_count_once(frame, prose):
    text = "\n".join(prose(20, j) for j in range(4))
    assert {v[0] for v in lines_of(frame([(i, text) for i in range(30)])).values()} == {text}
    near = [(i, text + f"\n{prose(10, 900 + i)}") for i in range(30)]
    assert lines_of(frame(near)) == {i: (t, 5, 0) for i, t in near}


def test_rows_repeat_and_columns_clash(spark, prose):
    names = "line words text_key given gone split _key _gone _words heavy copied source leaf".split()
    schema = "doc_id long, text string, n_lines string, " + ", ".join(f"{c} int" for c in names)
    rows = [(i, f"All rights reserved by us.\n{plain(prose(30, i))}", "x", *range(13)) for i in range(6)]
    rows += [rows[0], (None, *rows[1][1:])]
    found = drop_templates(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == 8 and {r.n_dropped for r in found} == {1}
    assert {tuple(r[c] for c in names) for r in found} == {tuple(range(13))}
    assert drop_templates(spark.createDataFrame([], schema)).collect() == []


def test_short_documents_lose_their_boilerplate_and_near_copies_keep_their_lines(frame, prose):
    licence = " ".join(["all rights are reserved and nobody may copy any of this work"] * 5)
    rows = [(i, f"{licence}\n{plain(prose(30, i))}") for i in range(8)]
    copied = "\n".join(plain(prose(30, 100 + j)) for j in range(6))
    rows += [(100 + i, f"{copied}\n{plain(prose(5, 200 + i))}") for i in range(12)]
    found = lines_of(frame(rows))
    for i, text in rows:
        assert found[i] == ((text.split("\n")[1], 2, 1) if i < 100 else (text, 7, 0))


def test_long_lines_recur_from_two_documents_on(frame, prose):
    long, short = plain(prose(51, 1)), plain(prose(50, 2))
    rows = [(i, f"{short}\n{plain(prose(200, 10 + i))}\n{long}") for i in range(2)]
    found = lines_of(frame(rows))
    for i, text in rows:
        assert found[i] == (text.rsplit("\n", 1)[0], 3, 1)


def test_a_pair_of_near_copies_keeps_its_long_lines_but_not_those_of_others(frame, prose):
    shared, own = plain(prose(60, 1)), "\n".join(plain(prose(60, 2 + j)) for j in range(9))
    rows = [(1, f"{shared}\n{own}\nfirst edition"), (2, f"{shared}\n{own}\nsecond edition of it")]
    assert all(found[2] == 0 for found in lines_of(frame(rows)).values())
    rows.append((3, f"{shared}\n{plain(prose(100, 50))}"))
    found = lines_of(frame(rows))
    assert [found[i][2] for i in (1, 2, 3)] == [1, 1, 1]
    assert all(shared not in text for text, *_ in found.values())


def test_digits_count_as_general_and_two_words_may_vary(frame, prose):
    def line(i):
        return f"{i} {i + 3} paid to the account of {'abcdefgh'[i]}x {'abcdefgh'[i]}y {7 * i} {i}"

    rows = [(i, f"{line(i)}\n{plain(prose(30, i))}") for i in range(8)]
    assert {v[2] for v in lines_of(frame(rows)).values()} == {1}


def test_rows_of_numbers_with_a_common_word_stay(frame, prose):
    rows = [(i, f"{prose(12, i)} total\n{prose(60, 90 + i)} end") for i in range(8)]
    assert {v[2] for v in lines_of(frame(rows)).values()} == {0}


def test_very_long_texts(frame, prose):
    own = [[plain(prose(12, 10_000 * i + j, 3000)) for j in range(3000)] for i in range(2)]
    shared = plain(prose(55, 9))
    rows = [(i, "\n".join([*own[i], shared])) for i in range(2)] + [(2, plain(prose(40_000, 5, 3000)))]
    found = lines_of(frame(rows))
    assert [found[i] for i in range(2)] == [("\n".join(own[i]), 3001, 1) for i in range(2)]
    assert found[2] == (rows[2][1], 1, 0)


def test_near_copies_and_lines_of_texts(frame, prose):
    a, b = prose(60, 1), prose(60, 2)
    docs = frame([(1, a), (2, a + " end"), (3, a), (4, b), (5, b), (6, None), (7, ""), (8, " \n")])
    assert len({r.source for r in near_copies(docs).collect()}) == 1 and near_copies(docs).count() == 2
    lines = recurring_leaves(frame([(1, "a b\nc"), (2, "c\n\nd e f"), (3, "c")]), min_docs=2).collect()
    assert sorted((r.line, r.words, r.text_words) for r in lines) == [(0, 1, 1), (0, 1, 4), (1, 1, 3)]


def test_leaves_counted_by_one_task_and_by_joins_agree(frame, prose, monkeypatch):
    def line(i):
        return f"{i} {i + 3} paid to the account of {'abcdefgh'[i % 8]}x {'abcdefgh'[i // 8]}y {7 * i} {i}"

    rows = [(i, f"{line(i)}\nsame {'ab'[i % 2]} words\n{plain(prose(30, i, 9))}\n{plain(prose(8, i // 3, 4))}") for i in range(40)]
    lines = L.saved(recurring_leaves(frame(rows)), "lines")
    copies = L.saved(lines.selectExpr("text_key").distinct().orderBy("text_key").limit(9).selectExpr("text_key", "min(text_key) OVER () AS source"), "copies")
    for known in (None, copies):
        found = []
        for leaf, task in ((1 << 20, 1 << 19), (1 << 20, 60), (100, 1 << 19), (0, 0)):
            monkeypatch.setattr(L, "LEAF_TOKENS", leaf)
            monkeypatch.setattr(L, "TASK_TOKENS", task)
            found.append(sorted(map(str, L.template_lines(lines, copies=known).collect())))
        assert len(found[0]) > 30 and all(f == found[0] for f in found)


def test_only_leaves_of_very_many_tokens_are_counted_by_joins(frame, prose, monkeypatch):
    lines = L.saved(recurring_leaves(frame([(i, f"one line of all\n{plain(prose(9, i))}") for i in range(9)])), "lines")
    given = []
    spread = L._spread_leaves
    monkeypatch.setattr(L, "_spread_leaves", lambda rows, *most: given.append(rows.count()) or spread(rows, *most))
    for most, spread_lines in ((36, []), (35, [9])):
        monkeypatch.setattr(L, "LEAF_TOKENS", most)
        assert L.template_lines(lines).count() == 9 and given == spread_lines


def test_some_words_have_the_hashes_of_all_words():
    texts = ["one 2two  thrée\n\tfour5", "", " \n", "five", "six seven"]
    joined = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(joined), np.uint8)
    offsets = np.cumsum([0, *map(len, joined)])
    starts = word_starts(data, offsets)
    hashes, digits = some_hashes(data, starts, np.arange(len(starts)))
    assert hashes.tolist() == word_hashes(data, offsets, lower=False)[0].tolist()
    assert digits.tolist() == [False, True, False, True, False, False, False]
    for some in ([], [0], [6], [1, 4, 5]):
        assert some_hashes(data, starts, np.array(some, int))[0].tolist() == hashes[some].tolist()


def test_only_leading_words_and_lines_of_recurring_leaves_are_hashed(spark, prose, monkeypatch):
    lines = [f"{plain(prose(20, i))}" for i in range(30)]
    texts = ["\n\n".join(lines[:10]), None, "\n".join(lines[10:]), ""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4)), pa.array(texts)], names=["text_key", "text"])
    leaves = pa.Table.from_batches(L._parse(3)([batch])).to_pydict()
    wanted = leaves["leaf"][4:6] + leaves["leaf"][20:21]
    among = L._leaf_bits(spark.createDataFrame([(leaf,) for leaf in wanted], "leaf long"))
    assert np.unpackbits(among).sum() == 3 and not L._leaf_bits(spark.createDataFrame([], "leaf long")).any()
    hashed = []
    monkeypatch.setattr(L, "some_hashes", lambda data, starts, some: hashed.append(len(some)) or some_hashes(data, starts, some))
    found = pa.Table.from_batches(L._parse(3, among)([batch])).to_pydict()
    assert sum(hashed) == 30 * 3 + 3 * 20
    assert (found["leaf"], found["line"], found["text_key"]) == (wanted, [8, 10, 10], [0, 0, 2])
    assert found["text_words"] == [200, 200, 400] and [len(t) for t in found["tokens"]] == [20] * 3
    data = np.frombuffer(lines[20].encode(), np.uint8)
    every = word_hashes(data, np.array([0, len(data)]), lower=False)[0]
    assert found["tokens"][2] == every.view(np.int64).tolist()
