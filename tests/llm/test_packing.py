"""Packing beside the tokenizer itself."""

import zlib

import numpy as np
import pytest

from candlemill.llm import packing as P
from candlemill.llm.queries import tokenizer_path
from candlemill.llm.tokens import Encoder

PATH = tokenizer_path()
ODD = ["a  b", " a", "a ", "a   b\n\n c", "x<|endoftext|>y z", "it's  don't 's", None, "", "日本 é", "\x85   z\x1c", "\n"]


def plain(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes()


def test_ids_are_the_tokenizers(prose):
    encoder = Encoder(PATH)
    for text in [*ODD, prose(300, 1)]:
        assert encoder.encode(text) == plain(encoder.tokenizer, text)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_other_kinds_of_files(name):
    encoder = Encoder(tokenizer_path(name))
    assert (encoder.merge is None) == name.startswith("word")
    assert encoder.encode("Some text") == plain(encoder.tokenizer, "Some text")


def check(rows, texts, window):
    encoder = Encoder(PATH)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
    for doc_id, text in texts:
        want = encoder.encode(text) + np.array([1], "<u4").tobytes()
        mine = sorted(by_doc[doc_id], key=lambda r: r.start)
        assert b"".join(r.ids for r in mine) == want
        at = 0
        for r in mine:
            assert r.start == at and r.doc_tokens == len(want) // 4
            at += r.length
    sizes = []
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        sizes.append(at)
    assert sum(s < window for s in sizes) <= 1 and max(sizes) == window


@pytest.mark.parametrize("tasks,merged", [(1, 64), (7, 2), (5, 64)])
def test_windows_are_full(frame, prose, monkeypatch, tasks, merged):
    monkeypatch.setattr(P, "MERGED_TASKS", merged)
    texts = [(i, prose(10 + 37 * i % 211, i)) for i in range(60)] + list(enumerate(ODD, 100))
    texts.append((999, prose(5000, 9)))
    docs = frame(texts).repartition(tasks)
    check(P.pack(docs, PATH, window=128, open_windows=4, with_ids=True).collect(), texts, 128)


def test_no_rows_repeated_rows_and_other_columns(spark):
    schema = "doc_id long, text string, start long, length string"
    assert P.pack(spark.createDataFrame([], schema), PATH).collect() == []
    rows = [(1, "a b", 5, "x")] * 3 + [(None, None, 5, "x")]
    found = P.pack(spark.createDataFrame(rows, schema), PATH).collect()
    assert sorted((r.doc_id or 0, r.length) for r in found) == [(0, 1), (1, 3), (1, 3), (1, 3)]
    assert sorted(r.offset for r in found)[-1] <= 9
