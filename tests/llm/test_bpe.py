"""BPE by distinct words beside the tokenizers library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from candlemill.llm import bpe as B
from candlemill.llm.queries import tokenizer_path

PATH = tokenizer_path()
END = "<|endoftext|>"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def plain(tokenizer, rows):
    out = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(back)))
    return sorted(out, key=str)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def split(texts):
    words, sizes = B._flat(pa.array(texts, pa.string()), B.Splitter([END]))
    words, at, out = [w.decode() for w in words.to_pylist()], 0, []
    for n in sizes.tolist():
        out.append(words[at : at + n])
        at += n
    return out


def split_by_library(tokenizer, text):
    out = []
    for i, part in enumerate(text.split(END)):
        out += [END] if i else []
        out += [part[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(part)] if part else []
    return out


def test_words_are_those_of_the_library(tokenizer):
    rng = random.Random(5)
    parts = ["'", "'", *"stmdaZ12.,", "ll", "ve", "re", "v", "l", "r", "e", " ", " ", "  ", "\n", "\t", "\r", END]
    parts += [chr(c) for c in (0x00A0, 0x0085, 0x001C, 0x0663, 0x00E9, 0x4E2D, 0x1F600, 0x2019, 0x2028, 0x0558, 0x1D7D8)]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(6000)]
    assert split(texts) == [split_by_library(tokenizer, t) for t in texts]


def test_every_character_is_of_the_library_s_kind(tokenizer):
    points = [c for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}1{chr(c)} {chr(c)}.{chr(c)}" for c in points]
    assert split(texts) == [split_by_library(tokenizer, t) for t in texts]


def test_ids_and_texts_are_those_of_the_library(spark, frame, prose, tokenizer):
    rows = [(i, prose(40, i)) for i in range(60)]
    rows += [(100, None), (101, ""), (None, "a  b\n\n x y"), (102, f"a{END}b {END} 's")] + [(103, "twice")] * 2
    rows += [(104, "x" * 20_000), (105, prose(30_000, 9)), (106, "\U0001F600 caf" + chr(0xE9) + "   ")]
    docs = frame(rows).withColumnRenamed("lang", "ids").withColumnRenamed("source", "block")
    for block_bytes in (100, 1 << 24):
        found = sorted(map(tuple, B.bpe(docs, PATH, block_bytes).collect()), key=str)
        assert found == plain(tokenizer, rows)


def test_no_rows(frame):
    assert B.bpe(frame([]), PATH).collect() == []


def test_decode_takes_any_ids(spark, tokenizer):
    rows = [(1, [15496, 995]), (2, []), (3, None), (4, [50256, 7]), (5, [10**9, 15496, -1]), (6, [187])]
    found = {r.doc_id: r.text for r in B.decode(spark.createDataFrame(rows, "doc_id long, ids array<int>"), PATH).collect()}
    for doc_id, ids in rows:
        known = [i for i in ids or [] if 0 <= i <= 50256]
        assert found[doc_id] == tokenizer.decode(known, skip_special_tokens=False)


def test_blocks_read_differently_are_refused():
    texts = pa.table({"doc_ids": [[1]], "sizes": [b""], "codes": [b""], "distinct": [3], "block": [0]})
    words = pa.table({"block": [0], "words": [1], "ids": [B._laid_out(np.array([0, 1, 9]))]})
    with pytest.raises(RuntimeError):
        B._placed(texts, words)


def test_other_kinds_of_tokenizers_are_refused(frame):
    with pytest.raises(ValueError):
        B.encode(frame([]), tokenizer_path("word_bpe_49k.json"))


def test_ids_are_decoded_in_small_parts():
    ids = pa.array([[i % 7 for i in range(1000)]] * 600, pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(600), pa.int64()), ids], ["doc_id", "ids"])
    parts = list(B._join_pieces(pa.array([b"ab"] * 7, pa.large_binary()))(iter([batch])))
    assert max(len(p.column(1).flatten()) for p in parts) <= 300_000
    assert [t for p in parts for t in p.column(2).to_pylist()] == ["ab" * 1000] * 600
