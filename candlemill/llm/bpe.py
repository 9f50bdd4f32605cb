"""Byte-level BPE over a table of distinct words, and decoding by a join with the pieces.

Every text is split into the words that BPE never merges across. Words are numbered
within blocks of documents, so a word that a block holds a thousand times is one row. These
rows are dealt by word and sorted, each distinct word is encoded once, and the ids go back
to the block, where they take the places of the word. Decoding joins each id with its piece
of the vocabulary and lays the pieces end to end.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.tokens import _byte_of, _ranks, encoder
from candlemill.llm.words import utf8_runs

# Texts are cut into blocks of about this many bytes; a longer text is a block of its own.
BLOCK_BYTES = 16 << 20
# The rows that a block gives back are handed on in parts of about this many ids: both Python
# processes of a task hold several arrays of that length at once.
_PART_IDS = 1 << 18

# Kinds of characters: white space, letters, numbers, others; special tokens come after.
_WHITE, _LETTER, _NUMBER, _OTHER, _SPECIAL = range(5)


def _file(path: str) -> tuple[dict, list[str]]:
    """A tokenizer file as the library reads it, and the strings of its special tokens."""
    tokenizer = encoder(path).tokenizer
    kind = json.loads(tokenizer.to_str())
    plain = all(
        not (t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized"))
        for t in kind["added_tokens"]
    )
    if _ranks(kind) is None or not plain:
        raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
    return kind, [t["content"] for t in kind["added_tokens"]]


class Splitter:
    """Splits texts as byte-level BPE does before merging, whole runs of texts at a time.

    That is: special tokens first; then runs of letters, of numbers and of other characters,
    each with one blank before it; the endings 's 'd 'm 't 'll 've 're; and white space,
    whose last character stands alone before a word that does not take it.
    """

    def __init__(self, special: list[str]):
        longest = sorted((t.encode() for t in special), key=len, reverse=True)
        self.special = re.compile(b"|".join(map(re.escape, longest))) if special else None
        self.kinds = _kinds()

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the words of the texts between ``offsets`` begin, in UTF-8 bytes."""
        if not len(data):
            return np.zeros(0, np.int64)
        at, point = _points(data)
        kind = self.kinds[point]
        edge = np.zeros(len(at) + 3, bool)
        edge[np.searchsorted(at, offsets)] = True
        fresh = edge[: len(at)].copy()
        fresh[1:] |= kind[1:] != kind[:-1]
        self._mark_special(data, offsets, at, kind, fresh)
        word = np.flatnonzero(fresh & ~edge[: len(at)] & (kind != _WHITE) & (kind != _SPECIAL))
        word = word[kind[word - 1] == _WHITE]
        begins = fresh.copy()
        begins[word - 1] = True
        begins[word[point[word - 1] == 0x20]] = False
        self._cut_endings(point, kind, fresh, edge, begins)
        return at[begins]

    def _mark_special(self, data, offsets, at, kind, fresh) -> None:
        content = data.tobytes()
        if self.special is None or not self.special.search(content):
            return
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            for found in self.special.finditer(content, a, b):
                first, last = np.searchsorted(at, found.span())
                kind[first:last], fresh[first:last] = _SPECIAL, False
                fresh[first] = True
                if last < len(at):
                    fresh[last] = True

    def _cut_endings(self, point, kind, fresh, edge, begins) -> None:
        i = np.flatnonzero(begins & (point == 0x27))
        # The mark is alone, and letters of the same text follow.
        i = i[i + 1 < len(point)]
        i = i[~edge[i + 1] & fresh[i + 1] & (kind[i + 1] == _LETTER) & (kind[i] == _OTHER)]
        one = np.isin(point[i + 1], [ord(c) for c in "sdmt"])
        padded = np.append(point[:], [0, 0])
        pair = (padded[i + 1] << 8) | np.where(edge[i + 2], 0, padded[i + 2])
        two = np.isin(pair, [ord(a) << 8 | ord(b) for a, b in ("ll", "ve", "re")])
        begins[(i + 1)[one | two]] = False
        after = np.concatenate([(i + 2)[one], (i + 3)[two]])
        begins[after[after < len(begins)]] = True


def _points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the characters of UTF-8 bytes begin, and their code points."""
    if data.max() < 0x80:
        return np.arange(len(data)), data.astype(np.int32)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int32)
    point = lead.copy()
    padded = np.append(data, [0x80, 0x80, 0x80]).astype(np.int32) & 0x3F
    for least, bits, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        some = np.flatnonzero((lead >= least) & (lead < 0x100 - (bits + 1) // 2))
        value = lead[some] & bits
        for k in range(1, more + 1):
            value = value << 6 | padded[at[some] + k]
        point[some] = value
    return at, point


_table: list[np.ndarray] = []


def _kinds() -> np.ndarray:
    """The kind of each code point, as the tokenizers' own expression engine has it."""
    if not _table:
        from tokenizers import Regex, pre_tokenizers

        kinds = np.full(0x110000, _OTHER, np.uint8)
        for kind, name in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_WHITE, r"\s")):
            others = pre_tokenizers.Split(Regex(f"{name}+"), "removed").pre_tokenize_str
            mine = np.ones(0x110000, bool)
            # Short strings, as the places of what is found are counted from the beginning.
            for first in range(0, 0x110000, 1024):
                if 0xD800 <= first < 0xE000:
                    mine[first : first + 1024] = False
                    continue
                for run, _ in others("".join(map(chr, range(first, first + 1024)))):
                    mine[np.frombuffer(run.encode("utf-32-le"), "<u4")] = False
            kinds[mine] = kind
        _table.append(kinds)
    return _table[0]


def _flat(texts: pa.Array, split: Splitter) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts in order, and the number of words of each text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    starts, sizes = [], []
    for first, _, data, places in utf8_runs(texts):
        begins = split.starts(data, places)
        starts.append(begins + offsets[first])
        sizes.append(np.diff(np.searchsorted(begins, places)))
    starts = np.concatenate([*starts, [offsets[-1]]])
    content = texts.buffers()[2]
    if content is None:
        return pa.array([], pa.large_binary()), np.zeros(len(texts), np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), content])
    return words, np.concatenate(sizes)


def _blocks(batches: Iterator[pa.RecordBatch], special: list[str], most: int):
    """(block, doc_ids, words of each row, numbered words, distinct words) of each block."""
    split, block = Splitter(special), TaskContext.get().partitionId() << 32
    for batch in batches:
        if not batch.num_rows:
            continue
        flat, sizes = _flat(batch.column(1), split)
        offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset :][: len(flat) + 1]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = 0
        while at < len(sizes):
            room = offsets[ends[at]] + most if len(flat) else 0
            to = int(np.searchsorted(offsets[ends], room, "right")) - 1 if len(flat) else len(sizes)
            to = min(max(to, at + 1), len(sizes))
            coded = flat.slice(ends[at], ends[to] - ends[at]).dictionary_encode()
            codes, words = _by_frequency(coded.indices.to_numpy(), coded.dictionary)
            yield block, batch.column(0).slice(at, to - at), sizes[at:to], codes, words
            block += 1
            at = to


def _by_frequency(codes: np.ndarray, words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Frequent words get small numbers, whose high bytes are zero."""
    order = np.argsort(-np.bincount(codes, minlength=len(words)), kind="stable")
    number = np.empty(len(words), np.int32)
    number[order] = np.arange(len(words), dtype=np.int32)
    return number[codes], words.take(pa.array(order))


def _words_of_blocks(special: list[str], most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, _, _, words in _blocks(batches, special, most):
            n = len(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)), words.cast(pa.large_string()).cast(pa.string())],
                ["block", "n", "word"],
            )

    return run


def _laid_out(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, their bytes laid out by weight so that they compress."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _read_back(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _packed(values: np.ndarray) -> bytes:
    return zlib.compress(_laid_out(values), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return _read_back(zlib.decompress(data))


def _texts_of_blocks(special: list[str], most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, sizes, codes, words in _blocks(batches, special, most):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block]),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([_packed(sizes)], pa.binary()),
                    pa.array([_packed(codes)], pa.binary()),
                    pa.array([len(words)], pa.int64()),
                ],
                ["block", "doc_ids", "sizes", "codes", "distinct"],
            )

    return run


def _encode_sorted(path: str):
    """Rows sorted by word: each word is encoded where it first comes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last, known = encoder(path).encode, None, b""
        for batch in batches:
            coded = batch.column(2).dictionary_encode()
            words = coded.dictionary.to_pylist()
            if not words:
                continue
            found = [known if i == 0 and w == last else encode(w) for i, w in enumerate(words)]
            last, known = words[-1], found[-1]
            sizes = np.array([len(f) // 4 for f in found])
            values = np.frombuffer(b"".join(found), "<u4")
            block, n, word = (x.to_numpy() for x in (batch.column(0), batch.column(1), coded.indices))
            order = np.argsort(block, kind="stable")
            block, n, counts = block[order], n[order], sizes[word[order]]
            ids = values[_spread((np.cumsum(sizes) - sizes)[word[order]], counts)]
            after = np.concatenate([[0], np.cumsum(counts)])
            edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
            rows = [
                _laid_out(np.concatenate([n[a:b], counts[a:b], ids[after[a] : after[b]]]))
                for a, b in zip(edges[:-1], edges[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[edges[:-1]]), pa.array(np.diff(edges)), pa.array(rows, pa.binary())],
                ["block", "words", "ids"],
            )

    return run


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places ``start``, ``start + 1``, ... of each stretch, one stretch after another."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


_ENCODED = "doc_id long, ids array<int>"
_ENCODED_ARROW = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])


def _placed(texts: pa.Table, words: pa.Table) -> pa.Table:
    """The ids of a block's words at all the places where the words stand."""
    distinct = texts.column("distinct")[0].as_py() if texts.num_rows == 1 else -1
    lengths, starts, parts, total = np.full(max(distinct, 0), -1, np.int64), np.zeros(max(distinct, 0), np.int64), [], 0
    for m, data in zip(words.column("words").to_pylist(), words.column("ids").to_pylist()):
        numbers = _read_back(data).astype(np.int64)
        n, counts = numbers[:m], numbers[m : 2 * m]
        if n.max() >= distinct:
            distinct = -1
            break
        lengths[n], starts[n] = counts, total + np.cumsum(counts) - counts
        parts.append(numbers[2 * m :].astype(np.int32))
        total += len(parts[-1])
    if distinct < 0 or (lengths < 0).any():
        raise RuntimeError("a block was read differently the second time: store the documents first")
    values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    sizes = _unpacked(texts.column("sizes")[0].as_py()).astype(np.int64)
    codes = _unpacked(texts.column("codes")[0].as_py())
    doc_ids = texts.column("doc_ids").combine_chunks().flatten()
    ends = np.cumsum(sizes)
    out, row, word = [], 0, 0
    while row < len(sizes):
        to = max(int(np.searchsorted(ends, word + _PART_IDS, "right")), row + 1)
        part = codes[word : ends[to - 1]]
        counts = lengths[part]
        after = np.concatenate([[0], np.cumsum(counts)])
        offsets = after[np.concatenate([[word], ends[row:to]]) - word].astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[_spread(starts[part], counts)]))
        out.append(pa.RecordBatch.from_arrays([doc_ids.slice(row, to - row), lists], schema=_ENCODED_ARROW))
        row, word = to, ends[to - 1]
    return pa.Table.from_batches(out, _ENCODED_ARROW)


def encode(docs: DataFrame, tokenizer_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ids of every text: (doc_id, ids), one row for each row of ``docs``.

    Ids are those of the tokenizers library without special tokens of its own accord; the
    string of a special token within a text becomes its id. A null or empty text has no ids.
    Repeated rows and null ids come back as often as they come, an empty table gives none,
    further columns are not looked at.

    ``docs`` is read twice, so it must be a stored table (files, or a checkpoint). A file
    that is not plain byte-level BPE is refused.
    """
    _, special = _file(tokenizer_path)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    words = rows.mapInArrow(_words_of_blocks(special, block_bytes), "block long, n int, word string")
    texts = rows.mapInArrow(
        _texts_of_blocks(special, block_bytes),
        "block long, doc_ids array<long>, sizes binary, codes binary, distinct long",
    )
    ids = (
        words.repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(_encode_sorted(tokenizer_path), "block long, words long, ids binary")
    )
    return texts.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(_placed, _ENCODED)


def pieces(tokenizer_path: str) -> list[bytes | None]:
    """The bytes of each id, by id: one entry for each of the tokenizer's file."""
    kind, _ = _file(tokenizer_path)
    byte_of = _byte_of()
    names = {i: token for token, i in kind["model"]["vocab"].items()}
    names |= {t["id"]: t["content"] for t in kind["added_tokens"]}
    table: list[bytes | None] = [None] * (max(names, default=-1) + 1)
    for i, token in names.items():
        plain = all(c in byte_of for c in token)
        table[i] = bytes(byte_of[c] for c in token) if plain else token.encode()
    return table


_DECODED = "doc_id long, ids array<int>, text string"
_DECODED_ARROW = pa.schema([*_ENCODED_ARROW, ("text", pa.string())])


def _join_pieces(table: pa.Array):
    """Ids joined with their pieces by index; the pieces of a row laid end to end."""

    def joined(rows: pa.RecordBatch) -> pa.RecordBatch:
        ids = rows.column(1)
        offsets = np.concatenate([[0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy())])
        flat = ids.flatten()
        known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(table)))
        found = table.take(pc.if_else(known, flat, None)).fill_null(b"")
        edges = np.frombuffer(found.buffers()[1], np.int64)[found.offset :][offsets].tolist()
        content = memoryview(found.buffers()[2] or b"")
        texts = [str(content[a:b], "utf-8", "replace") for a, b in zip(edges[:-1], edges[1:])]
        columns = [rows.column(0), ids, pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(columns, schema=_DECODED_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(batch.column(1).value_lengths().fill_null(0).to_numpy().astype(np.int64))
            at, before = 0, 0
            while at < batch.num_rows:
                to = max(int(np.searchsorted(ends, before + _PART_IDS, "right")), at + 1)
                yield joined(batch.slice(at, to - at))
                at, before = to, int(ends[to - 1])

    return run


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """The text of each row of (doc_id, ids array<int>), beside its ids: (doc_id, ids, text).

    Each task joins its ids with the pieces, a table no longer than the vocabulary of the
    tokenizer's file, which goes to all tasks. The join is by index, in Arrow: exploded ids
    in Spark's broadcast join came to twice the time of all the rest. Bytes that are no
    UTF-8 become U+FFFD. Null or no ids give an empty text; ids beyond the vocabulary give
    nothing.
    """
    table = pa.array(pieces(tokenizer_path), pa.large_binary())
    return encoded.select("doc_id", "ids").mapInArrow(_join_pieces(table), _DECODED)


def bpe(docs: DataFrame, tokenizer_path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Digests of the ids of each text and of the text decoded from them.

    (doc_id, n_tokens, ids_sha256, decoded_sha256), one row for each row of ``docs``; odd
    inputs as in :func:`encode` and :func:`decode`.
    """
    decoded = decode(encode(docs, tokenizer_path, block_bytes), tokenizer_path)
    # The numbers in JSON, less its brackets: quicker than a text for each id.
    decoded = decoded.withColumn("json", F.to_json("ids"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.expr("substring(json, 2, length(json) - 2)"), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
