"""Words and shingles of UTF-8 texts as 64-bit hashes, whole batches at a time in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
# Texts are hashed in runs of about this many bytes; a longer text is a run of its own.
RUN_BYTES = 1 << 18

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finalizer of splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
_BYTE[_SPACE] = 0
_LOWER = _BYTE.copy()
_LOWER[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]

_powers = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, RUN_BYTES + 1)
        have = np.full(size, base & (2**64 - 1), U64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 32 * RUN_BYTES:
            _powers[base] = have
    return have[:n]


def utf8_runs(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) of consecutive texts; a null text has no bytes."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + RUN_BYTES, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the words of a run begin, those of all its texts in order."""
    space = _SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = ~space[edges]
    return np.flatnonzero(begins)


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, lower: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a run, and where each text's words begin.

    A word is a longest stretch without 0x20 and 0x09 to 0x0D; ``lower`` reads A-Z as a-z.
    """
    if not len(data):
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    starts = word_starts(data, offsets)
    if not len(starts):
        return np.zeros(0, U64), np.zeros(len(offsets), np.int64)
    values = (_LOWER if lower else _BYTE)[data] * powers(_BASE, len(data))
    # Spaces count as zero, so a sum up to the next word's start is the word's alone.
    hashes = np.add.reduceat(values, starts) * powers(_BASE_INVERSE, len(data))[starts]
    return mix(hashes), np.searchsorted(starts, offsets).astype(np.int64)


def some_hashes(data: np.ndarray, starts: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` of some of a run's words, as they are written, and which hold a digit.

    ``some`` are places in ``starts``. Only these words' bytes are looked at.
    """
    if not len(some):
        return np.zeros(0, U64), np.zeros(0, bool)
    begin = starts[some]
    length = np.append(starts, len(data))[some + 1] - begin
    first = np.cumsum(length) - length
    within = np.arange(int(length.sum())) - np.repeat(first, length)
    taken = data[np.repeat(begin, length) + within]
    values = _BYTE[taken] * powers(_BASE, int(length.max()))[within]
    return mix(np.add.reduceat(values, first)), np.logical_or.reduceat(_DIGIT[taken], first)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles.

    A text with fewer words has its whole sequence as one shingle; one without words has
    none.
    """
    factors = mix(np.arange(11, 11 + width, dtype=U64))
    for _, _, data, offsets in utf8_runs(texts):
        hashes, first = word_hashes(data, offsets)
        m = len(hashes) - width + 1
        if m > 0:
            joined = hashes[:m] * factors[0]
            for j in range(1, width):
                joined = joined + hashes[j : j + m] * factors[j]
            joined = mix(joined)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= width:
                yield np.unique(joined[a : b - width + 1])
            elif b > a:
                short = (hashes[a:b] * factors[: b - a]).sum(dtype=U64) + U64(b - a)
                yield mix(np.array([short], U64))
            else:
                yield np.zeros(0, U64)
