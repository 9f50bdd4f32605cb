"""Token ids of texts by a public tokenizer file, as packed little-endian integers."""

from __future__ import annotations

import json
import os
import sys
from array import array

import numpy as np

# How byte-level BPE cuts a text before merging (fixed value).
_PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_NATIVE = sys.byteorder == "little" and array("I").itemsize == 4


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _ranks(kind: dict) -> dict[bytes, int] | None:
    """Vocabulary as byte strings, if ids follow the order of the merges; else None."""
    model, cut = kind["model"], kind.get("pre_tokenizer") or {}
    if (
        kind.get("normalizer") is not None
        or cut.get("type") != "ByteLevel"
        or cut.get("add_prefix_space")
        or not cut.get("use_regex", True)
        or model.get("type") != "BPE"
        or model.get("continuing_subword_prefix")
        or model.get("end_of_word_suffix")
        or model.get("dropout")
        or model.get("ignore_merges")
    ):
        return None
    vocab, byte_of = model["vocab"], _byte_of()
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    if any(vocab.get(m) != 256 + i for i, m in enumerate(merges)):
        return None
    kept = [*byte_of, *merges]
    if any(c not in vocab for c in byte_of):
        return None
    return {bytes(byte_of[c] for c in token): vocab[token] for token in kept}


class Encoder:
    """Encodes whole texts.

    For byte-level BPE the pieces are merged by tiktoken, which takes the same vocabulary
    and order of merges and gives the same ids several times as fast. The tokenizer itself
    encodes texts that hold the string of a special token, and all texts if its file
    describes another kind.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = _ranks(json.loads(self.tokenizer.to_str()))
        self.merge = None
        if ranks is not None:
            import tiktoken

            parts = tiktoken.Encoding(
                "parts", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={}
            )
            self.merge = parts.encode_ordinary

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as unsigned 32-bit integers; a null text has none."""
        text = text or ""
        if self.merge is None or any(s in text for s in self.special):
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return _packed(self.merge(text))


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if _NATIVE else np.array(ids, "<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file, loaded once."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
