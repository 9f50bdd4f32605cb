"""Packing token ids into windows: bounded space, best fit.

Each task keeps a fixed number of open windows. What is left of a document after its full
windows goes into the open window that it fills best. When none has room, the fullest is
topped up with the head of the document and emitted, and the rest is placed in turn. The
windows left open at the end of each task are merged, task by task in groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.llm.common import saved
from candlemill.llm.tokens import encoder

WINDOW = 2048
END_ID = 1
OPEN_WINDOWS = 16
# Tasks whose open windows are merged at once: at most 64 x 16 windows, 8 MB of ids.
MERGED_TASKS = 64
_BATCH_TEXTS = 512
_ENTRY = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_SCHEMA = f"{_ENTRY}, grp long, win long, offset long, full boolean, ids binary"
_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "grp", "win", "offset")]
    + [("full", pa.bool_()), ("ids", pa.binary())]
)


class Packer:
    """Open windows of one task; ``rows`` collects the pieces of emitted windows."""

    def __init__(self, window: int, most_open: int, group: int, with_ids: bool):
        self.window, self.most_open, self.group, self.with_ids = window, most_open, group, with_ids
        self.open: list[tuple[int, list]] = []
        self.emitted = 0
        self.rows: list[tuple] = []

    def _emit(self, pieces: list, full: bool = True) -> None:
        offset = 0
        for doc_id, start, total, ids in pieces:
            length = len(ids) // 4
            kept = ids if self.with_ids or not full else None
            crc = zlib.crc32(ids)
            self.rows.append(
                (doc_id, start, length, crc, total, self.group, self.emitted, offset, full, kept)
            )
            offset += length
        self.emitted += 1

    def add(self, doc_id: int | None, ids: bytes, start: int = 0, total: int | None = None) -> None:
        total = len(ids) // 4 if total is None else total
        at, end, step = 0, len(ids), 4 * self.window
        while end - at >= step:
            self._emit([(doc_id, start + at // 4, total, ids[at : at + step])])
            at += step
        while at < end:
            need = (end - at) // 4
            room = [(self.window - used, i) for i, (used, _) in enumerate(self.open)]
            fits = [r for r in room if r[0] >= need]
            if fits:
                take, i = need, min(fits)[1]
            elif len(self.open) < self.most_open:
                self.open.append((0, []))
                take, i = need, len(self.open) - 1
            else:
                take, i = min(room)
            used, pieces = self.open[i]
            pieces.append((doc_id, start + at // 4, total, ids[at : at + 4 * take]))
            at += 4 * take
            if used + take == self.window:
                self._emit(pieces)
                del self.open[i]
            else:
                self.open[i] = (used + take, pieces)

    def close(self) -> None:
        for _, pieces in self.open:
            self._emit(pieces, full=False)
        self.open = []


def _pack_tasks(path: str, window: int, end_id: int, most_open: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        packer = Packer(window, most_open, TaskContext.get().partitionId(), with_ids)
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH_TEXTS):
                part = batch.slice(at, _BATCH_TEXTS)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    packer.add(doc_id, encode(text) + end)
                yield _flushed(packer)
        packer.close()
        yield _flushed(packer)

    return run


def _flushed(packer: Packer) -> pa.RecordBatch:
    columns = list(zip(*packer.rows)) or [[] for _ in _ARROW]
    packer.rows = []
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _merge_groups(window: int, with_ids: bool):
    """The open windows of a group of tasks laid end to end: at most one stays open."""

    def run(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        packer = Packer(window, 1, int(key[0]), with_ids)
        pieces = pieces.sort_values(["grp", "win", "offset"])
        for p in pieces.itertuples():
            doc_id = None if pd.isna(p.doc_id) else int(p.doc_id)
            packer.add(doc_id, bytes(p.ids), int(p.start), int(p.doc_tokens))
        packer.close()
        out = pd.DataFrame(packer.rows, columns=_ARROW.names)
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    open_windows: int = OPEN_WINDOWS,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of every row of ``docs`` (doc_id, text, ...) packed into windows.

    A document is its token ids followed by ``end_id``; a null or empty text is ``end_id``
    alone. Pieces come as (doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset), with ``ids`` (little-endian unsigned 32-bit) if asked for. Each id lies in one
    piece, offsets in a sequence run from 0 without gaps, and all sequences but one are
    full. Repeated rows are packed as often as they come, and null ids stay null. No rows
    give no pieces. Further columns are not looked at.
    """
    run = _pack_tasks(tokenizer_path, window, end_id, open_windows, with_ids)
    packed = saved(docs.select("doc_id", "text").mapInArrow(run, _SCHEMA), "packed")
    levels = []
    while True:
        groups = packed.where("NOT full").agg(F.max("grp"), F.count_distinct("grp", "win")).first()
        if groups[1] <= 1:
            levels.append(packed)
            break
        levels.append(packed.where("full"))
        key = F.floor(F.col("grp") / MERGED_TASKS).cast("long").alias("key")
        merged = packed.where("NOT full").groupBy(key).applyInPandas(
            _merge_groups(window, with_ids), _SCHEMA
        )
        packed = saved(merged, "merged")
    # Levels, groups and windows within them number the sequences: 4 + 24 + 35 bits.
    out = None
    for level, rows in enumerate(levels):
        number = F.lit(level << 59) + F.shiftleft(F.col("grp"), 35) + F.col("win")
        rows = rows.withColumn("sequence_id", number)
        out = rows if out is None else out.union(rows)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return out.select(*columns, *(["ids"] if with_ids else []))
