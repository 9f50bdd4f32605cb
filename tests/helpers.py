"""Small hand-made inputs and plain-Python answers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

HEADER = "Time (UTC);Open;High;Low;Close;Volume "

TICK = T.StructType(
    [
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("key", T.LongType()),
    ]
)


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def ticks_frame(spark, rows):
    """Rows of (time text, open, close[, key])."""
    full = [(at(r[0]), float(r[1]), float(r[2]), r[3] if len(r) > 3 else 0) for r in rows]
    return spark.createDataFrame(full, TICK)


def bars_frame(spark, rows):
    """Rows of (year, month, open, close)."""
    return spark.createDataFrame(rows, "year int, month int, open double, close double")


def tick_line(time: str, open_, close=None) -> str:
    close = open_ if close is None else close
    o, c = (str(v).replace(".", ",") for v in (open_, close))
    return f"{time};{o};{o};{o};{c};0"


def write_ticks(path, lines, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")


def plain_bars(rows, period):
    """Open and close by period from (time, open, close, key) rows, the slow way."""
    groups = {}
    for time, open_, close, key in rows:
        groups.setdefault(period(time), []).append((time, key, open_, close))
    found = {}
    for name, members in groups.items():
        first = min(members, key=lambda m: (m[0], m[1], m[2]))
        last = max(members, key=lambda m: (m[0], m[1], m[3]))
        found[name] = (first[2], last[3], first[0], last[0])
    return found
