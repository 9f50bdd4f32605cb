"""Merging new bars into stored ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.functions.periods import MONTH
from candlemill.operators.prev_close import with_prev_close

BAR_VALUES = ["open", "close", "open_time", "close_time"]


def combine_bars(
    bars: DataFrame, period: Sequence[str] = MONTH, keys: Sequence[str] = ()
) -> DataFrame:
    """Several bars of a period become one: earliest open, latest close.

    ``arrival`` settles equal times, the lower one first.
    """
    if "arrival" not in bars.columns:
        bars = bars.withColumn("arrival", F.lit(0))
    first = F.when(F.col("open").isNotNull(), F.struct("open_time", "arrival", "open"))
    last = F.struct("close_time", (-F.col("arrival")).alias("seniority"), "close")
    last = F.when(F.col("close").isNotNull(), last)
    return bars.groupBy(*keys, *period).agg(
        F.min_by("open", first).alias("open"),
        F.max_by("close", last).alias("close"),
        F.min("open_time").alias("open_time"),
        F.max("close_time").alias("close_time"),
    )


def merge_bars(
    old: DataFrame, new: DataFrame, period: Sequence[str] = MONTH, keys: Sequence[str] = ()
) -> DataFrame:
    """The earlier open and the later close win, whatever order the files came in.

    Merging the same bars again changes nothing, and the order of merges does not
    matter. At equal times the stored value stays; ``new`` may hold several bars of
    one period.
    """
    columns = [*keys, *period, *BAR_VALUES]
    both = old.select(*columns, F.lit(0).alias("arrival")).unionByName(
        new.select(*columns, F.lit(1).alias("arrival"))
    )
    return combine_bars(both, period, keys)


def replace_rows(old: DataFrame, new: DataFrame, on: Sequence[str] = MONTH) -> DataFrame:
    """The newer row wins as a whole, even where it covers only part of the period."""
    return old.join(new, list(on), "left_anti").unionByName(new.select(*old.columns))


def upsert_with_prev_close(
    old: DataFrame,
    new: DataFrame,
    period: Sequence[str] = MONTH,
    keys: Sequence[str] = (),
    upsert: str = "merge",
    prev_close: str = "merged",
) -> DataFrame:
    """New bars put into the stored ones, ``prev_close`` included.

    ``upsert`` is merge (edge times decide) or replace (the newer row wins).
    ``prev_close='merged'`` takes it over the merged bars; ``'batch'`` takes it
    inside the new bars alone, so the first of them starts from its own open, and
    goes with replace.
    """
    if upsert not in ("merge", "replace") or prev_close not in ("merged", "batch"):
        raise ValueError(f"unknown upsert {upsert!r} or prev_close {prev_close!r}")
    if prev_close == "batch" and upsert != "replace":
        raise ValueError("prev_close='batch' needs upsert='replace'")
    if upsert == "merge":
        return with_prev_close(merge_bars(old, new, period, keys), period, keys)
    on = [*keys, *period]
    new = combine_bars(new, period, keys)
    if prev_close == "batch":
        return replace_rows(old, with_prev_close(new, period, keys), on)
    stored = replace_rows(old.select(*on, *BAR_VALUES), new, on)
    return with_prev_close(stored, period, keys)
