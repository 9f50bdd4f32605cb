"""The place of a tick in time as one number of fixed width.

A struct as the order of ``min_by`` makes Spark sort every tick, because its buffer has no
fixed width. A decimal of 38 digits has one: time and tie columns side by side in it keep
the aggregation a hash aggregation, over one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlemill.functions.periods import DAY, MONTH

WIDTH = 38
# Digits that a long holds whatever they are.
_LONG = 18
# Microseconds of a day, and days of a month before them.
_DAY_DIGITS, _MONTH_DIGITS = 11, 2
# Bits of a price's hash beside the 42 of a time within a month.
_HASH_BITS = 21
_HASH_MASK = (1 << _HASH_BITS) - 1


def _fitting(value: Column, digits: int, what: str) -> Column:
    """``value``, but fail the job where it is missing, below 0 or longer than ``digits``."""
    text = F.concat(F.lit(f"{what} does not fit {digits} digits: "), F.coalesce(value.cast("string"), F.lit("none")))
    fits = (value >= 0) & (value < F.lit(10**digits)) if digits <= _LONG else value >= 0
    return F.when(fits, value).otherwise(F.raise_error(text).cast("long"))


def _time_parts(time: Column, period: Sequence[str]) -> list[tuple[Column, int]]:
    """A time within its period: day of the month where there is one, and microseconds."""
    minutes = (F.hour(time) * 60 + F.minute(time)).cast("long")
    seconds = (F.date_part(F.lit("SECOND"), time) * 1_000_000).cast("long")
    parts = [(minutes * 60_000_000 + seconds, _DAY_DIGITS)]
    if tuple(period) == MONTH:
        return [(F.dayofmonth(time).cast("long"), _MONTH_DIGITS), *parts]
    if tuple(period) != DAY:
        raise ValueError(f"no order within {period!r}")
    return parts


def _power(digits: int) -> Column:
    return F.expr(f"CAST('1{'0' * digits}' AS decimal({digits + 1},0))")


def _joined(parts: list[tuple[Column, int]]) -> Column:
    """Whole numbers side by side: as longs while they fit one, then as decimals."""
    if sum(digits for _, digits in parts) > WIDTH:
        raise ValueError(f"an order of {sum(d for _, d in parts)} digits, more than {WIDTH}")
    longs: list[tuple[Column, int]] = []
    for value, digits in parts:
        if longs and longs[-1][1] + digits <= _LONG:
            before, width = longs.pop()
            value, digits = before * F.lit(10**digits).cast("long") + value, width + digits
        longs.append((value, digits))
    key = longs[0][0].cast(f"decimal({WIDTH},0)")
    for value, digits in longs[1:]:
        key = (key * _power(digits) + value).cast(f"decimal({WIDTH},0)")
    return key


def order_key(time: str, period: Sequence[str], tie: Mapping[str, int]) -> Column:
    """Order of ticks of one period by time, then by the columns of ``tie``.

    ``tie`` maps a column of whole numbers to its number of digits. A value that does not
    fit, is missing or is below 0 fails the job; more than 38 digits in all are refused at
    once. Without a time there is no order.
    """
    ties = [(_fitting(F.col(c).cast("long"), digits, c), digits) for c, digits in tie.items()]
    key = _joined([*_time_parts(F.col(time), period), *ties])
    return F.when(F.col(time).isNotNull(), key)


def tie_of_key(key: Column, period: Sequence[str], tie: Mapping[str, int]) -> dict[str, Column]:
    """The columns of ``tie`` read back from an order."""
    at = sum(digits for _, digits in _time_parts(F.lit(None), period))
    text = F.lpad(key.cast("string"), at + sum(tie.values()), "0")
    found = {}
    for name, digits in tie.items():
        found[name] = F.substring(text, at + 1, digits).cast("long")
        at += digits
    return found


def _edge_marks(time: str, price: str, first: bool) -> list[Column]:
    """Extremes of (time, hash of the price), and of (time, the hash turned round), twice.

    Whole numbers of 63 bits: microseconds within the month above 21 bits of hash.
    """
    moment = F.unix_micros(F.col(time).cast("timestamp"))
    month = F.unix_micros(F.date_trunc("month", F.col(time).cast("timestamp")))
    there = F.when(F.col(price).isNotNull(), F.shiftleft(moment - month, _HASH_BITS))
    extreme = F.min if first else F.max
    marks = []
    for seed in (1, 2):
        hashed = F.hash(F.lit(seed), F.col(price)).bitwiseAND(F.lit(_HASH_MASK)).cast("long")
        marks += [extreme(there + hashed), extreme(there + (F.lit(_HASH_MASK) - hashed))]
    return marks


def edge_marks(time: str = "time", open: str = "open", close: str = "close") -> list[Column]:
    """Aggregates from which :func:`several_prices` tells whether an edge has several prices."""
    marks = [*_edge_marks(time, open, True), *_edge_marks(time, close, False)]
    return [m.alias(f"_mark{i}") for i, m in enumerate(marks)]


def several_prices() -> Column:
    """Whether the first time comes with different opens, or the last with different closes.

    The lowest and the highest hash at the time are then not the same; that two different
    prices agree in both hashes is a matter of 1 in 4 * 10 ** 12. Clocks set back in the
    session's zone may report an edge that has none.
    """
    same = F.lit(True)
    for i in range(0, 8, 2):
        low, high = (F.col(f"_mark{k}").bitwiseAND(F.lit(_HASH_MASK)) for k in (i, i + 1))
        same = same & F.coalesce(low + high == F.lit(_HASH_MASK), F.lit(True))
    return ~same


MARKS = [f"_mark{i}" for i in range(8)]
