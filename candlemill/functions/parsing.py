"""Text to typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def decimal_comma(text: Column, to: str | DataType = "double") -> Column:
    """``'1291,4'`` as a number, NULL where the text is not one."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast(to)


def comma_text(number: Column, digits: int = 2) -> Column:
    """A number as text with a decimal comma, the inverse of :func:`decimal_comma`."""
    text = number.cast(f"decimal(18,{digits})").cast("string")
    return F.replace(text, F.lit("."), F.lit(","))


def tick_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.ffffff]`` as a zone-free timestamp, NULL where malformed."""
    return text.try_cast("timestamp_ntz")


def must_parse(text: Column, value: Column, what: str, needed: bool = True) -> Column:
    """``value``, but fail the job where ``text`` did not parse or, if ``needed``, is missing."""
    failed = F.raise_error(F.concat(F.lit(f"bad {what}: "), F.coalesce(text, F.lit("none"))))
    return F.coalesce(value, failed if needed else F.when(text.isNotNull(), failed))


def market_of(path: Column) -> Column:
    """Three letters after the first ``_word_dddd`` run of a file name; NULL without one.

    ``X_10Secs_Ask_2020...`` gives ``10S`` and ``X_10 Secs_Ask_2020...`` gives ``Ask``.
    """
    run = F.regexp_extract(path, r"_\w*_\d{4}", 0)
    return F.nullif(F.substring(run, 2, 3), F.lit(""))


def instrument_of(name: Column) -> Column:
    """What stands before the first underscore of a file name; NULL without one."""
    return F.nullif(F.regexp_extract(name, "^([^_]+)_", 1), F.lit(""))


def stamp(moment) -> Column:
    """A moment without zone (datetime or ISO text) as a literal."""
    return F.lit(str(moment)).cast("timestamp_ntz")
