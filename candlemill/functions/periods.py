"""Calendar keys of a tick."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTH = ("year", "month")
DAY = ("day",)

_KEYS = {
    "year": F.year,
    "month": F.month,
    "day": F.to_date,
}


def period_columns(time: Column, period: Sequence[str]) -> dict[str, Column]:
    """Key columns of ``period`` (:data:`MONTH` or :data:`DAY`) taken from ``time``."""
    return {name: _KEYS[name](time) for name in period}


def weekday(time: Column) -> Column:
    """Monday is 0, Sunday 6."""
    return F.weekday(time)


def month_title(month: Column) -> Column:
    """``1`` becomes ``January``."""
    return F.date_format(F.make_date(F.lit(2000), month, F.lit(1)), "MMMM")


def year_month_text(year: Column, month: Column) -> Column:
    """``(2012, 1)`` becomes ``'2012-01'``."""
    return F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"))


def year_of_text(year_month: Column) -> Column:
    return F.substring(year_month, 1, 4).cast("int")


def month_of_text(year_month: Column) -> Column:
    return F.substring(year_month, 6, 2).cast("int")
