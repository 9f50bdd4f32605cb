"""Long to wide: months or weekdays become columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONTH_NUMBERS = range(1, 13)
MONTH_CELLS = [str(m) for m in MONTH_NUMBERS]
WEEKDAY_NUMBERS = range(7)
WEEKDAY_CELLS = [str(d) for d in WEEKDAY_NUMBERS]
# Weekdays that get a column; Saturday (5) has none.
SHOWN_WEEKDAYS = [0, 1, 2, 3, 4, 6]


def pivot_months_if(
    rates: DataFrame, keys: Sequence[str] = (), value: str = "growth_rate"
) -> DataFrame:
    """Conditional sums, one per month: a single shuffle by year."""
    cells = [
        F.expr(f"sum(CASE WHEN month = {m} THEN {value} END) AS `{m}`") for m in MONTH_NUMBERS
    ]
    return rates.groupBy(*keys, "year").agg(*cells)


def pivot_months(rates: DataFrame, value: str = "growth_rate") -> DataFrame:
    """The same with ``pivot`` and a fixed value list."""
    return rates.groupBy("year").pivot("month", list(MONTH_NUMBERS)).sum(value)


PIVOT_SQL = """
SELECT * FROM (SELECT year, month, growth_rate FROM {{rates}})
PIVOT (SUM(growth_rate) FOR month IN ({months}))
""".format(months=", ".join(f"{m} AS `{m}`" for m in MONTH_NUMBERS))


def pivot_months_sql(rates: DataFrame) -> DataFrame:
    """The same with the SQL PIVOT clause."""
    return rates.sparkSession.sql(PIVOT_SQL, rates=rates)


def quoted(cells: Sequence[str]) -> list[str]:
    """Column names as SQL text."""
    return [f"`{c}`" for c in cells]


def zero_filled(pivot: DataFrame) -> DataFrame:
    """Absent months become 0.0."""
    return pivot.na.fill(0.0, subset=MONTH_CELLS)


def pivot_weekdays(means: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per month number, one column per weekday number, Saturday too."""
    cells = [
        F.expr(f"sum(CASE WHEN weekday = {d} THEN growth_rate END) AS `{d}`")
        for d in WEEKDAY_NUMBERS
    ]
    return means.groupBy(*keys, "month").agg(*cells)
