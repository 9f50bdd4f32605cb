"""Month and weekday reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.functions.periods import DAY, MONTH, month_title
from candlemill.functions.rates import present_mean, present_sum, strict_sum
from candlemill.operators.pivots import (
    MONTH_CELLS,
    SHOWN_WEEKDAYS,
    WEEKDAY_CELLS,
    pivot_months_if,
    pivot_weekdays,
    quoted,
)
from candlemill.operators.rates import weekday_means, with_rate
from candlemill.operators.summaries import label, rollup_means
from candlemill.plans.flavours import FLAVOURS, Flavour
from candlemill.schemas import WEEKDAYS

YEAR_RULES = {
    "present_sum": present_sum,
    "strict_sum": strict_sum,
    "present_mean": present_mean,
}


def _flavour(name: str) -> Flavour:
    if name not in FLAVOURS:
        raise ValueError(f"unknown flavour {name!r}, expected one of {sorted(FLAVOURS)}")
    return FLAVOURS[name]


def _priced(bars: DataFrame, price: Sequence[str]) -> DataFrame:
    columns = [c for c in ("open", "close", "prev_close") if c in bars.columns]
    for kind in price:
        bars = bars.withColumns({c: F.col(c).cast(kind) for c in columns})
    return bars


def _finished(cell: str, flavour: Flavour) -> str:
    if flavour.cell_digits is not None:
        cell = f"round({cell}, {flavour.cell_digits})"
    cell = f"double({cell})"
    return f"coalesce({cell}, 0D)" if flavour.zero_last else cell


def growth_table(
    bars: DataFrame, flavour: str = "mysql", mode: str = "oc", keys: Sequence[str] = ()
) -> DataFrame:
    """Unsorted year by month table with ``summary`` marking the last row."""
    spec = _flavour(flavour)
    rates = with_rate(_priced(bars, spec.price), mode, MONTH, keys)
    rate = "growth_rate"
    if spec.rate_digits is not None:
        rate = f"round(growth_rate, {spec.rate_digits})"
    rates = rates.withColumn("growth_rate", F.expr(f"CAST({rate} AS {spec.number})"))

    months = quoted(MONTH_CELLS)
    cells = [f"CAST({m} AS {spec.number})" for m in months]
    if spec.zero_first:
        cells = [f"coalesce({c}, CAST(0 AS {spec.number}))" for c in cells]
    wide = pivot_months_if(rates, keys).selectExpr(
        *keys,
        "year",
        *[f"{c} AS {m}" for c, m in zip(cells, months)],
        f"{YEAR_RULES[spec.year_rule](cells)} AS year_cell",
    )

    # The division comes after the mean, where it is exact enough for rounding.
    table = rollup_means(wide, [*MONTH_CELLS, "year_cell"], keys)
    corner = f"year_cell / {spec.year_divisor}"
    if spec.corner_from_row:
        corner = f"if(summary = 1, {present_mean(months)}, year_cell)"

    return table.selectExpr(
        *keys,
        f"{label(spec.summary_text)} AS year",
        *[f"{_finished(m, spec)} AS {name}" for m, name in zip(months, spec.months)],
        f"{_finished(corner, spec)} AS {spec.year_column}",
        "summary",
    )


def growth_report(
    bars: DataFrame, flavour: str = "mysql", mode: str = "oc", keys: Sequence[str] = ()
) -> DataFrame:
    """Year by month growth table, years in order and the summary row last.

    ``bars`` are month bars. Ticks have been left behind at this point: every step
    works on at most twelve rows per key and year.
    """
    table = growth_table(bars, flavour, mode, keys)
    return table.orderBy(*keys, "summary", "year").drop("summary")


def week_report(days: DataFrame, mode: str = "oc", keys: Sequence[str] = ()) -> DataFrame:
    """Month name by weekday mean of daily growth, over all years.

    ``total`` is the mean of the weekday means and counts Saturday, which has no
    column of its own.
    """
    wide = pivot_weekdays(weekday_means(with_rate(days, mode, DAY, keys), keys), keys)
    shown = [f"`{d}` AS {WEEKDAYS[d]}" for d in SHOWN_WEEKDAYS]
    total = present_mean(quoted(WEEKDAY_CELLS))
    return (
        wide.orderBy(*keys, "month")
        .withColumn("month", month_title(F.col("month")))
        .selectExpr(*keys, "month", *shown, f"{total} AS total")
    )
