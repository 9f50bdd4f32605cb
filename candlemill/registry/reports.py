"""The composed reports."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from candlemill.functions.periods import DAY, MONTH
from candlemill.operators.bars import bars
from candlemill.plans.flavours import FLAVOURS
from candlemill.plans.reports import growth_report, week_report
from candlemill.plans.sql_report import growth_report_sql
from candlemill.registry.base import Query, rounded
from candlemill.registry.tables import (
    LINEITEM_MONTH_BARS,
    LINEITEM_TIE,
    ORDERS_DAY_BARS,
    ORDERS_TIE,
    PREV_DAY,
    lineitem_ticks,
    order_ticks,
    rates_sql,
)

MODES = ("oc", "cc")
_N = range(1, 13)


def lineitem_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(lineitem_ticks(spark, sf_dir), MONTH, tie=LINEITEM_TIE)


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars(order_ticks(spark, sf_dir), DAY, tie=ORDERS_TIE)


def run_month(flavour: str, mode: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(growth_report(lineitem_bars(spark, sf_dir), flavour, mode))


def run_month_sql(mode: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(growth_report_sql(lineitem_bars(spark, sf_dir), mode))


def run_week(mode: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(week_report(order_days(spark, sf_dir), mode))


def _wide(value: str, fill: str = "NULL") -> str:
    cells = ",\n           ".join(
        f"coalesce(sum(CASE WHEN month = {m} THEN {value} END), {fill}) AS m{m}" for m in _N
    )
    return f"wide AS (SELECT year, {cells} FROM rates GROUP BY year)"


_STRICT = " + ".join(f"m{m}" for m in _N)
_PRESENT = " + ".join(f"coalesce(m{m}, 0)" for m in _N)
_COUNT = " + ".join(f"(CASE WHEN m{m} IS NULL THEN 0 ELSE 1 END)" for m in _N)


def _table(year_cell: str, names: list[str], last: str, label: str, cell: str, corner: str | None = None) -> str:
    """Years and the row of means below them. ``cell`` finishes one value ``{x}``."""
    months = ", ".join(f"{cell.format(x=f'm{m}')} AS {name}" for m, name in zip(_N, names))
    means = ", ".join(f"avg(m{m}) AS m{m}" for m in _N)
    return f""",
body AS (SELECT CAST(year AS VARCHAR) AS year, {', '.join(f'm{m}' for m in _N)}, {year_cell} AS yc FROM wide),
foot AS (SELECT '{label}' AS year, {means}, avg(yc) AS yc FROM body),
foot2 AS (SELECT year, {', '.join(f'm{m}' for m in _N)}, {corner or 'yc'} AS yc FROM foot)
SELECT year, {months}, {cell.format(x='yc')} AS {last}
FROM (SELECT * FROM body UNION ALL SELECT * FROM foot2)"""


# A mean of rounded rates can end in an exact half. Eight decimals first, then the
# rounding, so that the binary form of the mean does not decide.
_HALF_UP = "CAST(round(CAST({{x}} AS DECIMAL(30,8)), {digits}) AS DOUBLE)"


# Prices in three decimals, by way of eight so that an exact half rounds up.
_STAGED = "CAST(CAST(CAST({x} AS DECIMAL(18,8)) AS DECIMAL(10,3)) AS DOUBLE)"


def month_sql(flavour: str, mode: str) -> str:
    spec = FLAVOURS[flavour]
    price = _STAGED if flavour == "zero" else "{x}"
    rates = "WITH " + rates_sql(LINEITEM_MONTH_BARS, mode, price=price) + ",\n"
    names = list(spec.months)
    if flavour == "mysql":
        return rates + _wide("rate") + _table(_PRESENT, names, "total", "AVG", "round({x}, 4)")
    if flavour == "hive":
        return rates + _wide("rate") + _table(_STRICT, names, "total", "Total", "round({x}, 4)")
    if flavour == "rollup":
        cents = _wide("CAST(round(rate, 2) AS DECIMAL(18,2))")
        return rates + cents + _table(f"({_STRICT}) / 12.0", names, "AVG", "AVG", _HALF_UP.format(digits=2))
    if flavour == "dense":
        return rates + _wide("rate") + _table(
            f"({_PRESENT}) / ({_COUNT})", names, "AVG", "AVG", "coalesce(round({x}, 2), 0.0)",
            corner=f"({_PRESENT}) / ({_COUNT})",
        )
    mills = _wide("CAST(round(rate, 3) AS DECIMAL(18,3))", fill="0")
    return rates + mills + _table(_STRICT, names, "TOTAL", "AVG", _HALF_UP.format(digits=3))


# Number and heading of the weekdays shown.
_WEEKDAYS = [(0, "Monday"), (1, "Tuesday"), (2, "Wednesday"), (3, "Thursday"), (4, "Friday"), (6, "Sunday")]


def week_sql(mode: str) -> str:
    cells = ", ".join(
        f"round(max(CASE WHEN weekday = {n} THEN mean END), 4) AS {name}" for n, name in _WEEKDAYS
    )
    return f"""WITH {rates_sql(ORDERS_DAY_BARS, mode, PREV_DAY, 'day')},
means AS (
    SELECT month(day) AS month, isodow(day) - 1 AS weekday, avg(rate) AS mean FROM rates GROUP BY 1, 2
)
SELECT monthname(make_date(2000, CAST(month AS INTEGER), 1)) AS month, {cells}, round(avg(mean), 4) AS total
FROM means GROUP BY means.month"""


def report_queries() -> list[Query]:
    prefixes = {
        "mysql": "month_growth",
        "hive": "hive_month_growth",
        "rollup": "month_growth_rollup",
        "dense": "month_growth_dense",
        "zero": "month_growth_zero",
    }
    found = []
    for mode in MODES:
        for flavour, prefix in prefixes.items():
            found.append(
                Query(f"{prefix}_{mode}", partial(run_month, flavour, mode), month_sql(flavour, mode))
            )
        found.append(
            Query(f"month_growth_sql_{mode}", partial(run_month_sql, mode), month_sql("rollup", mode))
        )
        found.append(Query(f"week_growth_{mode}", partial(run_week, mode), week_sql(mode)))
    return found
