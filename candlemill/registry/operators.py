"""Single operators over the stand-in ticks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.functions.periods import (
    DAY,
    MONTH,
    month_of_text,
    year_month_text,
    year_of_text,
)
from candlemill.operators import bars as B
from candlemill.operators import pivots as P
from candlemill.operators import rates as R
from candlemill.operators import summaries as S
from candlemill.operators import year_columns as Y
from candlemill.operators.prev_close import with_prev_close
from candlemill.plans.reports import growth_report
from candlemill.plans.sql_report import growth_rates_sql
from candlemill.registry.base import Query, rounded
from candlemill.registry.reports import lineitem_bars, month_sql, order_days
from candlemill.registry.tables import (
    LINEITEM_MONTH_BARS,
    LINEITEM_ORDER,
    LINEITEM_TICKS_SQL,
    LINEITEM_TIE,
    ORDERS_DAY_BARS,
    ORDERS_TICKS_SQL,
    ORDERS_TIE,
    PREV_DAY,
    PREV_MONTH,
    lineitem_ticks,
    order_ticks,
    rates_sql,
)

_N = range(1, 13)
M = list(MONTH)
RATES = {mode: "WITH " + rates_sql(LINEITEM_MONTH_BARS, mode) for mode in ("oc", "cc")}
DAY_RATES = "WITH " + rates_sql(ORDERS_DAY_BARS, "oc", PREV_DAY, "day")


def _rates(spark: SparkSession, sf_dir: str, mode: str = "oc") -> DataFrame:
    return R.with_rate(lineitem_bars(spark, sf_dir), mode).select(*M, "growth_rate")


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pivot_months_if(_rates(spark, sf_dir))


def _day_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.weekday_means(R.with_rate(order_days(spark, sf_dir), "oc", DAY))


def _named(wide: DataFrame, *extra: str) -> DataFrame:
    """Month cells under names that need no quotes."""
    return wide.selectExpr("year", *[f"`{m}` AS m{m}" for m in _N], *extra)


# --- bars -----------------------------------------------------------------------

OPEN_CLOSE_SQL = f"WITH {LINEITEM_MONTH_BARS} SELECT year, month, round(open, 4) AS open, round(close, 4) AS close FROM bars"


def open_close_month(spark, sf_dir):
    found = B.bars(lineitem_ticks(spark, sf_dir), MONTH, tie=LINEITEM_ORDER)
    return rounded(found.select(*M, "open", "close"))


def open_close_month_window(spark, sf_dir):
    return rounded(B.month_bars_by_window(lineitem_ticks(spark, sf_dir), tie=LINEITEM_TIE))


def open_close_month_sql(spark, sf_dir):
    return rounded(B.month_bars_by_sql(lineitem_ticks(spark, sf_dir), tie=LINEITEM_TIE))


def minmax_month(spark, sf_dir):
    return B.period_bounds(lineitem_ticks(spark, sf_dir), MONTH)


def minmax_day(spark, sf_dir):
    return B.period_bounds(order_ticks(spark, sf_dir), DAY)


def last_tick_rownum(spark, sf_dir):
    ticks = lineitem_ticks(spark, sf_dir)
    return rounded(B.last_ticks(ticks, MONTH, LINEITEM_ORDER).select(*M, "time", "close", *LINEITEM_TIE))


LAST_TICK_SQL = f"""WITH ticks AS ({LINEITEM_TICKS_SQL}), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY year, month ORDER BY time DESC, l_orderkey DESC,
        l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS n FROM ticks)
SELECT year, month, time, round(close, 4) AS close, l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM ranked WHERE n = 1"""


def semi_first_last(spark, sf_dir):
    edges = B.edge_ticks(order_ticks(spark, sf_dir), MONTH, ORDERS_TIE)
    return rounded(edges.select("edge", *M, "time", "o_orderkey", "open", "close"))


SEMI_SQL = f"""WITH ticks AS ({ORDERS_TICKS_SQL}),
firsts AS (SELECT * FROM ticks WHERE time IN (SELECT min(time) FROM ticks GROUP BY year, month)),
lasts AS (SELECT * FROM ticks WHERE time IN (SELECT max(time) FROM ticks GROUP BY year, month)),
edges AS (
    SELECT 'first' AS edge, *, row_number() OVER (PARTITION BY year, month ORDER BY o_orderkey) AS n FROM firsts
    UNION ALL
    SELECT 'last' AS edge, *, row_number() OVER (PARTITION BY year, month ORDER BY o_orderkey DESC) AS n FROM lasts)
SELECT edge, year, month, time, o_orderkey, round(open, 4) AS open, round(close, 4) AS close FROM edges WHERE n = 1"""


def join_first_last(spark, sf_dir):
    return rounded(B.bars_by_join(order_ticks(spark, sf_dir), DAY, ORDERS_TIE))


JOIN_SQL = f"""WITH {ORDERS_DAY_BARS}
SELECT day, round(open, 4) AS open, round(close, 4) AS close, open_time, close_time FROM bars"""


# --- previous close and rates -----------------------------------------------------


def prev_close_month(spark, sf_dir):
    bars = with_prev_close(lineitem_bars(spark, sf_dir))
    return rounded(bars.select(*M, "open", "close", "prev_close"))


def prev_close_day(spark, sf_dir):
    bars = with_prev_close(order_days(spark, sf_dir), DAY)
    return rounded(bars.select("day", "open", "close", "prev_close"))


PREV_MONTH_SQL = f"""WITH {LINEITEM_MONTH_BARS}, {PREV_MONTH}
SELECT year, month, round(open, 4) AS open, round(close, 4) AS close, round(prev_close, 4) AS prev_close FROM prevs"""
PREV_DAY_SQL = f"""WITH {ORDERS_DAY_BARS}, {PREV_DAY}
SELECT day, round(open, 4) AS open, round(close, 4) AS close, round(prev_close, 4) AS prev_close FROM prevs"""


def growth_oc(spark, sf_dir):
    return rounded(_rates(spark, sf_dir, "oc"))


def growth_cc(spark, sf_dir):
    return rounded(_rates(spark, sf_dir, "cc"))


def growth_sql_param(spark, sf_dir):
    return rounded(growth_rates_sql(lineitem_bars(spark, sf_dir), "cc"))


RATE_TAIL = " SELECT year, month, round(rate, 4) AS growth_rate FROM rates"
PARAM_TAIL = " SELECT year, month, round(rate, 2) AS growth_rate FROM rates"


# --- aggregates beside the rates ----------------------------------------------------


def year_total(spark, sf_dir):
    return rounded(R.year_totals(_rates(spark, sf_dir)))


def total_join_back(spark, sf_dir):
    return rounded(R.with_year_total(_rates(spark, sf_dir)))


def year_mean(spark, sf_dir):
    return rounded(R.year_means(_rates(spark, sf_dir)))


def month_mean(spark, sf_dir):
    return rounded(R.month_means(_rates(spark, sf_dir)))


def weekday_avg(spark, sf_dir):
    return rounded(_day_means(spark, sf_dir))


def weekday_total(spark, sf_dir):
    return rounded(R.weekday_totals(_day_means(spark, sf_dir)))


WEEKDAY_MEANS = DAY_RATES + """, means AS (
    SELECT CAST(month(day) AS INTEGER) AS month, CAST(isodow(day) - 1 AS INTEGER) AS weekday, avg(rate) AS mean
    FROM rates GROUP BY 1, 2)"""


# --- pivots ---------------------------------------------------------------------------


def pivot_month_if(spark, sf_dir):
    return rounded(_named(_wide(spark, sf_dir)))


def pivot_month_df(spark, sf_dir):
    return rounded(_named(P.pivot_months(_rates(spark, sf_dir))))


def pivot_month_sql(spark, sf_dir):
    return rounded(_named(P.pivot_months_sql(_rates(spark, sf_dir))))


def pivot_month_zero(spark, sf_dir):
    return rounded(_named(P.zero_filled(_wide(spark, sf_dir))))


def pivot_weekday(spark, sf_dir):
    wide = P.pivot_weekdays(_day_means(spark, sf_dir))
    return rounded(wide.selectExpr("month", *[f"`{d}` AS d{d}" for d in P.SHOWN_WEEKDAYS]))


def _pivot_sql(cell: str = "{x}") -> str:
    cells = ", ".join(
        cell.format(x=f"round(sum(CASE WHEN month = {m} THEN rate END), 4)") + f" AS m{m}" for m in _N
    )
    return f"{RATES['oc']} SELECT year, {cells} FROM rates GROUP BY year"


# --- year columns and summary rows ------------------------------------------------------


def year_sum12(spark, sf_dir):
    return rounded(Y.sum_of_twelve(_wide(spark, sf_dir)).select("year", "total"))


def year_mean12(spark, sf_dir):
    return rounded(Y.mean_of_twelve(_wide(spark, sf_dir)).select("year", "AVG"))


def year_sum_zero(spark, sf_dir):
    return rounded(Y.sum_with_zeros(_wide(spark, sf_dir)).select("year", "TOTAL"))


def rollup_avg(spark, sf_dir):
    table = S.rollup_means(_wide(spark, sf_dir), P.MONTH_CELLS)
    return rounded(_named(table.withColumn("year", F.expr(S.label("AVG")))))


def avg_row_union(spark, sf_dir):
    return rounded(_named(S.union_mean_row(_wide(spark, sf_dir), P.MONTH_CELLS, "AVG")))


def avg_row_zero(spark, sf_dir):
    wide = P.zero_filled(_wide(spark, sf_dir))
    summary = S.rollup_means(wide, P.MONTH_CELLS).filter("summary = 1")
    return rounded(_named(summary.withColumn("year", F.expr(S.label("AVG")))))


def avg_row_mean_of_means(spark, sf_dir):
    return rounded(_named(S.mean_of_month_means(_rates(spark, sf_dir)), "AVG AS corner"))


_WIDE_CTE = ", ".join(f"sum(CASE WHEN month = {m} THEN rate END) AS m{m}" for m in _N)
WIDE_SQL = f"{RATES['oc']}, wide AS (SELECT year, {_WIDE_CTE} FROM rates GROUP BY year)"
_SUM12 = " + ".join(f"m{m}" for m in _N)
_SUM12_ZERO = " + ".join(f"coalesce(m{m}, 0)" for m in _N)
_CELLS = ", ".join(f"round(m{m}, 4) AS m{m}" for m in _N)
_MEANS = ", ".join(f"round(avg(m{m}), 4) AS m{m}" for m in _N)
_ZERO_MEANS = ", ".join(f"round(avg(coalesce(m{m}, 0)), 4) AS m{m}" for m in _N)
_MONTH_MEANS = ", ".join(f"round(max(CASE WHEN month = {m} THEN mean END), 4) AS m{m}" for m in _N)
MEAN_ROWS = f"""{WIDE_SQL} SELECT CAST(year AS VARCHAR) AS year, {_CELLS} FROM wide
UNION ALL SELECT 'AVG' AS year, {_MEANS} FROM wide"""


def report_limit(spark, sf_dir):
    report = growth_report(lineitem_bars(spark, sf_dir), "mysql", "oc")
    return rounded(report.orderBy("year").limit(3))


# --- keys --------------------------------------------------------------------------------


def key_roundtrip(spark, sf_dir):
    bars = lineitem_bars(spark, sf_dir)
    text = bars.select(year_month_text(F.col("year"), F.col("month")).alias("year_month"))
    return text.select(
        "year_month",
        year_of_text(F.col("year_month")).alias("year"),
        month_of_text(F.col("year_month")).alias("month"),
    )


KEY_SQL = """SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS year_month,
    CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month FROM lineitem"""


def operator_queries() -> list[Query]:
    oc, cc = RATES["oc"], RATES["cc"]
    rows: list[tuple[Callable, str]] = [
        (open_close_month, OPEN_CLOSE_SQL),
        (open_close_month_window, OPEN_CLOSE_SQL),
        (open_close_month_sql, OPEN_CLOSE_SQL),
        (minmax_month, f"""WITH ticks AS ({LINEITEM_TICKS_SQL})
SELECT year, month, min(time) AS first_time, max(time) AS last_time FROM ticks GROUP BY year, month"""),
        (minmax_day, f"""WITH ticks AS ({ORDERS_TICKS_SQL})
SELECT day, min(time) AS first_time, max(time) AS last_time FROM ticks GROUP BY day"""),
        (last_tick_rownum, LAST_TICK_SQL),
        (semi_first_last, SEMI_SQL),
        (join_first_last, JOIN_SQL),
        (prev_close_month, PREV_MONTH_SQL),
        (prev_close_day, PREV_DAY_SQL),
        (growth_oc, oc + RATE_TAIL),
        (growth_cc, cc + RATE_TAIL),
        (growth_sql_param, cc + PARAM_TAIL),
        (year_total, oc + " SELECT year, round(sum(rate), 4) AS total FROM rates GROUP BY year"),
        (total_join_back, oc + """, totals AS (SELECT year, sum(rate) AS total FROM rates GROUP BY year)
SELECT year, month, round(rate, 4) AS growth_rate, round(total, 4) AS total FROM rates JOIN totals USING (year)"""),
        (year_mean, oc + ' SELECT year, round(avg(rate), 4) AS "AVG" FROM rates GROUP BY year'),
        (month_mean, oc + " SELECT month, round(avg(rate), 4) AS growth_rate FROM rates GROUP BY month"),
        (weekday_avg, WEEKDAY_MEANS + " SELECT month, weekday, round(mean, 4) AS growth_rate FROM means"),
        (weekday_total, WEEKDAY_MEANS + " SELECT month, round(avg(mean), 4) AS total FROM means GROUP BY month"),
        (pivot_month_if, _pivot_sql()),
        (pivot_month_df, _pivot_sql()),
        (pivot_month_sql, _pivot_sql()),
        (pivot_month_zero, _pivot_sql("coalesce({x}, 0.0)")),
        (pivot_weekday, WEEKDAY_MEANS + " SELECT month, " + ", ".join(
            f"round(max(CASE WHEN weekday = {d} THEN mean END), 4) AS d{d}" for d in P.SHOWN_WEEKDAYS
        ) + " FROM means GROUP BY month"),
        (year_sum12, f"{WIDE_SQL} SELECT year, round({_SUM12}, 4) AS total FROM wide"),
        (year_mean12, f'{WIDE_SQL} SELECT year, round(({_SUM12}) / 12, 4) AS "AVG" FROM wide'),
        (year_sum_zero, f'{WIDE_SQL} SELECT year, round({_SUM12_ZERO}, 3) AS "TOTAL" FROM wide'),
        (rollup_avg, MEAN_ROWS),
        (avg_row_union, MEAN_ROWS),
        (avg_row_zero, f"{WIDE_SQL} SELECT 'AVG' AS year, {_ZERO_MEANS} FROM wide"),
        (avg_row_mean_of_means, f"""{oc}, means AS (SELECT month, avg(rate) AS mean FROM rates GROUP BY month)
SELECT 'AVG' AS year, {_MONTH_MEANS}, round(avg(mean), 4) AS corner FROM means"""),
        (report_limit, f"SELECT * FROM ({month_sql('mysql', 'oc')}) AS report ORDER BY year LIMIT 3"),
        (key_roundtrip, KEY_SQL),
    ]
    return [Query(run.__name__, run, sql) for run, sql in rows]
