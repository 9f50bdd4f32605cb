"""The reports as SQL programs: session variable, SQL functions, and scripts as procedures.

The mode is a session variable, read through a function without arguments. Rates and
reports are table functions over a view of bars. A procedure is a script: it reads the mode,
refuses an unknown one, and runs the statement for it, either with the mode as a parameter
or with the column that it stands for spliced into the text. Only a column's name from a
fixed choice is ever spliced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlemill.functions.rates import base_column, present_sum, strict_sum
from candlemill.schemas import MONTHS_LONG, MONTHS_SHORT
from candlemill.sinks.tables import setup_tables

_N = range(1, 13)
MODE = "candlemill_mode"
MODE_FUNCTION = "candlemill_calculation_mode"
BARS = "candlemill_bars"
RATES = "candlemill_rates"
MONTH_GROWTH = "candlemill_month_growth"

_WITH_PREV = f"""SELECT year, month, open, close, open_time, close_time,
    coalesce(lag(close) OVER (ORDER BY year, month), open) AS prev_close FROM {BARS}"""


def _year_table(rates: str, months: list[str], total: str, label: str, year_rule, cell: str = "{x}") -> str:
    """A query for the year by month table of (year, month, rate), summary row included."""
    sums = ", ".join(f"sum(rate) FILTER (WHERE month = {m}) AS m{m}" for m in _N)
    names = ", ".join(f"{cell.format(x=f'avg(m{m})')} AS `{name}`" for m, name in zip(_N, months))
    return f"""SELECT if(grouping(year) = 1, '{label}', CAST(year AS STRING)) AS year, {names},
    {cell.format(x='avg(year_cell)')} AS `{total}`
FROM (SELECT *, {year_rule([f'm{m}' for m in _N])} AS year_cell FROM (
    SELECT year, {sums} FROM {rates} GROUP BY year))
GROUP BY GROUPING SETS ((year), ())"""


def define(spark: SparkSession, bars: DataFrame) -> None:
    """Variable, view and functions of this session; defining them again replaces them."""
    bars.createOrReplaceTempView(BARS)
    spark.sql(f"DECLARE OR REPLACE VARIABLE {MODE} STRING DEFAULT 'oc'")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {MODE_FUNCTION}() RETURNS STRING RETURN {MODE}")
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {RATES}(mode STRING)
RETURNS TABLE (year INT, month INT, rate DOUBLE) RETURN
SELECT year, month, (try_divide(close, if({RATES}.mode = 'oc', open, prev_close)) - 1) * 100
FROM ({_WITH_PREV})"""
    )
    columns = ", ".join(f"{name} DOUBLE" for name in [*MONTHS_LONG, "total"])
    report = _year_table(f"{RATES}({MONTH_GROWTH}.mode)", MONTHS_LONG, "total", "AVG", present_sum)
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {MONTH_GROWTH}(mode STRING)
RETURNS TABLE (year STRING, {columns}) RETURN {report}"""
    )


def _checked_mode() -> str:
    return f"""SET wanted = (SELECT {MODE_FUNCTION}());
    IF wanted IS NULL OR wanted NOT IN ('oc', 'cc') THEN
        SELECT raise_error(concat('unknown mode ', coalesce(wanted, 'none')));
    END IF;"""


def call_month_growth(spark: SparkSession, mode: str | None = None) -> DataFrame:
    """The month report for the session's mode, or for ``mode``, which becomes the session's."""
    if mode is not None:
        spark.sql(f"SET VAR {MODE} = :mode", args={"mode": mode})
    return spark.sql(
        f"""BEGIN
    DECLARE wanted STRING;
    {_checked_mode()}
    EXECUTE IMMEDIATE 'SELECT * FROM {MONTH_GROWTH}(:mode)' USING wanted AS mode;
END"""
    )


def call_staging_to_report(spark: SparkSession, database: str, mode: str | None = None) -> None:
    """Bars into the staging table, and from there the report into the table of results.

    Both tables (see ``setup_tables``) are replaced. Prices are ``decimal(10,4)``, a year
    without all its months has no total, and cells are rounded to 4 digits. The column that
    the mode stands for is spliced into the second statement.
    """
    if mode is not None:
        spark.sql(f"SET VAR {MODE} = :mode", args={"mode": mode})
    price = "CAST({x} AS DECIMAL(10,4))"
    base = price.format(x="' || base || '")
    rate = f"CAST((try_divide({price.format(x='close')}, {base}) - 1) * 100 AS DECIMAL(24,9))"
    rates = f"(SELECT year, month, {rate} AS rate FROM {database}.bar_staging)"
    label = "''Total''"
    report = _year_table(rates, MONTHS_SHORT, "total", "@", strict_sum, "CAST(round({x}, 4) AS DOUBLE)")
    report = report.replace("'@'", label)
    spark.sql(
        f"""BEGIN
    DECLARE wanted STRING;
    DECLARE base STRING;
    DECLARE statement STRING;
    {_checked_mode()}
    INSERT OVERWRITE {database}.bar_staging
    SELECT year, month, open, close, open_time, close_time, prev_close FROM ({_WITH_PREV});
    SET base = (SELECT if(wanted = 'oc', '{base_column('oc')}', '{base_column('cc')}'));
    SET statement = (SELECT 'INSERT OVERWRITE {database}.report {report}');
    EXECUTE IMMEDIATE statement;
END"""
    ).collect()


def drop(spark: SparkSession) -> None:
    """Remove what :func:`define` made."""
    for name in (MONTH_GROWTH, RATES, MODE_FUNCTION):
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
    spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {MODE}")
    spark.catalog.dropTempView(BARS)


def month_growth_program(spark: SparkSession, bars: DataFrame, mode: str) -> DataFrame:
    """The month report of ``bars`` by the procedure, the session left as it was."""
    define(spark, bars)
    try:
        return call_month_growth(spark, mode)
    finally:
        drop(spark)


def etl_program(spark: SparkSession, bars: DataFrame, database: str, location: str, mode: str) -> DataFrame:
    """The staged report of ``bars`` through the tables of ``database``."""
    setup_tables(spark, database, location)
    define(spark, bars)
    try:
        call_staging_to_report(spark, database, mode)
    finally:
        drop(spark)
    return spark.table(f"{database}.report")
