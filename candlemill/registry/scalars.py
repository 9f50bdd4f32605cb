"""Scalar functions, row by row over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.functions.parsing import comma_text, decimal_comma, market_of, tick_time
from candlemill.functions.periods import month_title, weekday
from candlemill.functions.rates import growth_rate, present_sum, strict_sum
from candlemill.registry.base import Query, rounded
from candlemill.registry.tables import event_ticks, table
from candlemill.sources.ticks import normalize_ticks_with_month, split_tick_lines


def tick_lines(ticks: DataFrame) -> DataFrame:
    """Events as lines of a raw tick file, with their id kept beside."""
    price = comma_text(F.col("open"))
    time = F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    line = F.concat_ws(";", time, price, price, price, price, F.lit("0"))
    return ticks.select("event_id", line.alias("value"))


# Price text of an event in DuckDB, decimal comma included.
PRICE_SQL = "replace(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), '.', ',')"


def normalize_ticks_query(spark, sf_dir):
    raw = split_tick_lines(tick_lines(event_ticks(spark, sf_dir)))
    return rounded(normalize_ticks_with_month(raw))


NORMALIZE_SQL = """SELECT event_id, ts AS time, CAST(year(ts) AS INTEGER) AS year,
    CAST(month(ts) AS INTEGER) AS month, round(value, 4) AS open, round(value, 4) AS close FROM events"""


def fn_datetime(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    time = F.col("parsed")
    return events.select("event_id", tick_time(text).alias("parsed")).select(
        "event_id",
        "parsed",
        F.year(time).alias("year"),
        F.month(time).alias("month"),
        F.dayofmonth(time).alias("day"),
        weekday(time).alias("weekday"),
        F.date_format(time, "yyyy").alias("year_text"),
        F.date_format(time, "MM").alias("month_text"),
        F.date_format(time, "yyyy MMMM").alias("year_month"),
        F.date_format(time, "yyyy MMMM dd").alias("year_month_day"),
    )


DATETIME_SQL = """SELECT event_id, ts AS parsed, CAST(year(ts) AS INTEGER) AS year,
    CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
    CAST(isodow(ts) - 1 AS INTEGER) AS weekday, strftime(ts, '%Y') AS year_text,
    strftime(ts, '%m') AS month_text, strftime(ts, '%Y %B') AS year_month,
    strftime(ts, '%Y %B %d') AS year_month_day FROM events"""


def fn_monthname(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", month_title(F.month("o_orderdate")).alias("month"))


def fn_string(spark, sf_dir):
    lines = tick_lines(event_ticks(spark, sf_dir))
    fields = split_tick_lines(lines)
    return fields.select(
        "event_id",
        F.replace("open", F.lit(","), F.lit(".")).alias("open"),
        F.regexp_replace("close", ",", ".").alias("close"),
        F.substring("time", 1, 7).alias("year_month"),
        F.concat_ws("-", F.substring("time", 1, 4), F.substring("time", 6, 2)).alias("rebuilt"),
    )


STRING_SQL = f"""SELECT event_id, replace({PRICE_SQL}, ',', '.') AS open, replace({PRICE_SQL}, ',', '.') AS close,
    strftime(ts, '%Y-%m') AS year_month, strftime(ts, '%Y') || '-' || strftime(ts, '%m') AS rebuilt FROM events"""


def fn_market(spark, sf_dir):
    """File names as they occur: bar size joined, bar size with a blank, none at all."""
    stem = (
        F.when(F.col("event_type") == "click", "XAUUSD_10Secs_Ask_")
        .when(F.col("event_type") == "view", "XAUUSD_10 Secs_Ask_")
        .otherwise("XAUUSD-")
    )
    day = F.date_format("time", "yyyy.MM.dd")
    named = event_ticks(spark, sf_dir).select(
        "event_id", F.concat(F.lit("/data/"), stem, day, F.lit(".csv")).alias("path")
    )
    return named.select("event_id", "path", market_of(F.col("path")).alias("market"))


MARKET_SQL = r"""WITH named AS (SELECT event_id, '/data/' || CASE WHEN event_type = 'click' THEN 'XAUUSD_10Secs_Ask_'
    WHEN event_type = 'view' THEN 'XAUUSD_10 Secs_Ask_' ELSE 'XAUUSD-' END || strftime(ts, '%Y.%m.%d') || '.csv' AS path
    FROM events)
SELECT event_id, path, nullif(substring(regexp_extract(path, '_\w*_\d{4}'), 2, 3), '') AS market FROM named"""


def fn_conditional(spark, sf_dir):
    kind = F.nullif(F.col("event_type"), F.lit("error"))
    known = table(spark, sf_dir, "events").withColumn("kind", kind)
    return known.select(
        "event_id",
        F.coalesce("kind", F.lit("none")).alias("filled"),
        F.when(F.col("kind") == "click", 1).when(F.col("kind") == "view", 2).otherwise(0).alias("code"),
        F.col("kind").eqNullSafe(F.lit(None)).alias("same_as_null"),
        F.col("kind").isNull().alias("is_null"),
    )


CONDITIONAL_SQL = """WITH known AS (SELECT *, nullif(event_type, 'error') AS kind FROM events)
SELECT event_id, coalesce(kind, 'none') AS filled,
    CASE WHEN kind = 'click' THEN 1 WHEN kind = 'view' THEN 2 ELSE 0 END AS code,
    kind IS NOT DISTINCT FROM NULL AS same_as_null, kind IS NULL AS is_null FROM known"""


def fn_round(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(
        "event_id", "round(value / 3, 2) AS two", "round(value / 7, 3) AS three",
        "double(round(cast(value AS decimal(18,2)) / 4, 2)) AS half_up",
    )


ROUND_SQL = """SELECT event_id, round(value / 3, 2) AS two, round(value / 7, 3) AS three,
    CAST(round(CAST(CAST(value AS DECIMAL(18,2)) * 0.25 AS DECIMAL(18,4)), 2) AS DOUBLE) AS half_up FROM events"""


def fn_arith(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    close = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    cells = ["l_extendedprice", "l_tax", "nullif(l_discount, 0)"]
    return rounded(
        lines.select(
            "l_orderkey",
            "l_linenumber",
            growth_rate(close, F.col("l_extendedprice")).alias("rate"),
            growth_rate(close, F.col("l_discount")).alias("zero_base"),
            F.expr(strict_sum(cells)).alias("strict"),
            F.expr(present_sum(cells)).alias("present"),
        )
    )


ARITH_SQL = """SELECT l_orderkey, l_linenumber,
    round((l_extendedprice * (1 - l_discount) / l_extendedprice - 1) * 100, 4) + 0.0 AS rate,
    round((l_extendedprice * (1 - l_discount) / nullif(l_discount, 0) - 1) * 100, 4) AS zero_base,
    round(l_extendedprice + l_tax + nullif(l_discount, 0), 4) AS strict,
    round(l_extendedprice + l_tax + l_discount, 4) AS present FROM lineitem"""


def fn_cast(spark, sf_dir):
    events = event_ticks(spark, sf_dir)
    text = comma_text(F.col("open"))
    return events.select(
        "event_id",
        F.date_format("time", "yyyy").cast("int").alias("year"),
        decimal_comma(text).alias("price"),
        decimal_comma(text, "decimal(10,4)").cast("double").alias("price_decimal"),
        F.date_format("time", "yyyy-MM-dd HH:mm:ss").try_cast("timestamp_ntz").alias("second"),
        F.col("event_id").cast("string").alias("id_text"),
        text.try_cast("double").alias("not_a_number"),
    )


CAST_SQL = f"""SELECT event_id, CAST(strftime(ts, '%Y') AS INTEGER) AS year, value AS price, value AS price_decimal,
    date_trunc('second', ts) AS second, CAST(event_id AS VARCHAR) AS id_text,
    TRY_CAST({PRICE_SQL} AS DOUBLE) AS not_a_number FROM events"""


def scalar_queries() -> list[Query]:
    return [
        Query("normalize_ticks", normalize_ticks_query, NORMALIZE_SQL),
        Query("fn_datetime", fn_datetime, DATETIME_SQL),
        Query("fn_monthname", fn_monthname, "SELECT o_orderkey, monthname(o_orderdate) AS month FROM orders"),
        Query("fn_string", fn_string, STRING_SQL),
        Query("fn_market", fn_market, MARKET_SQL),
        Query("fn_conditional", fn_conditional, CONDITIONAL_SQL),
        Query("fn_round", fn_round, ROUND_SQL),
        Query("fn_arith", fn_arith, ARITH_SQL),
        Query("fn_cast", fn_cast, CAST_SQL),
    ]
