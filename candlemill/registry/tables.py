"""The given tables seen as ticks, in Spark and in SQL.

No table holds prices over time, so three stand in: ``lineitem`` and ``orders`` by
date (many rows share a date, hence the tie columns) and ``events`` by timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINEITEM_TIE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
ORDERS_TIE = ("o_orderkey",)
# The same with the digits they have at most: 25 beside the 13 of a time within a month.
LINEITEM_ORDER = {"l_orderkey": 10, "l_linenumber": 1, "l_partkey": 8, "l_suppkey": 6}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem_ticks(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("time"),
        F.col("l_extendedprice").alias("open"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("close"),
        *LINEITEM_TIE,
        *keys,
    )


def order_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("time"),
        F.col("o_totalprice").alias("open"),
        F.col("o_totalprice").alias("close"),
        *ORDERS_TIE,
    )


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").alias("time"),
        F.col("value").alias("open"),
        F.col("value").alias("close"),
        "event_id",
        "event_type",
    )


def bars_sql(ticks: str, keys: str, tie: str) -> str:
    """CTEs ``ticks``, ``ranked`` and ``bars`` for DuckDB."""
    forward = ", ".join(["time", *tie.split(), "open"])
    back = ", ".join(f"{c} DESC" for c in ["time", *tie.split(), "close"])
    return f"""ticks AS ({ticks}),
ranked AS (
    SELECT *,
           row_number() OVER (PARTITION BY {keys} ORDER BY {forward}) AS from_start,
           row_number() OVER (PARTITION BY {keys} ORDER BY {back}) AS from_end
    FROM ticks
),
bars AS (
    SELECT {keys},
           max(CASE WHEN from_start = 1 THEN open END) AS open,
           max(CASE WHEN from_end = 1 THEN close END) AS close,
           min(time) AS open_time,
           max(time) AS close_time
    FROM ranked GROUP BY {keys}
)"""


_MONTH_OF = "CAST(year({t}) AS INTEGER) AS year, CAST(month({t}) AS INTEGER) AS month"

LINEITEM_TICKS_SQL = f"""SELECT {_MONTH_OF.format(t='l_shipdate')}, CAST(l_shipdate AS DATE) AS day,
    l_shipdate AS time, l_extendedprice AS open, l_extendedprice * (1 - l_discount) AS close,
    l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem"""

ORDERS_TICKS_SQL = f"""SELECT {_MONTH_OF.format(t='o_orderdate')}, CAST(o_orderdate AS DATE) AS day,
    o_orderdate AS time, o_totalprice AS open, o_totalprice AS close, o_orderkey FROM orders"""

EVENTS_TICKS_SQL = f"""SELECT {_MONTH_OF.format(t='ts')}, CAST(ts AS DATE) AS day,
    ts AS time, value AS open, value AS close, event_id, event_type FROM events"""

LINEITEM_MONTH_BARS = bars_sql(LINEITEM_TICKS_SQL, "year, month", " ".join(LINEITEM_TIE))
ORDERS_MONTH_BARS = bars_sql(ORDERS_TICKS_SQL, "year, month", "o_orderkey")
ORDERS_DAY_BARS = bars_sql(ORDERS_TICKS_SQL, "day", "o_orderkey")
EVENTS_DAY_BARS = bars_sql(EVENTS_TICKS_SQL, "day", "event_id")

PREV_MONTH = """prevs AS (
    SELECT *, coalesce(lag(close) OVER (ORDER BY year, month), open) AS prev_close FROM bars
)"""

PREV_DAY = """prevs AS (
    SELECT *, coalesce(lag(close) OVER (ORDER BY day), open) AS prev_close FROM bars
)"""

BASE = {"oc": "open", "cc": "prev_close"}


def rates_sql(
    bars: str, mode: str, prevs: str = PREV_MONTH, keys: str = "year, month", price: str = "{x}"
) -> str:
    """CTEs up to ``rates``: keys and ``rate``, not rounded. ``price`` turns a price ``{x}``
    into what the rate is taken of."""
    close, base = price.format(x="close"), price.format(x=BASE[mode])
    return f"""{bars},
{prevs},
rates AS (
    SELECT {keys}, ({close} / nullif({base}, 0) - 1) * 100 AS rate FROM prevs
)"""
