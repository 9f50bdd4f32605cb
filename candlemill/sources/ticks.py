"""Raw tick files and their typed form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from candlemill.functions.parsing import decimal_comma, must_parse, tick_time
from candlemill.functions.periods import MONTH, period_columns
from candlemill.schemas import PRICE_COLUMNS, TICK_LANDING, TICK_PRICE, TICK_RAW


# Cells without which a line is not a tick.
NEEDED = ("time", "open", "close")


def tick_options() -> dict[str, str]:
    """CSV settings of a raw tick file: ``;``, quotes allowed, one header line per file."""
    return {"sep": ";", "quote": '"', "header": "true", "encoding": "UTF-8", "mode": "PERMISSIVE"}


def scan_ticks(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType = TICK_RAW,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Tick files as text columns, matched to ``schema`` by position.

    The files stay splittable, so a large one is read by many tasks. A short row
    gets NULLs at its end.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).options(**tick_options(), **(options or {})).csv(paths)


def scan_landing(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Tick files under the landing layout, whose ``modified_timestamp`` no file has."""
    return scan_ticks(spark, paths, TICK_LANDING)


def _typed(raw: DataFrame, columns: Sequence[str], price: str | DataType, bad_rows: str) -> DataFrame:
    """Time and prices parsed; ``bad_rows`` is fail, drop or null."""
    if bad_rows not in ("fail", "drop", "null"):
        raise ValueError(f"bad_rows must be fail, drop or null, not {bad_rows!r}")

    def parsed(name: str) -> Column:
        text = F.col(name)
        value = tick_time(text) if name == "time" else decimal_comma(text, price)
        if bad_rows == "fail":
            value = must_parse(text, value, name, needed=name in NEEDED)
        return value.alias(name)

    others = [c for c in raw.columns if c not in TICK_RAW.names]
    typed = raw.select(*[parsed(c) for c in ("time", *columns)], *others)
    if bad_rows == "drop":
        typed = typed.dropna(subset=["time", *columns])
    return typed


def without_time_where_incomplete(ticks: DataFrame) -> DataFrame:
    """Ticks that lack a price lose their time as well: they count as lines and no more."""
    whole = F.col("open").isNotNull() & F.col("close").isNotNull()
    return ticks.withColumn("time", F.when(whole, F.col("time")))


def load_ticks(raw: DataFrame, bad_rows: str = "fail") -> DataFrame:
    """All columns of the tick table: timestamp and ``decimal(9,5)`` prices."""
    return _typed(raw, PRICE_COLUMNS, TICK_PRICE, bad_rows)


def normalize_ticks(
    raw: DataFrame, price: str | DataType = "double", bad_rows: str = "fail"
) -> DataFrame:
    """The three columns the reports need: time, open, close."""
    return _typed(raw, ["open", "close"], price, bad_rows)


def normalize_ticks_with_month(
    raw: DataFrame, price: str | DataType = "double", bad_rows: str = "fail"
) -> DataFrame:
    """The same with year and month of the tick."""
    ticks = normalize_ticks(raw, price, bad_rows)
    return ticks.withColumns(period_columns(F.col("time"), MONTH))


def split_tick_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Text lines cut at ``;`` into time, open and close (fields 0, 1 and 4)."""
    fields = F.split(F.col(line), ";")
    return lines.select(
        fields[0].alias("time"),
        fields[1].alias("open"),
        fields[4].alias("close"),
        *[c for c in lines.columns if c != line],
    )
