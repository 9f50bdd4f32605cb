"""Growth rate of each bar, and the aggregates that sit beside it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.functions.periods import MONTH
from candlemill.functions.rates import base_column, growth_rate
from candlemill.operators.prev_close import with_prev_close


def with_rate(
    bars: DataFrame, mode: str, period: Sequence[str] = MONTH, keys: Sequence[str] = ()
) -> DataFrame:
    """Add ``growth_rate`` in percent; ``oc`` against the open, ``cc`` the previous close."""
    base = base_column(mode)
    if base not in bars.columns:
        bars = with_prev_close(bars, period, keys)
    return bars.withColumn("growth_rate", growth_rate(F.col("close"), F.col(base)))


def year_totals(rates: DataFrame) -> DataFrame:
    return rates.groupBy("year").agg(F.sum("growth_rate").alias("total"))


def with_year_total(rates: DataFrame) -> DataFrame:
    """Each month's rate with the total of its year joined back."""
    return rates.join(year_totals(rates), "year").select("year", "month", "growth_rate", "total")


def year_means(rates: DataFrame) -> DataFrame:
    """Mean over the months a year has."""
    return rates.groupBy("year").agg(F.avg("growth_rate").alias("AVG"))


def month_means(rates: DataFrame) -> DataFrame:
    """Mean over the years a month is present in."""
    return rates.groupBy("month").agg(F.avg("growth_rate").alias("growth_rate"))


def weekday_means(rates: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean daily rate per month number and weekday, over all years."""
    return (
        rates.withColumns({"month": F.month("day"), "weekday": F.weekday("day")})
        .groupBy(*keys, "month", "weekday")
        .agg(F.avg("growth_rate").alias("growth_rate"))
    )


def weekday_totals(means: DataFrame) -> DataFrame:
    """Unweighted mean of a month's weekday means, Saturday included."""
    return means.groupBy("month").agg(F.avg("growth_rate").alias("total"))
