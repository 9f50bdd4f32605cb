"""The row below the years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.functions.rates import present_mean
from candlemill.operators.pivots import MONTH_CELLS, quoted
from candlemill.operators.rates import month_means


def rollup_means(wide: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Every year plus one summary row of column means, in one aggregation.

    A year is a group of one row, so its mean is the value itself. Column
    ``summary`` is 1 for the added row.
    """
    groups = [[*keys, "year"], list(keys)]
    return wide.groupingSets(groups, *keys, "year").agg(
        F.expr("int(grouping(year)) AS summary"),
        *[F.expr(f"avg(`{c}`) AS `{c}`") for c in columns],
    )


def label(summary_text: str) -> str:
    """Year as text, or the name of the summary row; SQL text."""
    return f"if(summary = 1, '{summary_text}', string(year))"


def union_mean_row(wide: DataFrame, columns: Sequence[str], summary_text: str) -> DataFrame:
    """The years UNION one row of column means (distinct, as in SQL)."""
    years = wide.select(F.col("year").cast("string").alias("year"), *columns)
    means = wide.agg(*[F.avg(c).alias(c) for c in columns])
    return years.unionByName(
        means.select(F.lit(summary_text).alias("year"), *columns)
    ).distinct()


def mean_of_month_means(rates: DataFrame, summary_text: str = "AVG") -> DataFrame:
    """One row: the mean of every month and, last, the mean of those means."""
    cells = [
        F.expr(f"max(CASE WHEN month = {m} THEN growth_rate END) AS `{m}`") for m in MONTH_CELLS
    ]
    return (
        month_means(rates)
        .agg(*cells)
        .withColumn("AVG", F.expr(present_mean(quoted(MONTH_CELLS))))
        .select(F.lit(summary_text).alias("year"), *MONTH_CELLS, "AVG")
    )
