"""Last column of a wide table, taken row by row from its twelve cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.functions.rates import strict_sum
from candlemill.operators.pivots import MONTH_CELLS, quoted


def sum_of_twelve(wide: DataFrame) -> DataFrame:
    """Sum of the cells; NULL for a year with an absent month."""
    return wide.withColumn("total", F.expr(strict_sum(quoted(MONTH_CELLS))))


def mean_of_twelve(wide: DataFrame) -> DataFrame:
    """A twelfth of that sum; NULL for a year with an absent month."""
    return wide.withColumn("AVG", F.expr(f"{strict_sum(quoted(MONTH_CELLS))} / 12"))


def sum_with_zeros(wide: DataFrame, digits: int = 3) -> DataFrame:
    """Sum in which an absent month counts as zero."""
    cells = [f"coalesce({c}, 0)" for c in quoted(MONTH_CELLS)]
    return wide.withColumn("TOTAL", F.expr(f"round({strict_sum(cells)}, {digits})"))
