"""Close of the period before."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlemill.functions.periods import MONTH


def with_prev_close(
    bars: DataFrame, period: Sequence[str] = MONTH, keys: Sequence[str] = ()
) -> DataFrame:
    """Add ``prev_close``: close of the previous period that has ticks, else own open.

    The window sees bars, never ticks: a few rows per year for each key.
    """
    window = Window.partitionBy(*keys).orderBy(*period)
    return bars.withColumn(
        "prev_close", F.coalesce(F.lag("close").over(window), F.col("open"))
    )
