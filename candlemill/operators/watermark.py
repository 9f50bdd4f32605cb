"""Moving only new rows to the next layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.functions.parsing import stamp

# Fixed value: watermark of an empty target.
NEVER = "2000-01-01 00:00:01"


def high_watermark(target: DataFrame, column: str = "modified_timestamp") -> str:
    """Latest stamp in the target as a plain value: one aggregated row."""
    found = target.agg(F.max(column).cast("string")).first()[0]
    return NEVER if found is None else found


def rows_since(rows: DataFrame, watermark, column: str = "modified_timestamp") -> DataFrame:
    """Rows stamped later. The watermark is a literal, so the filter is pushed to the scan."""
    return rows.filter(F.col(column) > stamp(watermark))


def stamped(rows: DataFrame, batch_time, column: str = "modified_timestamp") -> DataFrame:
    """Rows without a stamp get this batch's; the others keep theirs."""
    return rows.withColumn(column, F.coalesce(F.col(column), stamp(batch_time)))
