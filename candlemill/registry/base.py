"""Shared pieces of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

# Cells are compared at this many digits: sums of doubles differ further down.
DIGITS = 4


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None = None


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded for comparison; -0.0 becomes 0.0."""
    return df.selectExpr(
        *[
            f"round(`{name}`, {digits}) + 0D AS `{name}`" if kind == "double" else f"`{name}`"
            for name, kind in df.dtypes
        ]
    )
