"""Growth rates and row-wise sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mode of a report -> column the close is compared with.
BASE_OF_MODE = {"oc": "open", "cc": "prev_close"}


def base_column(mode: str) -> str:
    if mode not in BASE_OF_MODE:
        raise ValueError(f"unknown mode {mode!r}, expected one of {sorted(BASE_OF_MODE)}")
    return BASE_OF_MODE[mode]


def growth_rate(close: Column, base: Column) -> Column:
    """Percent change from ``base`` to ``close``; NULL for a zero base."""
    return (F.try_divide(close, base) - 1) * 100


# The sums below are SQL text: a dozen columns make a long expression, and text
# reaches the JVM in one call.


def strict_sum(cells: Sequence[str]) -> str:
    """Row-wise sum, NULL as soon as one term is."""
    return "(" + " + ".join(cells) + ")"


def present_sum(cells: Sequence[str]) -> str:
    """Row-wise sum of the terms that are there; NULL where none is."""
    terms = " + ".join(f"coalesce({c}, 0)" for c in cells)
    return f"if(coalesce({', '.join(cells)}) IS NULL, NULL, {terms})"


def present_mean(cells: Sequence[str]) -> str:
    """Row-wise mean of the terms that are there; NULL where none is."""
    count = " + ".join(f"int({c} IS NOT NULL)" for c in cells)
    return f"try_divide({present_sum(cells)}, {count})"
