"""The rollup report written in SQL, with the mode as a parameter marker."""

from __future__ import annotations

from pyspark.sql import DataFrame

from candlemill.functions.rates import base_column
from candlemill.schemas import MONTHS_SHORT

RATE_SQL = """
WITH with_prev AS (
    SELECT year, month, open, close,
           COALESCE(LAG(close) OVER (ORDER BY year, month), open) AS prev_close
    FROM {bars}
)
SELECT year, month,
       ROUND((TRY_DIVIDE(close, IF(:mode = 'oc', open, prev_close)) - 1) * 100, 2) AS growth_rate
FROM with_prev
"""

_MONTHS = range(1, 13)

REPORT_SQL = """
WITH wide AS (
    SELECT * FROM (SELECT year, month, CAST(growth_rate AS DECIMAL(16,3)) AS rate FROM {{rates}})
    PIVOT (SUM(rate) FOR month IN ({months}))
), means AS (
    SELECT year, GROUPING(year) AS summary,
           {cells},
           CAST(ROUND(AVG({strict_sum}) / 12, 2) AS DOUBLE) AS AVG
    FROM wide
    GROUP BY year WITH ROLLUP
)
SELECT IF(summary = 1, 'AVG', CAST(year AS STRING)) AS year, {names}, AVG
FROM means
ORDER BY summary, means.year
""".format(
    months=", ".join(f"{m} AS m{m}" for m in _MONTHS),
    cells=", ".join(
        f"CAST(ROUND(AVG(m{m}), 2) AS DOUBLE) AS {name}" for m, name in zip(_MONTHS, MONTHS_SHORT)
    ),
    names=", ".join(MONTHS_SHORT),
    strict_sum=" + ".join(f"m{m}" for m in _MONTHS),
)


def growth_rates_sql(bars: DataFrame, mode: str = "oc") -> DataFrame:
    """Month rates rounded to two digits."""
    base_column(mode)  # refuses an unknown mode
    return bars.sparkSession.sql(RATE_SQL, args={"mode": mode}, bars=bars)


def growth_report_sql(bars: DataFrame, mode: str = "oc") -> DataFrame:
    """The same table as ``growth_report(bars, 'rollup', mode)``."""
    rates = growth_rates_sql(bars, mode)
    return bars.sparkSession.sql(REPORT_SQL, rates=rates)
