"""Series by a key, lines with missing cells, and the audit of reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.functions.periods import MONTH
from candlemill.operators.bars import bars, repeated_times
from candlemill.operators.prev_close import with_prev_close
from candlemill.plans.flavours import FLAVOURS
from candlemill.plans.load import LoadSettings, Store, store_report
from candlemill.plans.reports import growth_report
from candlemill.registry.base import Query, rounded
from candlemill.registry.reports import lineitem_bars, month_sql
from candlemill.registry.tables import LINEITEM_ORDER, LINEITEM_TIE, bars_sql, lineitem_ticks, rates_sql, table
from candlemill.schemas import MONTHS_LONG, REPORT_CELLS
from candlemill.session import fresh_dir
from candlemill.sources.ticks import normalize_ticks

KEY = "l_returnflag"
_N = range(1, 13)


def keyed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month bars of lineitem, a series for each return flag; many rows share a date."""
    return bars(lineitem_ticks(spark, sf_dir, KEY), MONTH, [KEY], LINEITEM_ORDER)


KEYED_BARS = bars_sql(
    f"""SELECT {KEY}, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
    l_shipdate AS time, l_extendedprice AS open, l_extendedprice * (1 - l_discount) AS close,
    {', '.join(LINEITEM_TIE)} FROM lineitem""",
    f"{KEY}, year, month",
    " ".join(LINEITEM_TIE),
)
KEYED_PREV = f"""prevs AS (
    SELECT *, coalesce(lag(close) OVER (PARTITION BY {KEY} ORDER BY year, month), open) AS prev_close FROM bars
)"""


def prev_close_by_key(spark, sf_dir):
    found = with_prev_close(keyed_bars(spark, sf_dir), MONTH, [KEY])
    return rounded(found.select(KEY, *MONTH, "open", "close", "prev_close"))


PREV_SQL = f"""WITH {KEYED_BARS}, {KEYED_PREV}
SELECT {KEY}, year, month, round(open, 4) AS open, round(close, 4) AS close, round(prev_close, 4) AS prev_close
FROM prevs"""


def month_growth_by_key(spark, sf_dir):
    return rounded(growth_report(keyed_bars(spark, sf_dir), "mysql", "cc", [KEY]))


_SUMS = ", ".join(f"sum(CASE WHEN month = {m} THEN rate END) AS m{m}" for m in _N)
_CELLS = ", ".join(f"m{m}" for m in _N)
GROWTH_SQL = f"""WITH {rates_sql(KEYED_BARS, 'cc', KEYED_PREV, f'{KEY}, year, month')},
wide AS (SELECT {KEY}, year, {_SUMS} FROM rates GROUP BY {KEY}, year),
body AS (SELECT {KEY}, CAST(year AS VARCHAR) AS year, {_CELLS},
    {' + '.join(f'coalesce(m{m}, 0)' for m in _N)} AS yc FROM wide),
foot AS (SELECT {KEY}, 'AVG' AS year, {', '.join(f'avg(m{m}) AS m{m}' for m in _N)}, avg(yc) AS yc
    FROM body GROUP BY {KEY})
SELECT {KEY}, year, {', '.join(f'round(m{m}, 4) AS {MONTHS_LONG[m - 1]}' for m in _N)}, round(yc, 4) AS total
FROM (SELECT * FROM body UNION ALL SELECT * FROM foot)"""


def normalize_ticks_dirty(spark, sf_dir):
    """Events as text lines, some of them without a time, an open or a close that reads."""
    events = table(spark, sf_dir, "events")

    def every(n: int):
        return F.col("event_id") % n == 0

    price = F.replace(F.col("value").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    raw = events.select(
        F.when(~every(13), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("time"),
        F.when(every(7), F.lit("")).otherwise(price).alias("open"),
        F.when(every(11), F.lit("1,2,3")).otherwise(price).alias("close"),
        "event_id",
    )
    return rounded(normalize_ticks(raw, bad_rows="drop"))


DIRTY_SQL = """SELECT event_id, ts AS time, round(value, 2) AS open, round(value, 2) AS close FROM events
WHERE event_id % 13 <> 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0"""


def repeated_times_query(spark, sf_dir):
    return repeated_times(lineitem_ticks(spark, sf_dir))


REPEATED_SQL = "SELECT l_shipdate AS time, count(*) AS rows FROM lineitem GROUP BY 1 HAVING count(*) > 1"


def fn_sha256(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.col("text"), 256).alias("checksum"))


SHA_SQL = "SELECT doc_id, sha256(text) AS checksum FROM documents"

AUDITED = [("mysql", "oc"), ("dense", "cc")]


def report_audit(spark, sf_dir):
    """Two flavours and modes through the report's store, read back in one layout."""
    store = Store(spark, fresh_dir(spark, "store"))
    stored = lineitem_bars(spark, sf_dir)
    for flavour, mode in AUDITED:
        report = growth_report(stored, flavour, mode)
        store_report(store, report, LoadSettings(), "2024-02-01 00:00:00", flavour, mode)
    return rounded(store.report_audit().select("year", *REPORT_CELLS, "flavour", "mode"))


def _audited_sql(flavour: str, mode: str) -> str:
    spec = FLAVOURS[flavour]
    cells = ", ".join(f"{h} AS {c}" for c, h in zip(REPORT_CELLS, [*spec.months, spec.year_column]))
    return f"SELECT year, {cells}, '{flavour}' AS flavour, '{mode}' AS mode FROM ({month_sql(flavour, mode)})"


AUDITED_SQL = " UNION ALL ".join(_audited_sql(f, m) for f, m in AUDITED)


def keyed_queries() -> list[Query]:
    return [
        Query("month_growth_by_key", month_growth_by_key, GROWTH_SQL),
        Query("prev_close_by_key", prev_close_by_key, PREV_SQL),
        Query("normalize_ticks_dirty", normalize_ticks_dirty, DIRTY_SQL),
        Query("repeated_times", repeated_times_query, REPEATED_SQL),
        Query("report_audit", report_audit, AUDITED_SQL),
        Query("fn_sha256", fn_sha256, SHA_SQL),
    ]
