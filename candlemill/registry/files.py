"""Sources, sinks, audit and load over files written from the given tables.

``events`` stands in for the ticks. It is written out once per session and table
folder as tick files, one folder per day, and read back by the queries here.
"""

from __future__ import annotations

import hashlib
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.functions.parsing import comma_text
from candlemill.functions.periods import DAY, MONTH
from candlemill.operators.audit import (
    audit_state,
    files_to_load,
    finished_rows,
    started_rows,
    times_seen,
)
from candlemill.operators.bars import bars
from candlemill.operators.prev_close import with_prev_close
from candlemill.operators.upsert import merge_bars, replace_rows, upsert_with_prev_close
from candlemill.operators.watermark import high_watermark, rows_since, stamped
from candlemill.plans.load import LoadSettings, Store, load_files, run_load
from candlemill.plans.reports import growth_report
from candlemill.registry.base import Query, rounded
from candlemill.registry.reports import lineitem_bars, month_sql
from candlemill.registry.scalars import PRICE_SQL
from candlemill.registry.tables import (
    EVENTS_DAY_BARS,
    EVENTS_TICKS_SQL,
    LINEITEM_MONTH_BARS,
    PREV_DAY,
    PREV_MONTH,
    bars_sql,
    event_ticks,
)
from candlemill.schemas import FILE_AUDIT, MONTHS_SHORT, TICK_HEADER, TICK_LANDING
from candlemill.session import fresh_dir
from candlemill.sinks.files import append_log, read_log, write_report_csv
from candlemill.sinks.tables import (
    TABLES,
    insert_rows,
    setup_tables,
    truncate_and_load,
    with_lineage,
)
from candlemill.sources.files import line_counts, list_files, manifest
from candlemill.sources.tables import scan_staging_csv, stored_report
from candlemill.sources.ticks import load_ticks, normalize_ticks, scan_landing, scan_ticks
from candlemill.streaming.load import stream_files, stream_ticks

# Times of the two batches, and the day that separates them.
FIRST_BATCH = "2024-02-01 00:00:00"
SECOND_BATCH = "2024-02-02 00:00:00"
SPLIT_DAY = "2024-01-15"

_exported: dict[tuple[str, str], str] = {}

SOURCE_PATTERN = r"source=([^/]+)"
# Folder of a day in DuckDB.
SOURCE_SQL = "'XAUUSD_10Secs_Ask_' || strftime(ts, '%Y.%m.%d')"


def tick_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder with ``events`` as raw tick files."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _exported:
        price = comma_text(F.col("open"))
        cells = [F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS"), price, price, price, price, F.lit("0")]
        source = F.concat(F.lit("XAUUSD_10Secs_Ask_"), F.date_format("time", "yyyy.MM.dd"))
        path = fresh_dir(spark, "ticks")
        (
            event_ticks(spark, sf_dir)
            .select(*[c.alias(name) for c, name in zip(cells, TICK_HEADER)], source.alias("source"))
            .hint("rebalance", "source")
            .write.partitionBy("source")
            .options(sep=";", header=True, ignoreTrailingWhiteSpace=False)
            .csv(path)
        )
        _exported[key] = path
    return _exported[key]


def source_of(path):
    return F.regexp_extract(path, SOURCE_PATTERN, 1)


# --- scans --------------------------------------------------------------------------


def scan_ticks_query(spark, sf_dir):
    return scan_ticks(spark, tick_files(spark, sf_dir)).select("source", "time", "open", "close")


SCAN_SQL = f"""SELECT {SOURCE_SQL} AS source, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time,
    {PRICE_SQL} AS open, {PRICE_SQL} AS close FROM events"""


def load_ticks_decimal(spark, sf_dir):
    typed = load_ticks(scan_ticks(spark, tick_files(spark, sf_dir)))
    doubles = [F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")]
    return rounded(typed.select("time", *doubles))


LOAD_SQL = """SELECT ts AS time, round(value, 4) AS open, round(value, 4) AS high, round(value, 4) AS low,
    round(value, 4) AS close, 0.0::DOUBLE AS volume FROM events"""


def scan_ticks_permissive(spark, sf_dir):
    landed = scan_landing(spark, tick_files(spark, sf_dir))
    return landed.select("time", "open", "close", "modified_timestamp")


PERMISSIVE_SQL = f"""SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time, {PRICE_SQL} AS open,
    {PRICE_SQL} AS close, CAST(NULL AS TIMESTAMP) AS modified_timestamp FROM events"""


def scan_staging(spark, sf_dir):
    path = fresh_dir(spark, "staging-csv")
    staged = with_prev_close(lineitem_bars(spark, sf_dir))
    staged.select(*MONTH, "open", "close", "prev_close").write.csv(path, sep=";", header=True)
    return rounded(scan_staging_csv(spark, path))


STAGING_SQL = f"""WITH {LINEITEM_MONTH_BARS}, {PREV_MONTH}
SELECT year, month, round(open, 4) AS open, round(close, 4) AS close, round(prev_close, 4) AS prev_close FROM prevs"""


# --- files and their audit ------------------------------------------------------------


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = list_files(spark, tick_files(spark, sf_dir)).filter(F.col("path").rlike(r"XAUUSD_10.*Ask"))
    return manifest(files, source_of(F.col("path")))


def file_manifest(spark, sf_dir):
    """Files of a day are summed: how many the writer makes is up to the cluster."""
    lines = line_counts(spark, tick_files(spark, sf_dir), with_header=False)
    found = _manifest(spark, sf_dir).withColumnRenamed("file_uri", "file_path")
    return (
        found.join(lines, "file_path")
        .groupBy("file_name", "market")
        .agg(
            F.sum("lines").alias("lines"),
            F.bool_and(F.col("checksum").rlike("^[0-9a-f]{64}$")).alias("hashed"),
        )
    )


MANIFEST_SQL = f"""SELECT {SOURCE_SQL} AS file_name, '10S' AS market, count(*) AS lines, true AS hashed
FROM events GROUP BY 1"""


def _audited(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Manifest, and a log in which days up to the split are finished, later ones up to
    the 20th were started twice without an end, and the others are not there."""
    found = _manifest(spark, sf_dir)
    path = fresh_dir(spark, "manifest")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    day = F.to_date(F.right("file_name", F.lit(10)), "yyyy.MM.dd")
    done = found.filter(day <= F.lit(SPLIT_DAY).cast("date"))
    open_ = found.filter((day > F.lit(SPLIT_DAY).cast("date")) & (F.dayofmonth(day) <= 20))
    log_path = fresh_dir(spark, "file-audit")
    started = started_rows(done, FIRST_BATCH, "load")
    append_log(started.unionByName(started_rows(open_, FIRST_BATCH, "load")), log_path)
    lines = line_counts(spark, tick_files(spark, sf_dir), with_header=False)
    counted = done.join(lines, done.file_uri == lines.file_path).select("checksum", "lines")
    append_log(finished_rows(started, counted, "2024-02-01 00:10:00"), log_path)
    append_log(started_rows(open_, SECOND_BATCH, "load"), log_path)
    return found, read_log(spark, log_path, FILE_AUDIT)


def files_to_load_query(spark, sf_dir):
    found, log = _audited(spark, sf_dir)
    return files_to_load(found, log).select("file_name").distinct()


TO_LOAD_SQL = f"SELECT DISTINCT {SOURCE_SQL} AS file_name FROM events WHERE CAST(ts AS DATE) > DATE '{SPLIT_DAY}'"


def audit_state_query(spark, sf_dir):
    """Every day with the state of its files; days that nothing was logged for have none."""
    found, log = _audited(spark, sf_dir)
    state = audit_state(log).drop("file_name", "market")
    return (
        found.select("checksum", "file_name", "market")
        .join(state, "checksum", "left")
        .groupBy("file_name", "market", "task_name", "start_timestamp", "end_timestamp")
        .agg(F.sum("lines").alias("lines"))
    )


STATE_SQL = f"""WITH days AS (
    SELECT {SOURCE_SQL} AS file_name, CAST(ts AS DATE) <= DATE '{SPLIT_DAY}' AS done, day(ts) <= 20 AS known,
        count(*) AS n FROM events GROUP BY ALL)
SELECT file_name, '10S' AS market, CASE WHEN done OR known THEN 'load' END AS task_name,
    CASE WHEN done THEN TIMESTAMP '{FIRST_BATCH}' WHEN known THEN TIMESTAMP '{SECOND_BATCH}' END AS start_timestamp,
    CASE WHEN done THEN TIMESTAMP '2024-02-01 00:10:00' END AS end_timestamp,
    CASE WHEN done THEN CAST(n AS BIGINT) END AS lines FROM days"""


def audit_lookup(spark, sf_dir):
    """One checksum looked up in an ORC log with an entry per day of events."""
    days = event_ticks(spark, sf_dir).select(F.to_date("time").alias("day")).distinct()
    files = days.select(
        F.sha2(F.col("day").cast("string"), 256).alias("checksum"),
        F.col("day").cast("string").alias("file_name"),
        F.lit(None).cast("string").alias("market"),
    )
    path = fresh_dir(spark, "orc-audit")
    append_log(started_rows(files, FIRST_BATCH, "load"), path, "orc")
    known = hashlib.sha256(SPLIT_DAY.encode()).hexdigest()
    return times_seen(read_log(spark, path, FILE_AUDIT, "orc"), known)


LOOKUP_SQL = f"""SELECT count(*) AS rows FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)
WHERE sha256(CAST(day AS VARCHAR)) = sha256('{SPLIT_DAY}')"""


def audit_append(spark, sf_dir):
    """Bars appended by two runs, each with its time and name."""
    days = bars(event_ticks(spark, sf_dir), DAY)
    path = fresh_dir(spark, "bar-audit")
    append_log(with_lineage(days, FIRST_BATCH, "one"), path)
    append_log(with_lineage(days, SECOND_BATCH, "two"), path)
    stored = spark.read.parquet(path)
    return rounded(stored.select("day", "open", "close", "load_timestamp", "task_name"))


AUDIT_APPEND_SQL = f"""WITH {EVENTS_DAY_BARS}, runs AS (
    SELECT TIMESTAMP '{FIRST_BATCH}' AS load_timestamp, 'one' AS task_name
    UNION ALL SELECT TIMESTAMP '{SECOND_BATCH}', 'two')
SELECT day, round(open, 4) AS open, round(close, 4) AS close, load_timestamp, task_name FROM bars, runs"""


# --- upserts ----------------------------------------------------------------------------


def _two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Day bars of two batches whose times overlap everywhere."""
    ticks = event_ticks(spark, sf_dir)
    early = F.col("event_type").isin("click", "view")
    return bars(ticks.filter(early), DAY), bars(ticks.filter(~early), DAY)


def upsert_merge(spark, sf_dir):
    old, new = _two_batches(spark, sf_dir)
    return rounded(merge_bars(old, new, DAY))


MERGE_SQL = f"""WITH {EVENTS_DAY_BARS}
SELECT day, round(open, 4) AS open, round(close, 4) AS close, open_time, close_time FROM bars"""


def upsert_replace(spark, sf_dir):
    """The newer batch has no bars before the split day, where the older ones stay."""
    old, new = _two_batches(spark, sf_dir)
    new = new.filter(F.col("day") > F.lit(SPLIT_DAY).cast("date"))
    return rounded(replace_rows(old, new, DAY).select("day", "open", "close"))


_BATCH_SQL = """SELECT ts AS time, CAST(ts AS DATE) AS day, value AS open, value AS close, event_id FROM events
WHERE event_type {test} ('click', 'view')"""


def _batch_bars(name: str, test: str) -> str:
    body = bars_sql(_BATCH_SQL.format(test=test), "day", "event_id")
    return f"{name} AS (WITH {body} SELECT * FROM bars)"


REPLACE_SQL = f"""WITH {_batch_bars('old_bars', 'IN')}, {_batch_bars('new_bars', 'NOT IN')},
newer AS (SELECT * FROM new_bars WHERE day > DATE '{SPLIT_DAY}')
SELECT day, round(coalesce(n.open, o.open), 4) AS open, round(coalesce(n.close, o.close), 4) AS close
FROM old_bars o FULL JOIN newer n USING (day)"""


def prev_close_after_merge(spark, sf_dir):
    old, new = _two_batches(spark, sf_dir)
    merged = upsert_with_prev_close(old, new, DAY)
    return rounded(merged.select("day", "open", "close", "prev_close"))


PREV_AFTER_SQL = f"""WITH {EVENTS_DAY_BARS}, {PREV_DAY}
SELECT day, round(open, 4) AS open, round(close, 4) AS close, round(prev_close, 4) AS prev_close FROM prevs"""


# --- stamps and watermarks -----------------------------------------------------------------


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """Ticks of two loads, each stamped when it came in."""
    landed = scan_landing(spark, tick_files(spark, sf_dir))
    early = F.col("time") < F.date_add(F.lit(SPLIT_DAY).cast("date"), 1).cast("string")
    path = fresh_dir(spark, "landing")
    append_log(stamped(landed.filter(early).select(*TICK_LANDING.names), FIRST_BATCH), path)
    stamps = stamped(landed.filter(~early).select(*TICK_LANDING.names), SECOND_BATCH)
    append_log(stamps, path)
    return path


def stamp_batch(spark, sf_dir):
    """A third stamping changes nothing: every row keeps the one it has."""
    stored = spark.read.schema(TICK_LANDING).parquet(_landed(spark, sf_dir))
    return stamped(stored, "2024-02-03 00:00:00").select("time", "close", "modified_timestamp")


STAMP_SQL = f"""SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS time, {PRICE_SQL} AS close,
    CASE WHEN CAST(ts AS DATE) <= DATE '{SPLIT_DAY}' THEN TIMESTAMP '{FIRST_BATCH}'
         ELSE TIMESTAMP '{SECOND_BATCH}' END AS modified_timestamp FROM events"""


def incremental_watermark(spark, sf_dir):
    """Day bars of the rows stamped after the newest row of the next layer."""
    landed = spark.read.schema(TICK_LANDING).parquet(_landed(spark, sf_dir))
    before = landed.filter(F.col("modified_timestamp") <= F.lit(FIRST_BATCH).cast("timestamp_ntz"))
    delta = rows_since(landed, high_watermark(before))
    return rounded(bars(normalize_ticks(delta), DAY))


WATERMARK_SQL = f"""WITH {EVENTS_DAY_BARS}
SELECT day, round(open, 4) AS open, round(close, 4) AS close, open_time, close_time
FROM bars WHERE day > DATE '{SPLIT_DAY}'"""


# --- tables and sinks -----------------------------------------------------------------------


def _database(spark: SparkSession, name: str) -> str:
    database = f"candlemill_{name}"
    if not spark.catalog.databaseExists(database):
        setup_tables(spark, database, fresh_dir(spark, database))
    return database


def _total_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MySQL-style report under the short month names of the report table."""
    return growth_report(lineitem_bars(spark, sf_dir), "mysql", "oc").toDF("year", *MONTHS_SHORT, "total")


_REPORT = month_sql("mysql", "oc")
for _long, _short in zip(
    ["January", "February", "March", "April", "June", "July", "August", "September", "October", "November", "December"],
    [m for m in MONTHS_SHORT if m != "May"],
):
    _REPORT = _REPORT.replace(f"AS {_long}", f'AS "{_short}"')


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_prev_close(lineitem_bars(spark, sf_dir))


def insert_select(spark, sf_dir):
    database = _database(spark, "insert")
    spark.sql(f"TRUNCATE TABLE {database}.bar_staging")
    insert_rows(_staged(spark, sf_dir), f"{database}.bar_staging")
    return rounded(spark.table(f"{database}.bar_staging"))


INSERT_SQL = f"""WITH {LINEITEM_MONTH_BARS}, {PREV_MONTH}
SELECT year, month, round(open, 4) AS open, round(close, 4) AS close, open_time, close_time,
    round(prev_close, 4) AS prev_close FROM prevs"""


def setup_tables_query(spark, sf_dir):
    """Set up twice, which must not lose rows, then count every table."""
    database = _database(spark, "setup")
    location = spark.catalog.getDatabase(database).locationUri
    truncate_and_load(_staged(spark, sf_dir), f"{database}.bar_staging")
    truncate_and_load(_total_report(spark, sf_dir), f"{database}.report")
    setup_tables(spark, database, location)
    counts = [
        spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name in TABLES
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


SETUP_SQL = """SELECT 'bar_staging' AS name, count(DISTINCT strftime(l_shipdate, '%Y-%m')) AS rows FROM lineitem
UNION ALL SELECT 'report', count(DISTINCT year(l_shipdate)) + 1 FROM lineitem
UNION ALL SELECT 'file_audit', 0 UNION ALL SELECT 'bar_audit', 0 UNION ALL SELECT 'report_audit', 0"""


def sink_report_csv(spark, sf_dir):
    report = growth_report(lineitem_bars(spark, sf_dir), "dense", "oc")
    path = fresh_dir(spark, "report-csv")
    write_report_csv(report, path)
    return rounded(spark.read.schema(report.schema).csv(path, sep=";", header=True))


def sink_truncate_load(spark, sf_dir):
    """Loaded twice: the second load replaces the first."""
    table = f"{_database(spark, 'sink')}.report"
    report = _total_report(spark, sf_dir)
    truncate_and_load(report, table)
    truncate_and_load(report, table)
    return rounded(spark.table(table))


def get_result(spark, sf_dir):
    table = f"{_database(spark, 'result')}.report"
    truncate_and_load(_total_report(spark, sf_dir), table)
    return rounded(stored_report(spark, table))


# --- the whole load ------------------------------------------------------------------------


_BAR_COLUMNS = [*MONTH, "open", "close", "open_time", "close_time", "prev_close"]
_LOADED = f"""WITH {bars_sql(EVENTS_TICKS_SQL, 'year, month', 'event_id')}, {PREV_MONTH}
SELECT year, month, round(open, 4) AS open, round(close, 4) AS close, open_time, close_time,
    round(prev_close, 4) AS prev_close FROM prevs"""


def _settings() -> LoadSettings:
    return LoadSettings(file_name=source_of(F.col("path")))


def incremental_load(spark, sf_dir):
    """Later files first, then all of them: the known ones are passed over."""
    source = tick_files(spark, sf_dir)
    store = Store(spark, fresh_dir(spark, "store"))
    files = list_files(spark, source)
    day = F.right(source_of(F.col("path")), F.lit(10))
    late = files.filter(day > F.lit(SPLIT_DAY.replace("-", ".")))
    load_files(store, late, _settings())
    load_files(store, files, _settings())
    return rounded(store.bars.read().select(*_BAR_COLUMNS))


def full_reload(spark, sf_dir):
    """State after two full loads: each file is known once, with its lines."""
    root = fresh_dir(spark, "store")
    for _ in range(2):
        run_load(spark, tick_files(spark, sf_dir), root, "full", "oc", "dense", _settings())
    state = audit_state(Store(spark, root).file_audit())
    return (
        state.filter(F.col("end_timestamp").isNotNull())
        .groupBy("file_name", "market")
        .agg(F.sum("lines").alias("lines"))
    )


FULL_SQL = f"""SELECT {SOURCE_SQL} AS file_name, '10S' AS market, count(*) AS lines FROM events GROUP BY 1"""


def _streamed(start, spark, sf_dir):
    root = fresh_dir(spark, "store")
    query = start(spark, tick_files(spark, sf_dir), root, f"{root}/checkpoint")
    query.awaitTermination()
    return rounded(Store(spark, root).bars.read().select(*_BAR_COLUMNS))


def stream_load(spark, sf_dir):
    return _streamed(partial(stream_files, settings=_settings(), files_per_batch=10), spark, sf_dir)


def stream_merge(spark, sf_dir):
    return _streamed(partial(stream_ticks, files_per_batch=10), spark, sf_dir)


def file_queries() -> list[Query]:
    return [
        Query("scan_ticks", scan_ticks_query, SCAN_SQL),
        Query("load_ticks_decimal", load_ticks_decimal, LOAD_SQL),
        Query("scan_ticks_permissive", scan_ticks_permissive, PERMISSIVE_SQL),
        Query("scan_staging", scan_staging, STAGING_SQL),
        Query("file_manifest", file_manifest, MANIFEST_SQL),
        Query("files_to_load", files_to_load_query, TO_LOAD_SQL),
        Query("audit_state", audit_state_query, STATE_SQL),
        Query("audit_lookup", audit_lookup, LOOKUP_SQL),
        Query("audit_append", audit_append, AUDIT_APPEND_SQL),
        Query("upsert_merge", upsert_merge, MERGE_SQL),
        Query("upsert_replace", upsert_replace, REPLACE_SQL),
        Query("prev_close_after_merge", prev_close_after_merge, PREV_AFTER_SQL),
        Query("stamp_batch", stamp_batch, STAMP_SQL),
        Query("incremental_watermark", incremental_watermark, WATERMARK_SQL),
        Query("insert_select", insert_select, INSERT_SQL),
        Query("setup_tables", setup_tables_query, SETUP_SQL),
        Query("sink_report_csv", sink_report_csv, month_sql("dense", "oc")),
        Query("sink_truncate_load", sink_truncate_load, _REPORT),
        Query("get_result", get_result, _REPORT),
        Query("incremental_load", incremental_load, _LOADED),
        Query("full_reload", full_reload, FULL_SQL),
        Query("stream_load", stream_load, _LOADED),
        Query("stream_merge", stream_merge, _LOADED),
    ]
