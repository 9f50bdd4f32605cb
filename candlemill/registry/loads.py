"""What a load sees in its files, their hashes by pieces, and bars that a stream keeps as state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.functions.parsing import comma_text
from candlemill.functions.periods import MONTH
from candlemill.plans.load import LoadSettings, Store, load_files
from candlemill.registry.base import Query, rounded
from candlemill.registry.files import _BAR_COLUMNS, _LOADED, SPLIT_DAY
from candlemill.registry.tables import event_ticks
from candlemill.schemas import TICK_HEADER
from candlemill.session import fresh_dir
from candlemill.sources.files import list_files, with_tree_checksum
from candlemill.streaming.state import day_table, month_bars_of_days, stream_days


def write_tick_files(ticks: DataFrame, path: str) -> str:
    """Ticks (time, open, close as text) as raw tick files, one folder for each ``source``."""
    cells = ["time", "open", "open", "open", "close", F.lit("0")]
    named = [(F.col(c) if isinstance(c, str) else c).alias(h) for c, h in zip(cells, TICK_HEADER)]
    writer = ticks.select(*named, "source").hint("rebalance", "source").write.mode("append")
    writer.partitionBy("source").options(sep=";", header=True, ignoreTrailingWhiteSpace=False).csv(path)
    return path


def _texts(ticks: DataFrame) -> DataFrame:
    day = F.date_format("time", "yyyy.MM.dd")
    time = F.date_format("time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    price = comma_text(F.col("open"))
    return ticks.select(time.alias("time"), price.alias("open"), price.alias("close"), day.alias("source"), "event_id")


def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load of all events by the hour, so that times repeat, some lines without a cell."""
    ticks = event_ticks(spark, sf_dir)
    ticks = ticks.withColumn("time", F.date_trunc("hour", "time").cast("timestamp_ntz"))
    lines = _texts(ticks)
    blank = {"time": 13, "open": 7}
    lines = lines.withColumns({c: F.when(F.col("event_id") % n != 0, F.col(c)) for c, n in blank.items()})
    source = write_tick_files(lines, fresh_dir(spark, "hours"))
    store = Store(spark, fresh_dir(spark, "store"))
    path = F.regexp_extract("path", r"source=([^/]+)", 1)
    load_files(store, list_files(spark, source), LoadSettings(bad_rows="drop", file_name=path))
    return store.load_metrics().drop("started_at", "task_name")


METRICS_SQL = """WITH lines AS (
    SELECT event_id, date_trunc('hour', ts) AS time, round(value, 2) AS price, CAST(ts AS DATE) AS day FROM events),
good AS (SELECT * FROM lines WHERE event_id % 13 <> 0 AND event_id % 7 <> 0),
edges AS (SELECT day, min(time) AS first_time, max(time) AS last_time FROM good GROUP BY day),
ends AS (
    SELECT day, count(DISTINCT CASE WHEN time = first_time THEN price END) AS opens,
        count(DISTINCT CASE WHEN time = last_time THEN price END) AS closes
    FROM good JOIN edges USING (day) GROUP BY day)
SELECT (SELECT count(DISTINCT day) FROM lines) AS files, (SELECT count(*) FROM lines) AS lines,
    (SELECT count(*) FROM lines WHERE event_id % 13 = 0 OR event_id % 7 = 0) AS bad_lines,
    (SELECT count(*) FROM edges) AS bars,
    (SELECT count(*) FROM ends WHERE opens > 1 OR closes > 1) AS tied_bars"""


def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month bars of a stream that sees the later days first and is started a second time."""
    root = fresh_dir(spark, "state")
    lines = _texts(event_ticks(spark, sf_dir))
    later = F.col("source") >= SPLIT_DAY.replace("-", ".")
    for part in (later, ~later):
        source = write_tick_files(lines.filter(part), f"{root}/ticks")
        query = stream_days(spark, source, root, f"{root}/checkpoint", files_per_batch=10, late="3650 days")
        query.awaitTermination()
    months = month_bars_of_days(day_table(spark, root).read())
    return rounded(months.select(*_BAR_COLUMNS))


_TREE_PIECE = 100


def file_tree_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one text file a day, in the order of their ids, and the hash of each."""
    cells = ["event_id", "user_id", "event_type", "props"]
    lines = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat_ws(";", *[F.col(c).cast("string") for c in cells]).alias("value"),
        F.date_format("ts", "yyyy.MM.dd").alias("day"),
        "event_id",
    )
    path = fresh_dir(spark, "days")
    lines = lines.repartition("day").sortWithinPartitions("day", "event_id").drop("event_id")
    lines.write.partitionBy("day").text(path)
    found = with_tree_checksum(spark, path, "*.txt", _TREE_PIECE)
    day = F.regexp_extract("path", r"day=([^/]+)", 1)
    return found.select(day.alias("day"), "length", "lines", "tree_checksum")


TREE_SQL = f"""WITH numbered AS (
    SELECT strftime(ts, '%Y.%m.%d') AS day, concat_ws(';', event_id, user_id, event_type, props) AS line,
        row_number() OVER (PARTITION BY strftime(ts, '%Y.%m.%d') ORDER BY event_id) - 1 AS n FROM events),
pieces AS (
    SELECT day, n // {_TREE_PIECE} AS piece, count(*) AS lines, sum(strlen(line) + 1) AS length,
        sha256(unhex(string_agg(sha256(line), '' ORDER BY n))) AS digest
    FROM numbered GROUP BY ALL),
files AS (
    SELECT day, CAST(sum(lines) AS BIGINT) AS lines, CAST(sum(length) AS BIGINT) AS length,
        string_agg(digest, '' ORDER BY piece) AS digests FROM pieces GROUP BY day)
SELECT day, length, lines, sha256('tree:{_TREE_PIECE}:' || length || ':' || lines || ':' || digests) AS tree_checksum
FROM files"""


def load_queries() -> list[Query]:
    return [
        Query("file_tree_hash", file_tree_hash, TREE_SQL),
        Query("load_metrics", load_metrics, METRICS_SQL),
        Query("stream_state", stream_state, _LOADED),
    ]
