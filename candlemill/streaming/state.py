"""Day bars kept as the state of a stream, and month bars rolled up from them.

Where the streams of :mod:`candlemill.streaming.load` merge each micro-batch into stored
bars, here Spark itself keeps the bars: a streaming aggregation in update mode, whose state
lies in RocksDB on the executors' disks and in the checkpoint. A micro-batch hands on only
the days it changed, whole as they are now, so writing them again changes nothing.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlemill.functions.periods import DAY, MONTH, period_columns
from candlemill.operators.bars import bars_by_price
from candlemill.operators.prev_close import with_prev_close
from candlemill.operators.upsert import combine_bars, replace_rows
from candlemill.schemas import DAY_BAR, TICK_RAW
from candlemill.sinks.files import VersionedTable
from candlemill.sources.ticks import normalize_ticks, tick_options
from candlemill.streaming.load import _started

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def day_table(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, f"{root.rstrip('/')}/day_bars", DAY_BAR)


@contextmanager
def _state_in_rocksdb(spark: SparkSession):
    """A query keeps the store it starts with; the session gets its own back."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


def _in_utc(time: str) -> Column:
    """A zone-free time as the instant at which clocks in UTC show it: watermarks need one."""
    t = F.col(time)
    parts = (F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.date_part(F.lit("SECOND"), t))
    return F.make_timestamp(*parts, F.lit("UTC"))


def day_bars(ticks: DataFrame, late: str | None = None) -> DataFrame:
    """Day bars of ticks, of a stream or not: day, open, close, open_time, close_time.

    Several prices at one time go by price, so neither the order of rows nor that of files
    changes a bar. With ``late`` (an interval) a stream forgets the days that end so long
    before the newest tick, and drops ticks that come for them afterwards; without it all
    days stay in the state, one row each.
    """
    if late is None:
        return bars_by_price(ticks, DAY).select(*DAY_BAR.names)
    ticks = ticks.withColumn("_instant", _in_utc("time")).withWatermark("_instant", late)
    ticks = ticks.withColumn("_window", F.window("_instant", "1 day"))
    return bars_by_price(ticks, DAY, ["_window"]).select(*DAY_BAR.names)


def stream_days(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    interval: str | None = None,
    late: str | None = None,
) -> StreamingQuery:
    """Keep the day bars of all tick files below ``source`` as they arrive.

    A query that is started again goes on from its checkpoint with the state it had. The
    checkpoint and ``root`` belong together: a lost checkpoint means both anew.
    """
    raw = (
        spark.readStream.schema(TICK_RAW)
        .options(**tick_options())
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(source)
    )

    def keep(batch: DataFrame, _batch_id: int) -> None:
        stored = day_table(batch.sparkSession, root)
        stored.commit(replace_rows(stored.read(), batch, DAY))

    changed = day_bars(normalize_ticks(raw), late)
    with _state_in_rocksdb(spark):
        return _started(changed.writeStream.outputMode("update").foreachBatch(keep), checkpoint, interval)


def month_bars_of_days(days: DataFrame) -> DataFrame:
    """Month bars, previous close included, from day bars: at most 31 rows a month."""
    months = days.withColumns(period_columns(F.col("day"), MONTH))
    return with_prev_close(combine_bars(months, MONTH))
