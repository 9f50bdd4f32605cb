"""Structured Streaming forms of the incremental load.

Both end in the merge of the batch job, so a stream that has caught up holds the
same bars as one batch over all files. A replayed micro-batch merges the same bars
again, which changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from candlemill.functions.periods import MONTH
from candlemill.operators.bars import bars
from candlemill.operators.upsert import upsert_with_prev_close
from candlemill.plans.load import LoadSettings, Store, load_files
from candlemill.schemas import TICK_RAW
from candlemill.sources.files import FILE_SCHEMA, files_at
from candlemill.sources.ticks import normalize_ticks, tick_options


def _started(
    writer: DataStreamWriter, checkpoint: str, interval: str | None
) -> StreamingQuery:
    """Look for files every ``interval``; without one, take what is there now and stop."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def stream_files(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str,
    settings: LoadSettings | None = None,
    files_per_batch: int = 1000,
    interval: str | None = None,
) -> StreamingQuery:
    """Load files as they arrive, with content hash and audit as in the batch job.

    The stream carries file names; the stream source knows a file by its path, so
    the check by content stays in :func:`load_files`.
    """
    settings = settings or LoadSettings()
    names = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", settings.glob)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .select("path")
    )

    def load(batch: DataFrame, _batch_id: int) -> None:
        session = batch.sparkSession
        paths = [row.path for row in batch.collect()]
        if paths:
            load_files(Store(session, root, settings.by_instrument), files_at(session, paths), settings)

    return _started(names.writeStream.foreachBatch(load), checkpoint, interval)


def stream_ticks(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    interval: str | None = None,
) -> StreamingQuery:
    """Merge ticks straight into the bars, one merge per micro-batch, without audit.

    The kept state is the bar table: one row per month, whatever the stream's age.
    """
    ticks = normalize_ticks(
        spark.readStream.schema(TICK_RAW)
        .options(**tick_options())
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(source)
    )

    def merge(batch: DataFrame, _batch_id: int) -> None:
        stored = Store(batch.sparkSession, root).bars
        stored.commit(upsert_with_prev_close(stored.read(), bars(batch, MONTH)))

    return _started(ticks.writeStream.foreachBatch(merge), checkpoint, interval)
