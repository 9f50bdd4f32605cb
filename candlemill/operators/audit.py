"""File audit as a log of events. A file's state is derived, never updated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlemill.functions.parsing import stamp
from candlemill.schemas import FILE_AUDIT

STARTED = "started"
FINISHED = "finished"
#: a file that holds the content of another one
KNOWN = "known"
_FILE = ["instrument", "path", "length", "modified"]


def started_rows(files: DataFrame, started_at, task_name: str) -> DataFrame:
    """Log rows for a manifest whose load begins."""
    return files.select(
        "checksum",
        "file_name",
        "market",
        F.lit(task_name).alias("task_name"),
        F.lit(STARTED).alias("event"),
        stamp(started_at).alias("event_timestamp"),
        stamp(started_at).alias("start_timestamp"),
        F.lit(None).cast("long").alias("lines"),
        *_file_columns(files),
    )


def _file_columns(files: DataFrame):
    """What tells a file without reading it, as far as ``files`` has it."""
    return [
        (F.col(f.name) if f.name in files.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in FILE_AUDIT.fields
        if f.name in _FILE
    ]


def known_rows(files: DataFrame, seen_at, task_name: str) -> DataFrame:
    """Log rows for files that were hashed and hold content of the log."""
    rows = started_rows(files, seen_at, task_name).withColumn("event", F.lit(KNOWN))
    return rows.withColumn("start_timestamp", F.lit(None).cast("timestamp_ntz"))


def known_files(log: DataFrame, retry: bool = True) -> DataFrame:
    """Files by path, length and modification time whose content needs no second look."""
    events = [FINISHED, KNOWN] + ([] if retry else [STARTED])
    rows = log.filter(F.col("event").isin(events) & F.col("path").isNotNull())
    return rows.select("path", "length", "modified").distinct()


def finished_rows(started: DataFrame, lines: DataFrame, finished_at) -> DataFrame:
    """Log rows that close ``started`` ones; ``lines`` has checksum and lines."""
    return (
        started.drop("lines")
        .join(lines.select("checksum", "lines"), "checksum", "left")
        .withColumn("lines", F.coalesce("lines", F.lit(0).cast("long")))
        .withColumn("event", F.lit(FINISHED))
        .withColumn("event_timestamp", stamp(finished_at))
        .select(*FILE_AUDIT.names)
    )


def audit_state(log: DataFrame) -> DataFrame:
    """Latest load of each checksum: when it started, when it ended (or NULL)."""
    ended = F.when(F.col("event") == FINISHED, F.col("event_timestamp"))
    loads = log.filter(F.col("event") != KNOWN).groupBy("checksum", "start_timestamp").agg(
        F.max("file_name").alias("file_name"),
        F.max("market").alias("market"),
        F.max("task_name").alias("task_name"),
        F.max("lines").alias("lines"),
        F.max(ended).alias("end_timestamp"),
    )
    latest = F.max_by(F.struct("*"), F.col("start_timestamp")).alias("latest")
    return loads.groupBy("checksum").agg(latest).select("latest.*")


def finished_checksums(log: DataFrame) -> DataFrame:
    return audit_state(log).filter(F.col("end_timestamp").isNotNull()).select("checksum")


def files_to_load(manifest: DataFrame, log: DataFrame, retry: bool = True) -> DataFrame:
    """Files whose content has not been loaded.

    A load that was started and never finished is tried again, unless ``retry`` is
    off: then any known checksum is left out.
    """
    known = finished_checksums(log) if retry else log.select("checksum").distinct()
    return manifest.join(known, "checksum", "left_anti")


def times_seen(log: DataFrame, checksum: str) -> DataFrame:
    """COUNT(*) for one checksum; the filter reaches the file scan."""
    return log.filter(F.col("checksum") == checksum).agg(F.count(F.lit(1)).alias("rows"))
