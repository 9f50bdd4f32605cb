"""Reading, shared tables and size-checked joins for the operators of this package."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import candlemill
from candlemill.session import fresh_dir

# A list of ids is broadcast up to this many; a shuffle join does the same work beyond it.
BROADCAST_IDS = 1_000_000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application, as --py-files would."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        root = Path(candlemill.__file__).parent.parent
        folder = tempfile.mkdtemp(prefix="candlemill-")
        archive = shutil.make_archive(f"{folder}/candlemill", "zip", root, "candlemill")
        spark.sparkContext.addPyFile(archive)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Paths written within each open ``work_tables``, the innermost last.
_open: list[list[str]] = []


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end, also after an error, what ``saved`` wrote within it.

    What is still read later is written with ``outlives``; it then belongs to the next
    ``work_tables`` around, or stays.
    """
    _open.append([])
    try:
        yield
    finally:
        context = spark.sparkContext
        for path in _open.pop():
            at = context._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def saved(df: DataFrame, label: str, outlives: bool = False) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back.

    Later steps read files that every executor can reach instead of repeating the work,
    and a lost executor loses nothing of them. The query's shuffle files go when it ends,
    not when the driver next collects its garbage.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    scopes = _open[:-1] if outlives else _open
    if scopes:
        scopes[-1].append(path)
    # What the query shuffled is of no use once its result is written.
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def semi_join(rows: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``ids`` (one column, distinct, already saved).

    The ids are counted first: a list within BROADCAST_IDS is broadcast, so that the rows,
    which may carry whole texts, are not shuffled; a longer one is joined by shuffle.
    """
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return rows.join(ids, key, "left_semi")


def crc_of_id(column: str = "doc_id"):
    """crc32 of the id written as text, the number that deals documents into folds."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
