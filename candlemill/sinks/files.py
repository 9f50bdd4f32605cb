"""CSV files, append logs and versioned tables on shared storage."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlemill.session import no_rows


def write_report_csv(report: DataFrame, path: str, single: bool = True) -> None:
    """CSV with ``;`` and header. ``single`` makes one part file, for a report with a row
    per year; a report with a block per instrument keeps its parts."""
    if single:
        report = report.coalesce(1)
    report.write.mode("overwrite").csv(path, sep=";", header=True)


def append_log(
    rows: DataFrame, path: str, file_format: str = "parquet", few_files: bool = False
) -> None:
    """Add rows to a log. ``few_files`` evens out small rows at the price of a shuffle."""
    if few_files:
        rows = rows.hint("rebalance")
    rows.write.mode("append").format(file_format).save(path)


def read_log(spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet") -> DataFrame:
    """Rows appended so far; none where nothing was written yet."""
    if not exists(spark, path):
        return no_rows(spark, schema)
    return spark.read.schema(schema).format(file_format).load(path)


def _hadoop(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Empty a table kept as a folder."""
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)


class VersionedTable:
    """A table replaced as a whole: every commit is a new folder.

    Plain files have no MERGE, and a plan must not overwrite what it reads. The
    current version is the highest one whose success marker is there, so a commit
    that dies half way is never read. One writer at a time; a second one fails
    because its folder exists.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, partition_by: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_by = partition_by

    def _versions(self) -> list[int]:
        """Numbers of the version folders, complete or not, newest first."""
        fs, target = _hadoop(self.spark, self.path)
        if not fs.exists(target):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(target)]
        return sorted((int(n[1:]) for n in names if re.fullmatch(r"v\d{8}", n)), reverse=True)

    def _folder(self, number: int) -> str:
        return f"{self.path}/v{number:08d}"

    def read(self) -> DataFrame:
        for number in self._versions():
            if exists(self.spark, f"{self._folder(number)}/_SUCCESS"):
                stored = self.spark.read.schema(self.schema).parquet(self._folder(number))
                return stored.select(*self.schema.names)
        return no_rows(self.spark, self.schema)

    def commit(self, rows: DataFrame) -> int:
        """Store ``rows`` as the next version; rows may derive from :meth:`read`."""
        versions = self._versions()
        number = max(versions, default=0) + 1
        rows = rows.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        )
        if self.partition_by is None:
            writer = rows.write
        else:
            # Even file sizes: Spark splits a heavy partition value and joins light ones.
            writer = rows.hint("rebalance", self.partition_by).write.partitionBy(self.partition_by)
        writer.mode("errorifexists").parquet(self._folder(number))
        return number

    def forget(self, keep: int) -> None:
        """Remove all but the newest ``keep`` versions. Only the caller knows which of them
        readers may still hold, so no commit does this."""
        for old in self._versions()[max(1, keep) :]:
            remove(self.spark, self._folder(old))

    def reset(self) -> None:
        remove(self.spark, self.path)
