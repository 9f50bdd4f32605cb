"""Reading stored bars and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from candlemill.schemas import MONTH_BAR


def scan_staging_csv(spark: SparkSession, path: str, schema: StructType = MONTH_BAR) -> DataFrame:
    """Exported bars (``;``, one header per file) under a fixed schema."""
    return spark.read.schema(schema).csv(path, sep=";", header=True)


def stored_report(spark: SparkSession, table: str) -> DataFrame:
    """The last report as it was stored, in order, without any calculation.

    The text of the summary row sorts behind the digits of the years.
    """
    return spark.read.table(table).orderBy("year")


def stored_report_csv(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str] = ()
) -> DataFrame:
    """The last report from its CSV files, in order."""
    stored = spark.read.schema(schema).csv(path, sep=";", header=True)
    return stored.orderBy(*keys, "year")


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Options of a JDBC read. A large table is read in ranges of ``partition_column``."""
    options = {"url": url, "dbtable": table}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if partition_column is not None:
        if bounds is None:
            raise ValueError("a partition column needs its bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def scan_jdbc(spark: SparkSession, **settings) -> DataFrame:
    """Table of a database that every executor can reach."""
    return spark.read.format("jdbc").options(**jdbc_options(**settings)).load()
