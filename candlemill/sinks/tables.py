"""Catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.functions.parsing import stamp
from candlemill.schemas import MONTHS_SHORT

_CELLS = ", ".join(f"{m} DOUBLE" for m in MONTHS_SHORT)

# Name of a table -> its columns. Keys are kept unique by the upserts.
TABLES = {
    "file_audit": "checksum STRING, file_name STRING, market STRING, task_name STRING, event STRING, "
    "event_timestamp TIMESTAMP_NTZ, start_timestamp TIMESTAMP_NTZ, lines BIGINT",
    "bar_staging": "year INT, month INT, open DOUBLE, close DOUBLE, open_time TIMESTAMP_NTZ, "
    "close_time TIMESTAMP_NTZ, prev_close DOUBLE",
    "bar_audit": "year INT, month INT, open DOUBLE, close DOUBLE, open_time TIMESTAMP_NTZ, "
    "close_time TIMESTAMP_NTZ, load_timestamp TIMESTAMP_NTZ, task_name STRING",
    "report": f"year STRING, {_CELLS}, total DOUBLE",
    "report_audit": f"year STRING, {_CELLS}, total DOUBLE, load_timestamp TIMESTAMP_NTZ, task_name STRING",
}


def setup_tables(spark: SparkSession, database: str, location: str) -> None:
    """Create database and tables where they are not there yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name, columns in TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet")


def truncate_tables(spark: SparkSession, database: str) -> None:
    """Empty every table, as a full reload does first."""
    for name in TABLES:
        spark.sql(f"TRUNCATE TABLE {database}.{name}")


def insert_rows(rows: DataFrame, table: str) -> None:
    """INSERT INTO ... SELECT, columns matched by name."""
    names = rows.sparkSession.table(table).columns
    rows.select(*names).write.insertInto(table)


def truncate_and_load(rows: DataFrame, table: str) -> None:
    """Replace the content of a table; ``rows`` must not read from it."""
    names = rows.sparkSession.table(table).columns
    rows.select(*names).write.insertInto(table, overwrite=True)


def with_lineage(rows: DataFrame, loaded_at, task_name: str) -> DataFrame:
    """Rows of an audit table: when they were loaded and by what."""
    return rows.withColumns(
        {"load_timestamp": stamp(loaded_at), "task_name": F.lit(task_name)}
    )


def write_jdbc(rows: DataFrame, url: str, table: str, truncate: bool = True, **properties: str) -> None:
    """Replace (keeping its definition) or extend a database table."""
    writer = rows.write.format("jdbc").option("url", url).option("dbtable", table)
    writer = writer.options(**properties)
    if truncate:
        writer.mode("overwrite").option("truncate", "true").save()
    else:
        writer.mode("append").save()
