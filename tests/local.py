"""A local session for tests, benches and comparisons."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: str | None = None) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus or os.environ.get('BENCH_CPUS', '8')}]")
        .appName("candlemill-local")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus or "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", "file:" + tempfile.mkdtemp(prefix="candlemill-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
