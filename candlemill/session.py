"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "candlemill", **extra: str) -> SparkSession:
    """Session for the command line job. The master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_roots: dict[str, str] = {}


def work_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may do without the setting; it then gets a folder of its own
    on this machine.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = "file:" + tempfile.mkdtemp(prefix="candlemill-")
    return _local_roots[app]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has written to yet, below the work folder."""
    app = spark.sparkContext.applicationId
    return f"{work_root(spark)}/candlemill/{app}/{label}-{uuid.uuid4().hex[:12]}"


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty table that the optimizer can see through."""
    return spark.range(0).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
