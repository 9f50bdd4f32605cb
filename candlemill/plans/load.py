"""Incremental load: new files to month bars, bars to the report.

Order of writes: audit rows "started", bars, audit rows "finished", report. A run
that dies leaves its files unfinished; the next run loads them again, and merging
the same bars twice changes nothing.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlemill.functions.periods import MONTH
from candlemill.functions.rates import base_column
from candlemill.operators.audit import (
    files_to_load,
    finished_rows,
    known_files,
    known_rows,
    started_rows,
)
from candlemill.operators.bars import bars_with_marks, settled
from candlemill.operators.upsert import BAR_VALUES, upsert_with_prev_close
from candlemill.plans.flavours import FLAVOURS
from candlemill.plans.reports import growth_report
from candlemill.schemas import FILE_AUDIT, LOAD_METRICS, REPORT_AUDIT, REPORT_CELLS, TIMED_BAR
from candlemill.session import fresh_dir
from candlemill.sinks.files import (
    VersionedTable,
    append_log,
    exists,
    read_log,
    remove,
    write_report_csv,
)
from candlemill.sinks.tables import with_lineage
from candlemill.sources.files import files_at, list_files, literal_path, named, with_checksum
from candlemill.sources.tables import stored_report_csv
from candlemill.sources.ticks import (
    normalize_ticks,
    scan_ticks,
    without_time_where_incomplete,
)

INSTRUMENT = T.StructField("instrument", T.StringType())
PREV_CLOSE = T.StructField("prev_close", T.DoubleType())


@dataclass(frozen=True)
class LoadSettings:
    #: merge (edge times decide) or replace (the newer bar wins)
    upsert: str = "merge"
    #: merged or batch: which bars the previous close is looked up in
    prev_close: str = "merged"
    #: try files again whose load never finished
    retry: bool = True
    #: keep one series per instrument, named by the file name up to its first underscore
    by_instrument: bool = False
    #: fail, drop or null
    bad_rows: str = "fail"
    task_name: str = "month_growth"
    glob: str = "*.csv"
    name_pattern: str | None = None
    #: order: several prices at the first or last time of a month go by price, and are counted
    #: in the load metrics; fail: such a batch is refused
    ties: str = "order"
    #: hash files again whose path, length and modification time are in the log
    rehash: bool = False
    #: files hashed and loaded at a time
    files_per_batch: int = 1000
    #: log an unchanged report again
    audit_unchanged: bool = False
    #: file name as an expression on ``path``; its last segment where not given
    file_name: Column | None = field(default=None, compare=False)

    @property
    def keys(self) -> tuple[str, ...]:
        return ("instrument",) if self.by_instrument else ()


class Store:
    """The folders of one series: file audit, bars, bar audit, report."""

    def __init__(self, spark: SparkSession, root: str, by_instrument: bool = False):
        self.spark = spark
        self.root = root.rstrip("/")
        schema = T.StructType([*([INSTRUMENT] if by_instrument else []), *TIMED_BAR.fields, PREV_CLOSE])
        self.bars = VersionedTable(
            spark, f"{self.root}/bars", schema, partition_by="year" if by_instrument else None
        )
        self.file_audit_path = f"{self.root}/file_audit"
        self.bar_audit_path = f"{self.root}/bar_audit"
        self.metrics_path = f"{self.root}/load_metrics"
        self.report_path = f"{self.root}/report"
        self.report_audit_path = f"{self.root}/report_audit"

    def file_audit(self) -> DataFrame:
        return read_log(self.spark, self.file_audit_path, FILE_AUDIT)

    def load_metrics(self) -> DataFrame:
        return read_log(self.spark, self.metrics_path, LOAD_METRICS)

    def report_audit(self) -> DataFrame:
        return read_log(self.spark, self.report_audit_path, REPORT_AUDIT)

    def replace_by(self, other: Store) -> None:
        """Take over the bars and logs of a store that holds a full load.

        The bars come first, as one version. Where this ends half way, the old log makes
        the next load merge files again, which changes nothing.
        """
        self.bars.commit(other.bars.read())
        for path in (
            self.file_audit_path, self.bar_audit_path, self.metrics_path, self.report_path, self.report_audit_path
        ):
            remove(self.spark, path)
        append_log(other.load_metrics(), self.metrics_path, few_files=True)
        append_log(other.file_audit(), self.file_audit_path, few_files=True)
        if exists(self.spark, other.bar_audit_path):
            append_log(self.spark.read.parquet(other.bar_audit_path), self.bar_audit_path, few_files=True)


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def unseen_files(store: Store, files: DataFrame, settings: LoadSettings) -> DataFrame:
    """Files that the log does not know by path, length and modification time. No file is read."""
    listed = files.select("path", "length", "modified")
    if settings.rehash:
        return listed
    known = known_files(store.file_audit(), settings.retry)
    return listed.join(known, ["path", "length", "modified"], "left_anti")


def check_instruments(files: DataFrame, log: DataFrame, settings: LoadSettings) -> None:
    """Refuse files that would share a series they do not belong to."""
    if settings.by_instrument:
        nameless = files.filter(F.col("instrument").isNull()).select("file_name").first()
        if nameless is not None:
            raise ValueError(f"no instrument in the name of {nameless.file_name}")
        return
    both = files.select("instrument").union(log.select("instrument"))
    found = [r.instrument for r in both.dropna().distinct().orderBy("instrument").limit(2).collect()]
    if len(found) > 1:
        raise ValueError(f"several instruments ({', '.join(found)}, ...): use by_instrument or a name pattern")


def start_files(
    store: Store, files: DataFrame, settings: LoadSettings, started_at: dt.datetime, work: str
) -> DataFrame:
    """Choose the files with new content and log their start; returns them.

    Files whose content is known under another name are logged too, so that they are not
    hashed again.
    """
    spark = store.spark
    log = store.file_audit()
    # Hashing reads every byte. Its result is stored once, outside the lineage.
    named(with_checksum(files), settings.file_name).write.parquet(f"{work}/hashed")
    hashed = spark.read.parquet(f"{work}/hashed")
    about = [c for c in hashed.columns if c != "checksum"]
    one = hashed.groupBy("checksum").agg(F.min(F.struct(*about)).alias("one")).select("checksum", "one.*")
    new = files_to_load(one, log, settings.retry)
    check_instruments(new, log, settings)
    new.write.parquet(f"{work}/files")
    batch = spark.read.schema(new.schema).parquet(f"{work}/files")
    copies = hashed.join(batch.select("path"), "path", "left_anti")
    rows = started_rows(batch, started_at, settings.task_name).union(
        known_rows(copies, started_at, settings.task_name)
    )
    append_log(rows, store.file_audit_path, few_files=True)
    return batch


def bars_of_files(
    spark: SparkSession, batch: DataFrame, paths: list[str], settings: LoadSettings, work: str
) -> tuple[DataFrame, dict[str, int]]:
    """Month bars of every file, its number of lines, and what the scan saw on the way.

    Lines without a tick are counted as well: they are rows without a period. The metrics
    are observed in the scan that makes the bars: lines, lines that are no whole tick, bars,
    and bars with a choice of prices at their first or last time. Only where there are such,
    their files are read again, cut to those times, and the price decides.
    """
    scanned, made = Observation(), Observation()
    ticks = _ticks_of(spark, paths, settings, scanned)
    lines = F.count(F.lit(1)).alias("lines")
    per_file = bars_with_marks(ticks, MONTH, ["file_uri"], [lines], untimed=True)
    about = batch.select("file_uri", "checksum", "market", "instrument")
    timed = F.col("open_time").isNotNull() | F.col("close_time").isNotNull()
    joined = per_file.join(about, "file_uri").observe(
        made, F.count_if(timed).alias("bars"), F.count_if("tied").alias("tied_bars")
    )
    joined.write.parquet(f"{work}/bars")
    found = spark.read.schema(joined.schema).parquet(f"{work}/bars")
    seen = {**_observed(scanned, "lines", "bad_lines"), **_observed(made, "bars", "tied_bars")}
    if seen["tied_bars"]:
        again = [r.path for r in batch.join(found.filter("tied"), "file_uri", "left_semi").collect()]
        mended = settled(found, _ticks_of(spark, again, settings), ["file_uri"]).observe(
            exact := Observation(), F.count_if("tied").alias("tied_bars")
        )
        mended.write.parquet(f"{work}/settled")
        found = spark.read.schema(mended.schema).parquet(f"{work}/settled")
        seen |= _observed(exact, "tied_bars")
    return found, seen


def _observed(observation: Observation, *names: str) -> dict[str, int]:
    """Observed counts; zero where Spark left out the step because it had no rows."""
    try:
        found = observation.get
    except Py4JJavaError:
        found = {}
    return {name: found.get(name) or 0 for name in names}


def _ticks_of(
    spark: SparkSession, paths: list[str], settings: LoadSettings, seen: Observation | None = None
) -> DataFrame:
    """Ticks of the files at ``paths`` with the file each is from."""
    raw = scan_ticks(spark, [literal_path(p) for p in paths])
    raw = raw.withColumn("file_uri", F.col("_metadata.file_path"))
    ticks = normalize_ticks(raw, bad_rows="fail" if settings.bad_rows == "fail" else "null")
    if seen is not None:
        broken = F.col("time").isNull() | F.col("open").isNull() | F.col("close").isNull()
        ticks = ticks.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(broken).alias("bad_lines"))
    return without_time_where_incomplete(ticks) if settings.bad_rows == "drop" else ticks


def load_files(
    store: Store, files: DataFrame, settings: LoadSettings, started_at: dt.datetime | None = None
) -> int:
    """Load those of ``files`` that are new; returns how many there were.

    Files go in batches of about ``files_per_batch``, dealt by a hash of their paths. Names
    of one batch are on the driver at a time, and a failure costs one batch.
    """
    spark = store.spark
    work = fresh_dir(spark, "load")
    try:
        unseen = unseen_files(store, files, settings).select("path")
        some = [row.path for row in unseen.limit(settings.files_per_batch + 1).collect()]
        if len(some) <= settings.files_per_batch:
            if not some:
                return 0
            return _load_batch(store, files_at(spark, some), settings, started_at or now(), f"{work}/0")
        unseen.write.parquet(f"{work}/unseen")
        unseen = spark.read.schema("path string").parquet(f"{work}/unseen")
        batches = -(-unseen.count() // settings.files_per_batch)
        loaded = 0
        for number in range(batches):
            chosen = unseen.filter(F.pmod(F.xxhash64("path"), F.lit(batches)) == number)
            paths = [row.path for row in chosen.collect()]
            if paths:
                part = f"{work}/{number}"
                loaded += _load_batch(store, files_at(spark, paths), settings, started_at or now(), part)
        return loaded
    finally:
        remove(spark, work)


def _load_batch(
    store: Store, files: DataFrame, settings: LoadSettings, started_at: dt.datetime, work: str
) -> int:
    spark = store.spark
    batch = start_files(store, files, settings, started_at, work)
    paths = [row.path for row in batch.select("path").collect()]
    if not paths:
        return 0
    per_file, seen = bars_of_files(spark, batch, paths, settings, work)
    if settings.ties == "fail" and seen["tied_bars"]:
        raise ValueError(f"{seen['tied_bars']} bars with several prices at their first or last time")
    timed = per_file.filter(F.col("open_time").isNotNull() | F.col("close_time").isNotNull())
    merged = upsert_with_prev_close(
        store.bars.read(), timed, MONTH, settings.keys, settings.upsert, settings.prev_close
    )
    store.bars.commit(merged)
    audited = timed.select("instrument", "market", "checksum", *MONTH, *BAR_VALUES)
    append_log(with_lineage(audited, started_at, settings.task_name), store.bar_audit_path, few_files=True)
    lines = per_file.groupBy("checksum").agg(F.sum("lines").alias("lines"))
    started = started_rows(batch, started_at, settings.task_name)
    append_log(finished_rows(started, lines, now()), store.file_audit_path, few_files=True)
    row = (started_at, settings.task_name, len(paths), *[seen[c] for c in LOAD_METRICS.names[3:]])
    append_log(spark.createDataFrame([row], LOAD_METRICS), store.metrics_path, few_files=True)
    return len(paths)


def audit_rows(stored: DataFrame, flavour: str, mode: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Report rows in the one layout of the report audit."""
    spec = FLAVOURS[flavour]
    cells = zip(REPORT_CELLS, [*spec.months, spec.year_column])
    instrument = F.col(keys[0]) if keys else F.lit(None).cast("string")
    return stored.select(
        instrument.alias("instrument"),
        F.col("year").cast("string").alias("year"),
        *[F.col(heading).cast("double").alias(cell) for cell, heading in cells],
        F.lit(flavour).alias("flavour"),
        F.lit(mode).alias("mode"),
    )


def store_report(
    store: Store,
    report: DataFrame,
    settings: LoadSettings,
    loaded_at: dt.datetime,
    flavour: str = "dense",
    mode: str = "oc",
    changed: bool = True,
) -> DataFrame:
    """The report as CSV and its rows in the report audit; returns what was stored.

    Everything after the CSV reads it back, so the report is computed once. A report that
    has not changed is not logged again unless the settings ask for it.
    """
    write_report_csv(report, store.report_path, single=not settings.keys)
    stored = stored_report_csv(store.spark, store.report_path, report.schema, settings.keys)
    same = (F.col("flavour") == flavour) & (F.col("mode") == mode)
    if changed or settings.audit_unchanged or store.report_audit().filter(same).isEmpty():
        rows = audit_rows(stored, flavour, mode, settings.keys)
        append_log(with_lineage(rows, loaded_at, settings.task_name), store.report_audit_path)
    return stored


def run_load(
    spark: SparkSession,
    source: str,
    root: str,
    load_mode: str = "incr",
    mode: str = "oc",
    flavour: str = "dense",
    settings: LoadSettings | None = None,
) -> DataFrame:
    """Load what is new below ``source``, then the report over all stored bars.

    ``load_mode='full'`` loads everything into a store of its own, which then replaces
    this one: a bad argument or a failed load leaves what was there. Without new files
    the report is still built from the stored bars.
    """
    if load_mode not in ("incr", "full"):
        raise ValueError(f"load_mode must be incr or full, not {load_mode!r}")
    if flavour not in FLAVOURS:
        raise ValueError(f"unknown flavour {flavour!r}, expected one of {sorted(FLAVOURS)}")
    base_column(mode)
    settings = settings or LoadSettings()
    if settings.ties not in ("order", "fail"):
        raise ValueError(f"ties must be order or fail, not {settings.ties!r}")
    store = Store(spark, root, settings.by_instrument)
    files = list_files(spark, source, settings.glob, settings.name_pattern)
    loaded_at = now()
    if load_mode == "full":
        staging = Store(spark, fresh_dir(spark, "full"), settings.by_instrument)
        try:
            loaded = load_files(staging, files, settings, loaded_at)
            store.replace_by(staging)
        finally:
            remove(spark, staging.root)
    else:
        loaded = load_files(store, files, settings, loaded_at)
    if loaded == 0:
        print("no new files")
    report = growth_report(store.bars.read(), flavour, mode, settings.keys)
    changed = loaded > 0 or load_mode == "full"
    return store_report(store, report, settings, loaded_at, flavour, mode, changed)
