"""Command line: ``python -m candlemill --source DIR --store DIR``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.functions.periods import DAY
from candlemill.operators.bars import bars
from candlemill.operators.upsert import combine_bars
from candlemill.plans.flavours import FLAVOURS
from candlemill.plans.load import LoadSettings, Store, check_instruments, run_load
from candlemill.plans.reports import week_report
from candlemill.sinks.tables import setup_tables
from candlemill.sources.files import list_files, named
from candlemill.sources.ticks import normalize_ticks, scan_ticks


def parser() -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(prog="candlemill", description="Growth rate by month or weekday")
    args.add_argument("--source", help="folder with tick files")
    args.add_argument("--store", required=True, help="folder of bars, audit and report")
    args.add_argument("--calculation-mode", choices=["oc", "cc"], default="oc")
    args.add_argument("--load-mode", choices=["incr", "full"], default="incr")
    args.add_argument("--time-mode", choices=["month", "week"], default="month")
    args.add_argument("--flavour", choices=sorted(FLAVOURS), default="dense")
    args.add_argument("--name-pattern", help="regex on the file name, such as XAUUSD_10.*Ask")
    args.add_argument("--by-instrument", action="store_true", help="one series per instrument")
    args.add_argument("--glob", default="*.csv", help="which files")
    args.add_argument("--bad-rows", choices=["fail", "drop", "null"], default="fail")
    args.add_argument("--ties", choices=["order", "fail"], default="order")
    args.add_argument("--upsert", choices=["merge", "replace"], default="merge")
    args.add_argument("--prev-close", choices=["merged", "batch"], default="merged")
    args.add_argument("--no-retry", action="store_true", help="leave files that never finished")
    args.add_argument("--rehash", action="store_true", help="hash known files again")
    args.add_argument("--files-per-batch", type=int, default=1000)
    args.add_argument("--setup-db", metavar="DATABASE", help="create the tables and stop")
    args.add_argument("--get-result", action="store_true", help="show the stored report and stop")
    args.add_argument("--show", type=int, default=100, help="rows printed")
    return args


def week_job(
    spark: SparkSession,
    source: str,
    mode: str = "oc",
    settings: LoadSettings = LoadSettings(),
) -> DataFrame:
    """Weekday report over all tick files. No bars by day are kept between runs."""
    files = list_files(spark, source, settings.glob, settings.name_pattern)
    files = named(files.drop("content"))
    if files.isEmpty():
        raise FileNotFoundError(f"no tick files below {source}")
    check_instruments(files, files, settings)
    # The scan looks for the files itself; their names do not pass through the driver.
    raw = scan_ticks(spark, source, options={"pathGlobFilter": settings.glob, "recursiveFileLookup": "true"})
    raw = raw.withColumn("file_uri", F.col("_metadata.file_path"))
    ticks = normalize_ticks(raw, bad_rows=settings.bad_rows)
    about = files.select("file_uri", "instrument")
    per_file = bars(ticks, DAY, ["file_uri"]).join(about, "file_uri")
    keys = list(settings.keys)
    return week_report(combine_bars(per_file, DAY, keys), mode, keys)


def run(spark: SparkSession, argv: list[str] | None = None) -> DataFrame | None:
    args = parser().parse_args(argv)
    settings = LoadSettings(
        upsert=args.upsert,
        prev_close=args.prev_close,
        retry=not args.no_retry,
        by_instrument=args.by_instrument,
        bad_rows=args.bad_rows,
        ties=args.ties,
        glob=args.glob,
        name_pattern=args.name_pattern,
        rehash=args.rehash,
        files_per_batch=args.files_per_batch,
    )
    if args.setup_db:
        setup_tables(spark, args.setup_db, f"{args.store.rstrip('/')}/{args.setup_db}")
        return None
    if args.get_result:
        report = spark.read.csv(Store(spark, args.store).report_path, sep=";", header=True)
        report = report.orderBy(*report.columns[: report.columns.index("year") + 1])
    elif args.source is None:
        raise SystemExit("--source is needed to calculate")
    elif args.time_mode == "week":
        if args.load_mode != "incr" or args.flavour != "dense":
            raise SystemExit("--load-mode and --flavour do not go with --time-mode week")
        report = week_job(spark, args.source, args.calculation_mode, settings)
    else:
        report = run_load(
            spark,
            args.source,
            args.store,
            args.load_mode,
            args.calculation_mode,
            args.flavour,
            settings,
        )
    report.show(args.show, truncate=False)
    return report
