"""The reports as SQL programs, in both modes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlemill.plans.procedures import etl_program, month_growth_program
from candlemill.registry.base import Query, rounded
from candlemill.registry.files import _database
from candlemill.registry.reports import MODES, lineitem_bars, month_sql
from candlemill.session import fresh_dir


def _both(reports: list[DataFrame]) -> DataFrame:
    marked = [rounded(report).withColumn("mode", F.lit(mode)) for report, mode in zip(reports, MODES)]
    return reduce(DataFrame.union, marked)


def procedure_month_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = lineitem_bars(spark, sf_dir)
    return _both([month_growth_program(spark, bars, mode) for mode in MODES])


def procedure_hive_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = lineitem_bars(spark, sf_dir)
    reports = []
    for mode in MODES:
        database = _database(spark, f"etl_{mode}")
        location = fresh_dir(spark, f"etl-{mode}")
        report = etl_program(spark, bars, database, location, mode)
        reports.append(report.toDF(*[c.lower() for c in report.columns]))
    return _both(reports)


def _both_sql(flavour: str) -> str:
    return " UNION ALL ".join(f"SELECT *, '{mode}' AS mode FROM ({month_sql(flavour, mode)})" for mode in MODES)


def program_queries() -> list[Query]:
    return [
        Query("procedure_month_growth", procedure_month_growth, _both_sql("mysql")),
        Query("procedure_hive_etl", procedure_hive_etl, _both_sql("hive")),
    ]
