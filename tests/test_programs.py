"""The reports as SQL programs."""

import pytest

from candlemill.plans import procedures as P
from candlemill.plans.reports import growth_report
from tests.helpers import at

BARS = [
    (2019, 12, 90.0, 91.0), (2020, 1, 100.0, 101.5), (2020, 2, 0.0, 3.0), (2020, 4, 102.0, 99.25), (2021, 1, 99.0, 120.0),
] + [(2022, m, 100.0 + m, 101.25 + m) for m in range(1, 13)]


@pytest.fixture
def bars(spark):
    rows = [(y, m, o, c, at(f"{y}-{m:02d}-01"), at(f"{y}-{m:02d}-28")) for y, m, o, c in BARS]
    return spark.createDataFrame(
        rows, "year int, month int, open double, close double, open_time timestamp_ntz, close_time timestamp_ntz"
    )


def cells(report):
    return sorted(
        tuple(round(x, 6) if isinstance(x, float) else x for x in row) for row in map(tuple, report.collect())
    )


def prev(bars):
    from candlemill.operators.prev_close import with_prev_close

    return with_prev_close(bars)


@pytest.mark.parametrize("mode", ["oc", "cc"])
def test_month_report_of_a_procedure(spark, bars, mode):
    found = P.month_growth_program(spark, bars, mode)
    expected = growth_report(prev(bars), "mysql", mode)
    assert found.columns == expected.columns and cells(found) == cells(expected)
    assert not spark.catalog.tableExists(P.BARS)


@pytest.mark.parametrize("mode", ["oc", "cc"])
def test_report_through_tables(spark, tmp_path, bars, mode):
    database = f"candlemill_programs_{mode}"
    found = P.etl_program(spark, bars, database, f"file:{tmp_path}/db", mode)
    expected = cells(growth_report(prev(bars), "hive", mode))
    assert cells(found) == expected
    assert spark.table(f"{database}.bar_staging").count() == len(BARS)
    # A second run replaces what the first one wrote.
    assert cells(P.etl_program(spark, bars, database, f"file:{tmp_path}/db", mode)) == expected
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_mode_is_a_setting_of_the_session(spark, bars):
    P.define(spark, bars)
    try:
        first = cells(P.call_month_growth(spark))
        assert first == cells(growth_report(prev(bars), "mysql", "oc"))
        spark.sql(f"SET VAR {P.MODE} = 'cc'")
        assert cells(P.call_month_growth(spark)) == cells(growth_report(prev(bars), "mysql", "cc"))
        for bad in ("x' OR 1 = 1 --", "OC"):
            with pytest.raises(Exception, match="unknown mode"):
                P.call_month_growth(spark, bad).collect()
        spark.sql(f"SET VAR {P.MODE} = NULL")
        with pytest.raises(Exception, match="unknown mode"):
            P.call_month_growth(spark).collect()
    finally:
        P.drop(spark)


def test_no_bars(spark, bars):
    nothing = bars.where("false")
    expected = growth_report(prev(nothing), "mysql", "oc").collect()
    assert P.month_growth_program(spark, nothing, "oc").collect() == expected
