import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from candlemill.functions.periods import DAY, MONTH
from candlemill.operators import bars as B
from candlemill.operators.prev_close import with_prev_close
from tests.helpers import TICK, plain_bars, ticks_frame


def month_of(t):
    return (t.year, t.month)


def random_ticks(seed, ties):
    """One month holds most of the rows; with ``ties`` many share a day's midnight."""
    rng = random.Random(seed)
    rows = []
    for key in range(1500):
        month = 3 if rng.random() < 0.7 else rng.choice([1, 2, 7, 12])
        day = rng.randint(1, 28)
        time = dt.datetime(2019 + rng.randint(0, 1), month, day)
        if not ties:
            time += dt.timedelta(seconds=key)
        rows.append((time, rng.uniform(1, 9), rng.uniform(1, 9), key))
    return rows


@pytest.mark.parametrize("ties", [False, True])
def test_all_forms_agree_with_plain_python(spark, ties):
    rows = random_ticks(7, ties)
    ticks = spark.createDataFrame(rows, TICK).repartition(6)
    tie = ["key"] if ties else []
    expected = plain_bars(rows, month_of)
    pairs = {name: values[:2] for name, values in expected.items()}

    whole = {(r.year, r.month): tuple(r)[2:] for r in B.bars(ticks, MONTH, tie=tie).collect()}
    assert whole == expected
    joined = {(r.year, r.month): tuple(r)[2:] for r in B.bars_by_join(ticks, MONTH, tie).collect()}
    assert joined == expected
    for df in (B.month_bars_by_window(ticks, tie=tie), B.month_bars_by_sql(ticks, tie=tie)):
        assert {(r.year, r.month): (r.open, r.close) for r in df.collect()} == pairs
        assert df.count() == len(pairs)
    last = {(r.year, r.month): r.close for r in B.last_ticks(ticks, MONTH, tie).collect()}
    assert last == {name: close for name, (_, close) in pairs.items()}
    edges = B.edge_ticks(ticks, MONTH, tie).collect()
    assert len(edges) == 2 * len(pairs)


def test_bars_per_key_match_bars_of_each_key(spark):
    rows = random_ticks(3, True)
    ticks = spark.createDataFrame(rows, TICK).withColumn("name", F.col("key") % 3)
    both = B.bars(ticks, DAY, keys=["name"], tie=["key"])
    for name in range(3):
        mine = [r for r in rows if r[3] % 3 == name]
        expected = plain_bars(mine, lambda t: t.date())
        found = {r.day: (r.open, r.close, r.open_time, r.close_time) for r in both.filter(F.col("name") == name).collect()}
        assert found == expected


def test_last_days_of_december_stay_in_their_year(spark):
    rows = [("2012-12-29 00:00:00", 1, 1), ("2012-12-31 23:59:50", 2, 3), ("2013-01-01 00:00:00", 4, 5)]
    found = {(r.year, r.month): (r.open, r.close) for r in B.bars(ticks_frame(spark, rows)).collect()}
    assert found == {(2012, 12): (1.0, 3.0), (2013, 1): (4.0, 5.0)}


def test_rows_without_time_are_left_out(spark):
    ticks = spark.createDataFrame([(None, 1.0, 1.0, 0), (dt.datetime(2020, 1, 1), 2.0, 2.0, 1)], TICK)
    named = ticks.withColumn("name", F.lit("x"))
    for found in (
        B.bars(ticks), B.bars(ticks, tie=["key"]), B.bars(ticks, tie=["key", "open"]), B.bars_by_join(ticks),
        B.bars(named, keys=["name"], tie=["key"]).drop("name"),
    ):
        assert [tuple(r)[:4] for r in found.collect()] == [(2020, 1, 2.0, 2.0)]
    assert B.period_bounds(ticks).count() == B.last_ticks(ticks).count() == 1


def test_prev_close_skips_absent_months_and_starts_with_own_open(spark):
    rows = [("2020-01-05", 10, 11), ("2020-04-05", 12, 13), ("2021-01-01", 14, 15)]
    bars = with_prev_close(B.bars(ticks_frame(spark, rows)))
    assert [(r.month, r.prev_close) for r in bars.orderBy("year", "month").collect()] == [
        (1, 10.0), (4, 11.0), (1, 13.0)
    ]


def test_repeated_times_are_reported(spark):
    rows = [("2020-01-05", 1, 1), ("2020-01-05", 2, 2), ("2020-01-06", 3, 3)]
    assert [(r.time.day, r.rows) for r in B.repeated_times(ticks_frame(spark, rows)).collect()] == [(5, 2)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unique_times_need_no_sort(spark):
    plan = plan_of(B.bars(ticks_frame(spark, [("2020-01-05", 1, 1)])))
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Join" not in plan
    assert plan.count("Exchange") == 1


def test_ties_are_cut_to_the_edges_first(spark):
    ticks = ticks_frame(spark, [("2020-01-05", 1, 1, 1)])
    assert "BroadcastHashJoin [time" in plan_of(B.bars(ticks, tie=["key"]))
    assert "LeftSemi" in plan_of(B.bars(ticks, tie=["key"]))
    assert "LeftSemi" in plan_of(B.bars(ticks, keys=["open"], tie=["key"]))


def test_packed_ties_take_one_scan_and_no_sort(spark):
    ticks = ticks_frame(spark, [("2020-01-05", 1, 1, 1)])
    for found in (B.bars(ticks, tie={"key": 9}), B.bars(ticks, DAY, ["open"], {"key": 25}), B.last_ticks(ticks, tie={"key": 9})):
        plan = plan_of(found)
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "Join" not in plan


@pytest.mark.parametrize("digits", [5, 18, 25])
def test_packed_ties_agree_with_plain_python(spark, digits):
    rows = random_ticks(11, True)
    rows += [(t + dt.timedelta(microseconds=n % 3), *p, k + 2000) for n, (t, *p, k) in enumerate(rows[:300])]
    ticks = spark.createDataFrame(rows, TICK).withColumn("name", F.col("key") % 2).repartition(5)
    tie = {"key": digits}
    found = {(r.year, r.month): tuple(r)[2:] for r in B.bars(ticks, MONTH, tie=tie).collect()}
    assert found == plain_bars(rows, month_of)
    days = {r.day: tuple(r)[1:] for r in B.bars(ticks, DAY, tie=tie).collect()}
    assert days == plain_bars(rows, lambda t: t.date())
    for name in (0, 1):
        mine = [r for r in rows if r[3] % 2 == name]
        keyed = B.bars(ticks, MONTH, ["name"], tie).filter(F.col("name") == name).drop("name").collect()
        assert {(r.year, r.month): tuple(r)[2:] for r in keyed} == plain_bars(mine, month_of)
    last = {(r.year, r.month): (r.time, r.key, r.open, r.close) for r in B.last_ticks(ticks, MONTH, tie).collect()}
    for month, (time, key, open_, close) in last.items():
        best = max((r for r in rows if month_of(r[0]) == month), key=lambda r: (r[0], r[3]))
        assert (time, open_, close, key) == best


def test_packed_ties_that_do_not_fit_are_refused(spark):
    with pytest.raises(ValueError):
        B.bars(ticks_frame(spark, [("2020-01-05", 1, 1)]), tie={"key": 26})
    with pytest.raises(ValueError):
        B.bars(ticks_frame(spark, [("2020-01-05", 1, 1)]), period=("year",), tie={"key": 2})
    for key in (100, -1, None):
        with pytest.raises(Exception, match="does not fit 2 digits"):
            B.bars(ticks_frame(spark, [("2020-01-05", 1, 1, key)]), tie={"key": 2}).collect()


def test_order_by_time_then_price_does_not_depend_on_the_rows(spark):
    rows = [
        ("2020-01-05 00:00:00", 2.5, 1), ("2020-01-05 00:00:00", 1.25, 9), ("2020-01-06 01:02:03.000004", 7, 3),
        ("2020-01-06 01:02:03.000004", 8, -4.5), ("2020-02-01", 5, 5), ("2020-02-01", 5, 5), ("2020-03-01", 1, 1),
    ]
    expected = {1: (1.25, 3.0, True), 2: (5.0, 5.0, False), 3: (1.0, 1.0, False)}
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        found = B.bars_by_price(ticks_frame(spark, order).repartition(3))
        assert {r.month: (r.open, r.close, r.tied) for r in found.collect()} == expected
    missing = spark.createDataFrame([(None, 1.0, 1.0, 0), (dt.datetime(2020, 1, 1), None, 2.0, 0)], TICK)
    assert [tuple(r) for r in B.bars_by_price(missing).collect()] == [(2020, 1, None, 2.0, None, dt.datetime(2020, 1, 1), False)]


@pytest.mark.parametrize("period", [MONTH, DAY])
def test_marks_tell_edges_with_several_prices(spark, period):
    rows = random_ticks(5, True) + random_ticks(6, False)
    ticks = spark.createDataFrame(rows, TICK).withColumn("name", F.col("key") % 4).repartition(5)
    exact = B.bars_by_price(ticks, period, ["name"])
    found = B.bars_with_marks(ticks, period, ["name"])
    plan = plan_of(found)
    assert "SortAggregate" not in plan and plan.count("Exchange") <= 2
    on = ["name", *period]
    tied = {tuple(r) for r in found.filter("tied").select(*on).collect()}
    assert tied == {tuple(r) for r in exact.filter("tied").select(*on).collect()} and tied
    columns = [*on, "open", "close", "open_time", "close_time", "tied"]
    mended = B.settled(found, ticks, ["name"], period).select(*columns)
    assert sorted(mended.collect()) == sorted(exact.select(*columns).collect())


def test_row_number_is_limited_before_the_shuffle(spark):
    plan = plan_of(B.last_ticks(ticks_frame(spark, [("2020-01-05", 1, 1, 1)]), MONTH, ["key"]))
    assert "row_number(), 1, Partial" in plan


def test_bounds_read_the_time_column_only(spark, tmp_path):
    path = str(tmp_path / "t")
    ticks_frame(spark, [("2020-01-05", 1, 1)]).write.parquet(path)
    plan = plan_of(B.period_bounds(spark.read.parquet(path)))
    assert "ReadSchema: struct<time:timestamp_ntz>" in plan
