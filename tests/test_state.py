"""Load metrics, repeated times in a load, and bars as the state of a stream."""

import random

import pytest

from candlemill.functions.periods import DAY
from candlemill.operators.bars import bars_by_price
from candlemill.plans.load import LoadSettings, Store, load_files
from candlemill.sources.files import list_files
from candlemill.sources.ticks import normalize_ticks, scan_ticks
from candlemill.streaming.state import STATE_STORE, day_bars, day_table, month_bars_of_days, stream_days
from tests.helpers import tick_line, write_ticks

LINES = [
    tick_line("2020-01-02 00:00:00", 5, 1), tick_line("2020-01-02 00:00:00", 4, 2), tick_line("2020-01-09 00:00:00", 9, 9),
    tick_line("2020-01-31 10:00:00", 7, 3), tick_line("2020-01-31 10:00:00", 7, 8), tick_line("2020-02-01 00:00:00", 6, 6),
]


def load(spark, folder, root, **settings):
    store = Store(spark, str(root))
    return store, load_files(store, list_files(spark, str(folder)), LoadSettings(**settings))


def stored(store):
    return [tuple(r)[:4] for r in store.bars.read().orderBy("year", "month").collect()]


def test_repeated_times_go_by_price_in_any_order(spark, tmp_path):
    for number, lines in enumerate((LINES, LINES[::-1], LINES[2:] + LINES[:2])):
        write_ticks(tmp_path / f"in{number}" / "a.csv", lines)
        store, count = load(spark, tmp_path / f"in{number}", tmp_path / f"store{number}")
        assert count == 1 and stored(store) == [(2020, 1, 4.0, 8.0), (2020, 2, 6.0, 6.0)]
        seen = store.load_metrics().first()
        assert (seen.files, seen.lines, seen.bad_lines, seen.bars, seen.tied_bars) == (1, 6, 0, 2, 1)


def test_repeated_times_may_be_refused(spark, tmp_path):
    write_ticks(tmp_path / "in" / "a.csv", LINES)
    with pytest.raises(ValueError, match="1 bars with several prices"):
        load(spark, tmp_path / "in", tmp_path / "store", ties="fail")
    assert stored(Store(spark, str(tmp_path / "store"))) == []
    # The file is unfinished, so a later load takes it.
    assert load(spark, tmp_path / "in", tmp_path / "store")[1] == 1


def test_lines_and_bad_lines_are_counted(spark, tmp_path):
    bad = ["2020-01-03 00:00:00;x;1;1;1;0", ";1;1;1;1;0", "2020-01-04 00:00:00;1;1;1;;0"]
    write_ticks(tmp_path / "in" / "a.csv", [LINES[2], *bad])
    write_ticks(tmp_path / "in" / "b.csv", [LINES[5]])
    for number, rows in enumerate(("drop", "null")):
        store, _ = load(spark, tmp_path / "in", tmp_path / f"store{number}", bad_rows=rows)
        seen = store.load_metrics().first()
        assert (seen.files, seen.lines, seen.bad_lines, seen.tied_bars) == (2, 5, 3, 0)
    assert load(spark, tmp_path / "in", tmp_path / "store0", bad_rows="drop")[1] == 0
    assert Store(spark, str(tmp_path / "store0")).load_metrics().count() == 1


def random_lines(seed, n=200):
    rng = random.Random(seed)
    return [
        tick_line(f"2020-{rng.randint(1, 3):02d}-{rng.randint(1, 28):02d} {rng.randint(0, 3):02d}:00:00", rng.randint(1, 99))
        for _ in range(n)
    ]


def run(spark, tmp_path, **options):
    query = stream_days(spark, str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "cp"), **options)
    query.awaitTermination()
    return query


def days_of(spark, tmp_path):
    return sorted(map(tuple, day_table(spark, str(tmp_path / "store")).read().collect()))


def test_state_equals_the_batch_over_a_restart(spark, tmp_path):
    before = spark.conf.get(STATE_STORE)
    for part in ((0, 1, 2), (3, 4)):
        for number in part:
            write_ticks(tmp_path / "in" / f"{number}.csv", random_lines(number))
        run(spark, tmp_path, files_per_batch=1)
    assert spark.conf.get(STATE_STORE) == before
    ticks = normalize_ticks(scan_ticks(spark, str(tmp_path / "in")))
    assert days_of(spark, tmp_path) == sorted(map(tuple, day_bars(ticks).collect()))
    months = month_bars_of_days(day_table(spark, str(tmp_path / "store")).read())
    exact = {(r.year, r.month): (r.open, r.close) for r in bars_by_price(ticks).collect()}
    assert {(r.year, r.month): (r.open, r.close) for r in months.collect()} == exact
    # Nothing new: the state is kept, and so are the bars.
    versions = day_table(spark, str(tmp_path / "store"))._versions()
    run(spark, tmp_path)
    assert day_table(spark, str(tmp_path / "store"))._versions() == versions


def test_a_late_tick_is_dropped_only_beyond_the_watermark(spark, tmp_path):
    write_ticks(tmp_path / "in" / "a.csv", [tick_line("2020-01-10 10:00:00", 5), tick_line("2020-03-01 00:00:00", 6)])
    run(spark, tmp_path, late="30 days")
    write_ticks(tmp_path / "in" / "b.csv", [tick_line("2020-03-02 00:00:00", 7)])
    run(spark, tmp_path, late="30 days")
    write_ticks(tmp_path / "in" / "c.csv", [tick_line("2020-01-10 09:00:00", 1), tick_line("2020-02-20 09:00:00", 2)])
    run(spark, tmp_path, late="30 days")
    assert [(d[0].isoformat(), d[1]) for d in days_of(spark, tmp_path)] == [
        ("2020-01-10", 5.0), ("2020-02-20", 2.0), ("2020-03-01", 6.0), ("2020-03-02", 7.0)
    ]


def test_days_of_a_table(spark, tmp_path):
    write_ticks(tmp_path / "in" / "a.csv", LINES)
    ticks = normalize_ticks(scan_ticks(spark, str(tmp_path / "in")))
    found = sorted(map(tuple, day_bars(ticks, "1 day").collect()))
    assert found == sorted(map(tuple, bars_by_price(ticks, DAY).drop("tied").collect()))
