import itertools
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from candlemill.functions.periods import DAY, MONTH
from candlemill.operators.audit import (
    audit_state,
    files_to_load,
    finished_rows,
    started_rows,
    times_seen,
)
from candlemill.operators.bars import bars
from candlemill.operators.prev_close import with_prev_close
from candlemill.operators.upsert import merge_bars, upsert_with_prev_close
from candlemill.operators.watermark import NEVER, high_watermark, rows_since, stamped
from candlemill.plans import load as load_plan
from candlemill.plans.jobs import run
from candlemill.plans.load import LoadSettings, Store, load_files, run_load, start_files
from candlemill.plans.reports import growth_report, week_report
from candlemill.schemas import FILE_AUDIT, TIMED_BAR
from candlemill.session import work_root
from candlemill.sinks.files import VersionedTable
from candlemill.sinks.tables import TABLES, insert_rows, setup_tables, truncate_and_load, truncate_tables
from candlemill.sources.files import list_files
from candlemill.streaming.load import stream_files, stream_ticks
from tests.helpers import at, tick_line, ticks_frame, write_ticks

TICKS = [
    ("2019-12-30 10:00:00", 90, 91), ("2020-01-02 00:00:00", 100, 101), ("2020-01-20 00:00:00", 102, 103),
    ("2020-01-31 23:59:50", 104, 105), ("2020-03-01 00:00:00", 106, 107), ("2020-03-15 00:00:00", 108, 109),
]


def write_parts(folder, parts):
    """Tick indices per file name."""
    for name, picked in parts.items():
        write_ticks(folder / name, [tick_line(*TICKS[i]) for i in picked])


def rows_of(store):
    return sorted(tuple(r) for r in store.bars.read().collect())


def expected(spark):
    whole = upsert_with_prev_close(bars(ticks_frame(spark, [])), bars(ticks_frame(spark, TICKS)))
    return sorted(tuple(r) for r in whole.select(*TIMED_BAR.names, "prev_close").collect())


def load(spark, source, root, **settings):
    store = Store(spark, str(root), settings.get("by_instrument", False))
    return store, load_files(store, list_files(spark, str(source)), LoadSettings(**settings))


def test_order_of_files_does_not_matter(spark, tmp_path):
    parts = {"late.csv": [2, 5], "early.csv": [1, 3, 4], "first.csv": [0]}
    for number, order in enumerate(itertools.permutations(parts)):
        if number % 2:
            continue
        root = tmp_path / f"store{number}"
        for name in order:
            source = tmp_path / f"in{number}"
            write_parts(source, {name: parts[name]})
            store, count = load(spark, source, root)
            assert count == 1
        assert rows_of(store) == expected(spark)


def test_known_content_is_not_loaded_again(spark, tmp_path):
    write_parts(tmp_path / "in", {"a.csv": [0, 1, 2], "b.csv": [3, 4, 5]})
    store, count = load(spark, tmp_path / "in", tmp_path / "store")
    assert count == 2 and rows_of(store) == expected(spark)
    assert not list(Path(work_root(spark).removeprefix("file:")).glob("candlemill/*/load-*"))
    write_parts(tmp_path / "in", {"same bytes.csv": [0, 1, 2]})
    store, count = load(spark, tmp_path / "in", tmp_path / "store")
    assert count == 0 and rows_of(store) == expected(spark)
    state = audit_state(store.file_audit()).collect()
    assert sorted(r.lines for r in state) == [3, 3] and all(r.end_timestamp for r in state)


def test_unfinished_files_are_loaded_again(spark, tmp_path, monkeypatch):
    write_parts(tmp_path / "in", {"a.csv": [0, 1, 2], "b.csv": [3, 4, 5]})

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(load_plan, "finished_rows", dies)
        with pytest.raises(RuntimeError):
            load(spark, tmp_path / "in", tmp_path / "store")
    state = audit_state(Store(spark, str(tmp_path / "store")).file_audit())
    assert [r.end_timestamp for r in state.collect()] == [None, None]
    store, count = load(spark, tmp_path / "in", tmp_path / "store", retry=False)
    assert count == 0
    store, count = load(spark, tmp_path / "in", tmp_path / "store")
    assert count == 2 and rows_of(store) == expected(spark)


def test_file_without_ticks_is_finished_with_no_lines(spark, tmp_path):
    write_parts(tmp_path / "in", {"empty.csv": []})
    store, count = load(spark, tmp_path / "in", tmp_path / "store")
    assert count == 1 and rows_of(store) == []
    assert [(r.lines, r.end_timestamp is not None) for r in audit_state(store.file_audit()).collect()] == [(0, True)]


def test_known_files_are_not_hashed_again(spark, tmp_path, monkeypatch):
    write_parts(tmp_path / "in", {"a.csv": [0, 1], "copy.csv": [0, 1]})
    load(spark, tmp_path / "in", tmp_path / "store")
    with monkeypatch.context() as broken:
        broken.setattr(load_plan, "with_checksum", None)
        _, count = load(spark, tmp_path / "in", tmp_path / "store")
        assert count == 0
    write_parts(tmp_path / "in", {"a.csv": [0, 1, 2]})
    store, count = load(spark, tmp_path / "in", tmp_path / "store")
    assert count == 1
    _, count = load(spark, tmp_path / "in", tmp_path / "store", rehash=True)
    assert count == 0


def test_batches_equal_one_load(spark, tmp_path):
    write_parts(tmp_path / "in", {f"{i}.csv": [i] for i in range(6)})
    store, count = load(spark, tmp_path / "in", tmp_path / "store", files_per_batch=2)
    assert count == 6 and rows_of(store) == expected(spark)


@pytest.mark.parametrize("line", ["2020-01-03 00:00:00;4,0", ";1;1;1;1;0", "2020-01-03 00:00:00;;1;1;1;0"])
def test_lines_with_missing_cells(spark, tmp_path, line):
    write_ticks(tmp_path / "in" / "a.csv", [tick_line(*TICKS[1]), line])
    with pytest.raises(Exception, match="bad (time|open|close)"):
        load(spark, tmp_path / "in", tmp_path / "failed")
    store, _ = load(spark, tmp_path / "in", tmp_path / "dropped", bad_rows="drop")
    assert [(r.open, r.close) for r in store.bars.read().collect()] == [(100, 101)]
    assert [r.lines for r in audit_state(store.file_audit()).collect()] == [2]
    store, _ = load(spark, tmp_path / "in", tmp_path / "null", bad_rows="null")
    bar = store.bars.read().first()
    assert bar.open == 100 and bar.close in (101, 1)
    assert [r.lines for r in audit_state(store.file_audit()).collect()] == [2]


def test_a_corrected_file_repairs_a_bar(spark, tmp_path):
    write_ticks(tmp_path / "in" / "a.csv", [tick_line(*TICKS[1]), "2020-01-31 23:59:50;104,0"])
    load(spark, tmp_path / "in", tmp_path / "store", bad_rows="null")
    write_ticks(tmp_path / "in" / "a.csv", [tick_line(*TICKS[1]), tick_line(*TICKS[3])])
    store, count = load(spark, tmp_path / "in", tmp_path / "store", bad_rows="null")
    assert count == 1 and [(r.open, r.close) for r in store.bars.read().collect()] == [(100, 105)]


def test_replace_keeps_the_newer_bar_only(spark, tmp_path):
    for number, picked in enumerate([[0, 1, 3], [2]]):
        write_parts(tmp_path / f"in{number}", {"a.csv": picked})
        store, _ = load(spark, tmp_path / f"in{number}", tmp_path / "store", upsert="replace")
    found = {(r.year, r.month): (r.open, r.close, r.prev_close) for r in store.bars.read().collect()}
    assert found == {(2019, 12): (90, 91, 90), (2020, 1): (102, 103, 91)}


def test_prev_close_inside_the_batch(spark, tmp_path):
    for number, picked in enumerate([[0], [1, 4]]):
        write_parts(tmp_path / f"in{number}", {"a.csv": picked})
        store, _ = load(spark, tmp_path / f"in{number}", tmp_path / "store", upsert="replace", prev_close="batch")
    found = {(r.year, r.month): r.prev_close for r in store.bars.read().collect()}
    assert found == {(2019, 12): 90, (2020, 1): 100, (2020, 3): 101}
    with pytest.raises(ValueError):
        load(spark, tmp_path / "in0", tmp_path / "other", prev_close="batch")


PAIR = {"XAUUSD_10Secs_Ask_2020.csv": [1], "EURUSD_10Secs_Ask_2020.csv": [2]}


def test_one_series_per_instrument(spark, tmp_path):
    write_parts(tmp_path / "in", PAIR)
    store, _ = load(spark, tmp_path / "in", tmp_path / "store", by_instrument=True)
    found = [(r.instrument, r.open) for r in store.bars.read().orderBy("instrument").collect()]
    assert found == [("EURUSD", 102), ("XAUUSD", 100)]
    audit = spark.read.parquet(store.bar_audit_path).collect()
    assert sorted((r.instrument, r.market) for r in audit) == [("EURUSD", "10S"), ("XAUUSD", "10S")]
    assert len({r.checksum for r in audit}) == 2


def test_instruments_are_not_mixed(spark, tmp_path):
    write_parts(tmp_path / "in", PAIR)
    with pytest.raises(ValueError, match="several instruments"):
        load(spark, tmp_path / "in", tmp_path / "store")
    write_parts(tmp_path / "one", {"XAUUSD_1.csv": [1]})
    load(spark, tmp_path / "one", tmp_path / "store")
    write_parts(tmp_path / "two", {"EURUSD_1.csv": [2]})
    with pytest.raises(ValueError, match="several instruments"):
        load(spark, tmp_path / "two", tmp_path / "store")
    write_parts(tmp_path / "none", {"nameless.csv": [2]})
    with pytest.raises(ValueError, match="no instrument"):
        load(spark, tmp_path / "none", tmp_path / "other", by_instrument=True)


def test_job_per_instrument(spark, tmp_path):
    write_parts(tmp_path / "in", {"EUR_2020.csv": [0, 1, 5], "USD_2020.csv": [2, 4]})
    settings = LoadSettings(by_instrument=True)
    report = run_load(spark, str(tmp_path / "in"), str(tmp_path / "s"), flavour="mysql", settings=settings)
    expected_rows = []
    for market, picked in (("EUR", [0, 1, 5]), ("USD", [2, 4])):
        alone = growth_report(bars(ticks_frame(spark, [TICKS[i] for i in picked])), "mysql")
        expected_rows += [(market, *r) for r in alone.collect()]
    assert [tuple(r) for r in report.collect()] == expected_rows


def test_job_incremental_full_and_stored_result(spark, tmp_path, capsys):
    source, root = tmp_path / "in", str(tmp_path / "store")
    write_parts(source, {"a.csv": [0, 1, 3]})
    run_load(spark, str(source), root)
    write_parts(source, {"b.csv": [2, 4, 5]})
    report = run_load(spark, str(source), root, mode="cc", flavour="zero")
    whole = growth_report(bars(ticks_frame(spark, TICKS)), "zero", "cc").collect()
    assert report.collect() == whole
    again = run_load(spark, str(source), root, mode="cc", flavour="zero")
    assert again.collect() == whole and "no new files" in capsys.readouterr().out
    assert run_load(spark, str(source), root, "full", "cc", "zero").collect() == whole
    shown = run(spark, ["--store", root, "--get-result"])
    assert [r.year for r in shown.collect()] == ["2019", "2020", "AVG"]
    audit = Store(spark, root).report_audit().collect()
    assert {(r.flavour, r.mode) for r in audit} == {("zero", "cc")} and len(audit) == 3
    before = sorted(Store(spark, root).bars.read().collect())
    for wrong in (dict(source=str(tmp_path / "no")), dict(flavour="some"), dict(mode="some")):
        with pytest.raises(Exception):
            run_load(spark, **{"source": str(source), "root": root, "load_mode": "full", **wrong})
    kept = Store(spark, root)
    assert sorted(kept.bars.read().collect()) == before and kept.report_audit().count() == 3
    assert audit_state(kept.file_audit()).count() == 2
    with pytest.raises(ValueError):
        run_load(spark, str(source), root, "some")


def test_week_job(spark, tmp_path):
    write_parts(tmp_path / "in", {"a.csv": [0, 1, 2], "b.csv": [3, 4, 5]})
    report = run(spark, ["--store", str(tmp_path / "s"), "--source", str(tmp_path / "in"), "--time-mode", "week"])
    assert [r.month for r in report.collect()] == ["January", "March", "December"]


def test_week_job_per_instrument(spark, tmp_path):
    write_parts(tmp_path / "in", {"EUR_2020.csv": [1, 2], "USD_10 Y_2020.csv": [1, 3], "EUR_2021.csv": [3]})
    args = ["--store", str(tmp_path / "s"), "--source", str(tmp_path / "in"), "--time-mode", "week", "--by-instrument"]
    for mode in ("oc", "cc"):
        found = run(spark, [*args, "--calculation-mode", mode]).collect()
        for row in found:
            picked = {"EUR": [1, 2, 3], "USD": [1, 3]}[row.instrument]
            alone = week_report(bars(ticks_frame(spark, [TICKS[i] for i in picked]), DAY), mode).first()
            assert tuple(row)[1:] == tuple(alone)
        assert len(found) == 2


def test_merge_is_idempotent_and_commutes(spark):
    parts = [bars(ticks_frame(spark, [TICKS[i] for i in picked])) for picked in ([0, 2], [1, 5], [3, 4])]
    whole = sorted(bars(ticks_frame(spark, TICKS)).collect())
    for order in ([0, 1, 2], [2, 1, 0], [1, 1, 0, 2, 2]):
        merged = parts[order[0]]
        for i in order[1:]:
            merged = merge_bars(merged, parts[i], MONTH)
        assert sorted(merged.collect()) == whole


def test_equal_times_keep_the_stored_value(spark):
    old = bars(ticks_frame(spark, [("2020-01-02", 1, 2)]))
    new = bars(ticks_frame(spark, [("2020-01-02", 3, 4)]))
    row = merge_bars(old, new).first()
    assert (row.open, row.close) == (1, 2)


def file_rows(spark, *names):
    return spark.createDataFrame([(n, f"{n}.csv", None) for n in names], "checksum string, file_name string, market string")


def test_audit_state_takes_the_latest_start(spark):
    one = started_rows(file_rows(spark, "a", "b"), "2020-01-01 00:00:00", "t")
    lines = spark.createDataFrame([("a", 7)], "checksum string, lines long")
    done = finished_rows(one.filter("checksum = 'a'"), lines, "2020-01-01 00:05:00")
    again = started_rows(file_rows(spark, "a"), "2020-01-02 00:00:00", "t")
    state = {r.checksum: r for r in audit_state(one.union(done)).collect()}
    assert state["a"].lines == 7 and state["a"].end_timestamp == at("2020-01-01 00:05:00")
    assert state["b"].end_timestamp is None
    log = one.union(done)
    todo = files_to_load(file_rows(spark, "a", "b", "c"), log)
    assert sorted(r.checksum for r in todo.collect()) == ["b", "c"]
    todo = files_to_load(file_rows(spark, "a", "b", "c"), log, retry=False)
    assert [r.checksum for r in todo.collect()] == ["c"]
    todo = files_to_load(file_rows(spark, "a"), log.union(again))
    assert todo.count() == 1
    assert times_seen(log, "a").first().rows == 2
    assert log.schema.names == FILE_AUDIT.names


def test_half_written_version_is_not_read(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), bars(ticks_frame(spark, [])).schema, "year")
    assert table.read().count() == 0
    table.commit(bars(ticks_frame(spark, TICKS[:1])))
    table.commit(merge_bars(table.read(), bars(ticks_frame(spark, TICKS[1:]))))
    whole = sorted(bars(ticks_frame(spark, TICKS)).collect())
    assert sorted(table.read().collect()) == whole
    (tmp_path / "t" / "v00000003" / "year=2020").mkdir(parents=True)
    assert sorted(table.read().collect()) == whole
    assert table.commit(table.read()) == 4
    assert sorted(table.read().collect()) == whole


def test_old_versions_are_removed_on_request(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), bars(ticks_frame(spark, [])).schema)
    for _ in range(5):
        table.commit(merge_bars(table.read(), bars(ticks_frame(spark, TICKS))))
    assert len(list((tmp_path / "t").iterdir())) == 5
    table.forget(3)
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["v00000003", "v00000004", "v00000005"]
    assert table.read().count() == 3


def test_watermark_of_an_empty_target_lets_everything_through(spark):
    rows = spark.createDataFrame([("2020-01-01",), ("2020-01-02",)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("modified_timestamp")
    )
    assert high_watermark(rows.limit(0)) == NEVER
    assert rows_since(rows, NEVER).count() == 2
    assert rows_since(rows, high_watermark(rows)).count() == 0


def test_watermark_filter_reaches_the_scan(spark, tmp_path):
    rows = spark.range(3).select(F.lit("2020-01-01").cast("timestamp_ntz").alias("modified_timestamp"), "id")
    rows.write.parquet(str(tmp_path / "t"))
    plan = rows_since(spark.read.parquet(str(tmp_path / "t")), NEVER)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(modified_timestamp,2000-01-01T00:00:01" in plan


def test_stamps_are_kept(spark):
    rows = spark.createDataFrame([(1, "2020-01-01"), (2, None)], "id int, t string").select(
        "id", F.col("t").cast("timestamp_ntz").alias("modified_timestamp")
    )
    found = {r.id: r.modified_timestamp for r in stamped(rows, "2020-02-02 00:00:00").collect()}
    assert found == {1: at("2020-01-01"), 2: at("2020-02-02")}


@pytest.mark.parametrize("start", [stream_files, stream_ticks])
def test_stream_equals_batch(spark, tmp_path, start):
    source, root = tmp_path / "in", str(tmp_path / "store")
    write_parts(source, {"late.csv": [2, 5], "early.csv": [1, 3], "other.csv": [0, 4]})
    start(spark, str(source), root, f"{root}/cp", files_per_batch=1).awaitTermination()
    assert rows_of(Store(spark, root)) == expected(spark)
    # A lost checkpoint replays every file; nothing changes.
    start(spark, str(source), root, f"{root}/cp2", files_per_batch=2).awaitTermination()
    assert rows_of(Store(spark, root)) == expected(spark)


def test_stream_that_keeps_running(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "store")
    write_parts(source, {"early.csv": [0, 1, 3]})
    query = stream_files(spark, str(source), root, f"{root}/cp", interval="1 second")
    try:
        query.processAllAvailable()
        write_parts(source, {"late.csv": [2, 4, 5], "copy of early.csv": [0, 1, 3]})
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows_of(Store(spark, root)) == expected(spark)
    assert audit_state(Store(spark, root).file_audit()).count() == 2


def test_started_files_are_logged_before_the_load(spark, tmp_path):
    write_parts(tmp_path / "in", {"a.csv": [0]})
    store = Store(spark, str(tmp_path / "store"))
    batch = start_files(store, list_files(spark, str(tmp_path / "in")), LoadSettings(), at("2021-01-01"), str(tmp_path / "w"))
    assert batch.count() == 1
    log = store.file_audit().collect()
    assert [(r.event, r.start_timestamp, r.lines) for r in log] == [("started", at("2021-01-01"), None)]


def test_tables_are_set_up_once_and_truncated(spark, tmp_path):
    location = f"file:{tmp_path}/db"
    setup_tables(spark, "candlemill_test", location)
    rows = with_prev_close(bars(ticks_frame(spark, TICKS)))
    insert_rows(rows, "candlemill_test.bar_staging")
    insert_rows(rows, "candlemill_test.bar_staging")
    setup_tables(spark, "candlemill_test", location)
    assert spark.table("candlemill_test.bar_staging").count() == 2 * rows.count()
    truncate_and_load(rows, "candlemill_test.bar_staging")
    assert sorted(spark.table("candlemill_test.bar_staging").select(*rows.columns).collect()) == sorted(rows.collect())
    truncate_tables(spark, "candlemill_test")
    assert all(spark.table(f"candlemill_test.{name}").count() == 0 for name in TABLES)
    spark.sql("DROP DATABASE candlemill_test CASCADE")
