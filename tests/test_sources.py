import hashlib

import pytest
from pyspark.sql import functions as F

from candlemill.functions.parsing import comma_text, market_of
from candlemill.schemas import TICK_RAW
from candlemill.sources.files import (
    line_counts,
    list_files,
    literal_path,
    manifest,
    with_checksum,
    with_tree_checksum,
)
from candlemill.sources.tables import jdbc_options
from candlemill.sources.ticks import load_ticks, normalize_ticks, scan_landing, scan_ticks
from tests.helpers import at, tick_line, write_ticks


def test_every_file_has_its_header_dropped(spark, tmp_path):
    write_ticks(tmp_path / "a.csv", [tick_line("2012-01-16 00:00:00", 1291.4, 1291.5)])
    write_ticks(tmp_path / "b.csv", [tick_line("2012-02-16 00:00:10", 1300.25)])
    write_ticks(tmp_path / "empty.csv", [])
    raw = scan_ticks(spark, [str(tmp_path / n) for n in ("a.csv", "b.csv", "empty.csv")])
    assert raw.schema == TICK_RAW
    assert sorted((r.time, r.open, r.close) for r in raw.collect()) == [
        ("2012-01-16 00:00:00", "1291,4", "1291,5"),
        ("2012-02-16 00:00:10", "1300,25", "1300,25"),
    ]
    typed = normalize_ticks(raw)
    assert dict(typed.dtypes) == {"time": "timestamp_ntz", "open": "double", "close": "double"}
    assert (at("2012-01-16 00:00:00"), 1291.4, 1291.5) in [tuple(r) for r in typed.collect()]


def test_quotes_and_decimal_prices(spark, tmp_path):
    write_ticks(tmp_path / "q.csv", ['"2012-01-16 00:00:00";"1291,4";"1291,5";"1291,4";"1291,45678";"0"'])
    row = load_ticks(scan_ticks(spark, str(tmp_path))).first()
    assert [str(v) for v in row][1:] == ["1291.40000", "1291.50000", "1291.40000", "1291.45678", "0.00000"]


def test_short_rows_and_absent_columns_read_as_null(spark, tmp_path):
    write_ticks(tmp_path / "s.csv", ["2012-01-16 00:00:00;1,5;1,5", tick_line("2012-01-16 00:00:10", 2.5)])
    rows = scan_landing(spark, str(tmp_path)).orderBy("time").collect()
    assert rows[0].open == "1,5" and rows[0].close is None
    assert [r.modified_timestamp for r in rows] == [None, None]


def test_dirty_rows_fail_drop_or_become_null(spark, tmp_path):
    write_ticks(tmp_path / "d.csv", [tick_line("2012-01-16 00:00:00", 1.5), tick_line("not a time", 2.5), "2012-01-17 00:00:00;x;1;1;1;0"])
    raw = scan_ticks(spark, str(tmp_path))
    with pytest.raises(Exception, match="bad (time|open)"):
        normalize_ticks(raw).collect()
    assert normalize_ticks(raw, bad_rows="drop").count() == 1
    nulls = normalize_ticks(raw, bad_rows="null")
    assert nulls.count() == 3 and nulls.filter("open IS NULL").count() == 1
    with pytest.raises(ValueError):
        normalize_ticks(raw, bad_rows="ignore")


def test_parsing_does_not_depend_on_zone_or_ansi(spark, tmp_path):
    # This wall-clock time does not exist in New York.
    write_ticks(tmp_path / "z.csv", [tick_line("2020-03-08 02:30:00", 1.5)])
    before = {k: spark.conf.get(k) for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")}
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        assert normalize_ticks(scan_ticks(spark, str(tmp_path))).first().time == at("2020-03-08 02:30:00")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_only_needed_columns_are_parsed(spark, tmp_path):
    write_ticks(tmp_path / "c.csv", [tick_line("2012-01-16 00:00:00", 1.5)])
    plan = normalize_ticks(scan_ticks(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<time:string,open:string,close:string>" in plan


def test_manifest_hashes_bytes_and_joins_copies(spark, tmp_path):
    line = tick_line("2012-01-16 00:00:00", 1.5)
    write_ticks(tmp_path / "XAUUSD_10Secs_Ask_2012.01.01_2012.12.31.csv", [line])
    write_ticks(tmp_path / "copy of it.csv", [line])
    write_ticks(tmp_path / "sub" / "XAUUSD_10 Secs_Ask_2013.csv", [line, line])
    (tmp_path / "notes.txt").write_text("not a tick file")
    files = list_files(spark, str(tmp_path))
    rows = manifest(files).collect()
    content = (tmp_path / "copy of it.csv").read_bytes()
    assert {r.checksum for r in rows} == {
        hashlib.sha256(content).hexdigest(),
        hashlib.sha256((tmp_path / "sub" / "XAUUSD_10 Secs_Ask_2013.csv").read_bytes()).hexdigest(),
    }
    assert {r.file_name: r.market for r in rows} == {
        "XAUUSD_10Secs_Ask_2012.01.01_2012.12.31.csv": "10S", "XAUUSD_10 Secs_Ask_2013.csv": "Ask",
    }
    assert list_files(spark, str(tmp_path), name_pattern="XAUUSD_10.*Ask").count() == 2
    assert sorted(r.checksum for r in with_checksum(files).collect()) == sorted(
        hashlib.sha256(f.read_bytes()).hexdigest() for f in tmp_path.rglob("*.csv")
    )


def test_files_are_hashed_by_one_scan(spark, tmp_path):
    write_ticks(tmp_path / "a.csv", [])
    plan = with_checksum(list_files(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("content:binary") == 1 and "Union" not in plan


def plain_tree(content, piece):
    body = content.removeprefix(b"\xef\xbb\xbf")
    lines = body.split(b"\n")
    if not lines[-1]:
        lines.pop()
    digests = [hashlib.sha256(x).digest() for x in lines]
    pieces = [hashlib.sha256(b"".join(digests[i : i + piece])).hexdigest() for i in range(0, len(lines), piece)]
    return hashlib.sha256(f"tree:{piece}:{len(content)}:{len(lines)}:{''.join(pieces)}".encode()).hexdigest()


TREE_FILES = {
    "a.csv": b"".join(b"line %d;%d\n" % (i, i * i) for i in range(3000)),
    "no end.csv": b"one\ntwo",
    "end.csv": b"one\ntwo\n",
    "mark.csv": b"\xef\xbb\xbfone\ntwo",
    "return.csv": b"one\r\ntwo\r\n\r\n",
    "bytes.csv": bytes(range(256)) * 3,
    "long.csv": b"x" * 300_000 + b"\n" + b"y" * 70_000,
    "blank.csv": b"\n" * 500,
}


@pytest.mark.parametrize("split,piece", [(1000, 7), (1 << 27, 7), (1 << 27, 1 << 16)])
def test_tree_checksum_in_any_splits(spark, tmp_path, split, piece):
    (tmp_path / "sub").mkdir()
    (tmp_path / "empty.csv").write_bytes(b"")
    for name, content in TREE_FILES.items():
        (tmp_path / name).write_bytes(content)
        (tmp_path / "sub" / f"copy of {name}").write_bytes(content)
    settings = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": 0}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = with_tree_checksum(spark, str(tmp_path), piece_lines=piece).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    found = {r.path.split("/")[-1]: r for r in rows}
    assert len(rows) == len(found) == 2 * len(TREE_FILES)
    for name, content in TREE_FILES.items():
        want = plain_tree(content, piece)
        assert (found[name].tree_checksum, found[f"copy of {name}"].tree_checksum) == (want, want), name
        assert found[name].length == len(content)
    assert found["a.csv"].lines == 3000 and found["blank.csv"].lines == 500
    assert len({found[n].tree_checksum for n in TREE_FILES}) == len(TREE_FILES)


def test_tree_checksum_reads_no_file_as_a_value(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"x\n")
    plan = with_tree_checksum(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    with pytest.raises(ValueError):
        with_tree_checksum(spark, str(tmp_path), piece_lines=0)


def test_paths_with_glob_characters(spark, tmp_path):
    for name in ("d[1].csv", "e{x}.csv", "p%20q.csv", "a b.csv"):
        write_ticks(tmp_path / name, [tick_line("2012-01-16 00:00:00", 1.5)])
    for row in list_files(spark, str(tmp_path)).select("path", "file_uri").collect():
        scanned = scan_ticks(spark, literal_path(row.path)).select(F.col("_metadata.file_path"))
        assert scanned.first()[0] == row.file_uri


def test_line_counts_with_and_without_header(spark, tmp_path):
    write_ticks(tmp_path / "a.csv", [tick_line("2012-01-16 00:00:00", 1.5)] * 5)
    assert line_counts(spark, str(tmp_path)).first().lines == 6
    assert line_counts(spark, str(tmp_path), with_header=False).first().lines == 5


def test_market_of_names_without_one(spark):
    names = spark.createDataFrame([("x.csv",), ("EURUSD_1 Min_Bid_2019.csv",)], "path string")
    assert [r[0] for r in names.select(market_of(F.col("path"))).collect()] == [None, "Bid"]


def test_comma_text(spark):
    assert spark.range(1).select(comma_text(F.lit(1291.4))).first()[0] == "1291,40"


def test_jdbc_reads_are_ranged():
    options = jdbc_options("jdbc:x", "t", "me", "pw", "year", (2000, 2020), 4)
    assert options["numPartitions"] == "4" and options["lowerBound"] == "2000" and options["dbtable"] == "t"
    assert "user" not in jdbc_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="year")
