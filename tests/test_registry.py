"""Every registered query runs and, where it has a SQL twin, agrees with it."""

import os
from types import SimpleNamespace

import pytest

import __spark_entry__ as entry
from candlemill.session import CHECKPOINT_DIR, fresh_dir, work_root
from tools.compare import connect, frame, twin

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
QUERIES = entry.queries()
TWINS = entry.oracle_sql()


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SMALL)
    names, rows = frame(df.columns, df.collect())
    assert rows
    if name in TWINS:
        assert (names, rows) == twin(connect(SMALL), TWINS[name])


@needs_data
def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 1 and df.columns[0] == "year" and df.columns[-1] == "total"


def fake_session(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=conf.get),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_work_folder_comes_from_the_session(spark):
    root = spark.conf.get(CHECKPOINT_DIR)
    assert work_root(spark) == root
    assert fresh_dir(spark, "x").startswith(f"{root}/candlemill/")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")
    shared = fake_session("yarn", **{CHECKPOINT_DIR: "hdfs://name/work/"})
    assert work_root(shared) == "hdfs://name/work"


def test_only_a_local_master_gets_a_folder_of_its_own():
    with pytest.raises(RuntimeError):
        work_root(fake_session("spark://host:7077"))
    with pytest.raises(RuntimeError):
        work_root(fake_session("local-cluster[2,1,1024]"))
    for master in ("local", "local[2]"):
        alone = fake_session(master)
        assert work_root(alone).startswith("file:") and work_root(alone) == work_root(alone)
