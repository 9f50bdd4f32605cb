"""The stages one by one beside plain rules, and the whole run."""

import corpus_pipeline as C
from candlemill.llm.jaccard_join import jaccard_components
from candlemill.llm.mixing import mix


def corpus(prose):
    rows = [(i, prose(60, i, 3000), "en", f"s{i % 4}") for i in range(60)]
    rows += [(100 + i, rows[i][1] + " tail", "en", "s0") for i in range(10)]
    rows += [(200 + i, "All rights reserved by us.\n" + prose(50, 900 + i, 3000), "en", "s1") for i in range(8)]
    rows += [(300 + i, prose(40, 700 + i, 3000) + f" grobvex{i % 3}al", "en", "s2") for i in range(40)]
    return rows + [(400, None), (401, ""), (402, "few words"), rows[0], (None, "no id here")]


def saved_tables(spark, frame, prose, tmp_path):
    rows = corpus(prose)
    frame(rows).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(r[0], 1, int(300 <= r[0] < 340)) for r in rows if r[0] is not None and r[0] % 2 == 0]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return rows, str(tmp_path)


def test_stages(spark, frame, prose, tmp_path):
    rows, sf_dir = saved_tables(spark, frame, prose, tmp_path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")

    clean = C.drop_toxic(spark, docs, sf_dir)
    assert clean.columns == docs.columns
    ids = {r.doc_id for r in clean.collect()}
    assert ids >= {r[0] for r in rows if r[0] is None or not 300 <= r[0] < 340}
    assert len([i for i in ids if i and 300 <= i < 340]) <= 2

    lines = {r.doc_id: r for r in C.drop_repeated_lines(spark, docs, sf_dir).collect()}
    for doc_id, text, *_ in rows:
        cut = doc_id is not None and 200 <= doc_id < 208
        assert lines[doc_id].text == (text.split("\n")[1] if cut else text)
        assert lines[doc_id].n_chars == (len(lines[doc_id].text) if text is not None else None)

    kept = sorted({r.doc_id for r in C.keep_one_of_each_group(spark, docs, sf_dir).where("doc_id IS NOT NULL").collect()})
    groups = {r.doc_id: r.component_id for r in jaccard_components(docs).where("doc_id IS NOT NULL").collect()}
    assert kept == sorted({d for d, c in groups.items() if d == c}) and not set(range(100, 110)) & set(kept)

    taken = {(r.doc_id, r.size): r.taken for r in mix(docs).collect()}
    words = {}
    for r in C.mix_sources(spark, docs, sf_dir).collect():
        words.setdefault(r.doc_id, []).append(r.text)
        assert r.n_chars == len(r.text)
    texts = {r[0]: r[1] for r in rows}
    repeated = {None: 1, 0: 2}
    for (doc_id, size), n in taken.items():
        got = words.get(doc_id, [])
        assert all(t in texts[doc_id] for t in got)
        if doc_id not in repeated:
            assert sum(len(t.split()) for t in got) == n


def test_an_id_with_several_texts_keeps_one_of_each_group(spark, frame, prose):
    a, b, c = prose(60, 1), prose(60, 2), prose(60, 3)
    rows = [(1, a), (1, b), (1, c), (1, c), (5, b + " end"), (0, c), (7, None), (7, ""), (None, a), (8, "x y")]
    docs = frame(rows).selectExpr("*", "1 AS row", "2 AS component", "3 AS given", "4 AS place", "5 AS t1")
    kept = C.keep_one_of_each_group(spark, docs, "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, a), (1, b), (0, c), (7, None), (7, ""), (None, a), (8, "x y")], key=str)


def test_work_tables_are_deleted_but_for_what_outlives_them(spark):
    from pathlib import Path

    from candlemill.llm.common import saved, work_tables

    with work_tables(spark):
        with work_tables(spark):
            inner, outer = saved(spark.range(3), "a"), saved(spark.range(4), "b", outlives=True)
            files = [Path(d.inputFiles()[0].removeprefix("file://")) for d in (inner, outer)]
            assert all(f.exists() for f in files)
        assert [f.exists() for f in files] == [False, True] and outer.count() == 4
    assert not files[1].exists()


def test_shuffle_files_of_a_saved_table_are_deleted(spark):
    import time

    from candlemill.llm.common import SHUFFLE_CLEANUP, saved

    def shuffled():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        files = manager.getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.endswith(".data")}

    before, setting = shuffled(), spark.conf.get(SHUFFLE_CLEANUP)
    assert len(saved(spark.range(1000).repartition(3, "id"), "a").collect()) == 1000
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(SHUFFLE_CLEANUP) == setting


def test_whole_run(spark, frame, prose, tmp_path):
    _, sf_dir = saved_tables(spark, frame, prose, tmp_path)
    found = C.run(spark, sf_dir).collect()
    ids = {r.doc_id for r in found}
    assert found and not set(range(100, 110)) & ids and C.ORACLE_SQL is None
    assert len(C.STAGES) == 5 and max(r.offset + r.length for r in found) <= 2048


def test_empty_tables(spark, frame, tmp_path):
    frame([]).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert C.run(spark, str(tmp_path)).collect() == []
