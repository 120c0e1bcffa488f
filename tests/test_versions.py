"""Versioned tables: concurrent writers, crashes between steps, upserts that touch few files."""

from __future__ import annotations

import os
import threading

import pytest
from pyspark.sql import functions as F

from strata.session import scratch_path
from strata.sinks import versions
from strata.sinks.versions import Conflict, VersionedTable


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, data, ddl="k int, v string, t int"):
    return spark.createDataFrame(data, ddl)


@pytest.fixture
def table(spark):
    return VersionedTable(spark, scratch_path(spark, "versioned"), ["k"])


def test_versions_replace_and_add(spark, table):
    assert not table.exists()
    with pytest.raises(ValueError, match="no version"):
        table.read()
    assert table.overwrite(frame(spark, [(1, "a", 1), (2, "b", 1)])) == 1
    assert table.append(frame(spark, [(3, "c", 1), (None, "n", 1)])) == 2
    assert rows(table.read()) == sorted([(1, "a", 1), (2, "b", 1), (3, "c", 1), (None, "n", 1)], key=repr)
    assert table.row_count() == 4 and table.row_count(1) == 2
    assert table.overwrite(frame(spark, [(9, "z")], "k int, v string")) == 3
    assert table.read().columns == ["k", "v"] and rows(table.read(2)) != rows(table.read())
    with pytest.raises(ValueError, match="other columns"):
        table.append(frame(spark, [(9, "z", 1)]))
    assert table.overwrite(frame(spark, [])) == 4 and rows(table.read()) == []


def test_upsert_updates_and_inserts(spark, table):
    assert table.upsert(frame(spark, [(1, "a", 1), (2, "b", 1), (None, "x", 1)])) == 1
    table.upsert(frame(spark, [(2, "B", 0), (3, "c", 1), (None, "y", 1)]))
    assert rows(table.read()) == sorted(
        [(1, "a", 1), (2, "B", 0), (3, "c", 1), (None, "x", 1), (None, "y", 1)], key=repr
    )


def test_upsert_where_the_newest_row_wins(spark, table):
    table.overwrite(frame(spark, [(1, "a", 5), (2, "b", 5), (None, "n", 1)]))
    table.upsert(frame(spark, [(1, "late", 4), (2, "new", 6), (3, "c", None)]), order_column="t")
    assert rows(table.read()) == sorted([(1, "a", 5), (2, "new", 6), (3, "c", None), (None, "n", 1)], key=repr)


def test_upsert_of_a_repeated_key_changes_nothing(spark, table):
    table.overwrite(frame(spark, [(1, "a", 1)]))
    with pytest.raises(ValueError, match="repeats the merge key"):
        table.upsert(frame(spark, [(7, "x", 1), (7, "y", 1)]))
    assert table.versions() == [1] and rows(table.read()) == [(1, "a", 1)]


def test_upsert_rewrites_only_files_that_hold_a_changed_key(spark, table):
    many = spark.range(0, 4000, 1, 4).selectExpr("cast(id * 2 as int) AS k", "cast(id as string) AS v", "0 AS t")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.overwrite(many)
        before = {r.path: (r.low.k, r.high.k) for r in table.files().collect()}
        assert len(before) == 4
        lowest = min(before, key=lambda p: before[p])
        table.upsert(frame(spark, [(4, "new", 1), (7, "inserted in its range", 1), (10**8, "beyond", 1)]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    after = {r.path for r in table.files().collect()}
    assert set(before) - after == {lowest} and table.commit_of()["rewritten"] == 1
    assert table.row_count() == 4002
    assert rows(table.read().where("t = 1")) == sorted(
        [(4, "new", 1), (7, "inserted in its range", 1), (10**8, "beyond", 1)], key=repr
    )


def test_the_source_is_evaluated_once(spark, table):
    table.overwrite(frame(spark, [(1, "a", 1)]))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(v):
        seen.add(1)
        return v

    table.upsert(frame(spark, [(1, "x", 1), (2, "y", 1)]).withColumn("v", counted("v")))
    assert seen.value == 2 and rows(table.read()) == [(1, "x", 1), (2, "y", 1)]


def test_of_two_writers_one_starts_again(spark, table, monkeypatch):
    table.overwrite(frame(spark, [(0, "a", 0)]))
    meet = threading.Barrier(2, timeout=60)
    commit, waited = VersionedTable._commit, set()

    def together(self, *arguments):
        me = threading.get_ident()
        if me not in waited:
            waited.add(me)
            meet.wait()  # both have built on the same version
        return commit(self, *arguments)

    monkeypatch.setattr(VersionedTable, "_commit", together)
    done = []
    writers = [
        threading.Thread(target=lambda k=k: done.append(table.upsert(frame(spark, [(k, f"w{k}", 1)])))) for k in (1, 2)
    ]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert sorted(done) == [2, 3]
    assert rows(table.read()) == [(0, "a", 0), (1, "w1", 1), (2, "w2", 1)]


def test_a_number_is_taken_once(spark, table):
    table.overwrite(frame(spark, [(1, "a", 1)]))
    schema = table.read().schema
    with pytest.raises(Conflict):
        table._commit(1, "overwrite", "elsewhere", schema, 0)
    assert rows(table.read()) == [(1, "a", 1)]
    assert not [n for n in os.listdir(f"{table.root}/{versions.COMMITS}") if n.startswith("draft")]


@pytest.mark.parametrize("step", ["_write", "_list", "_commit", "_take"])
def test_a_crash_at_any_step_leaves_the_old_version(spark, table, monkeypatch, step):
    table.overwrite(frame(spark, [(1, "a", 1)]))
    real = getattr(VersionedTable, step)

    def crash(self, *arguments):
        if step in ("_write", "_list"):
            real(self, *arguments)  # the files are there, nobody lists them
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(VersionedTable, step, crash)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(frame(spark, [(1, "b", 2), (2, "c", 2)]))
    assert table.versions() == [1] and rows(table.read()) == [(1, "a", 1)]
    table.upsert(frame(spark, [(1, "b", 2), (2, "c", 2)]))
    assert rows(table.read()) == [(1, "b", 2), (2, "c", 2)]


def test_a_reader_keeps_its_version(spark, table):
    table.overwrite(frame(spark, [(1, "a", 1)]))
    reading = table.read()
    table.overwrite(frame(spark, [(2, "b", 1)]))
    assert rows(reading) == [(1, "a", 1)] and rows(table.read()) == [(2, "b", 1)]


def test_retention_removes_what_no_version_lists(spark, table):
    table.overwrite(frame(spark, [(1, "a", 1)]))
    table.append(frame(spark, [(2, "b", 1)]))
    table.overwrite(frame(spark, [(3, "c", 1)]))
    folders = lambda: len(os.listdir(f"{table.root}/{versions.DATA}"))
    assert table.retain(2) == 0 and table.versions() == [2, 3] and folders() == 3
    assert rows(table.read(2)) == [(1, "a", 1), (2, "b", 1)]
    assert table.retain(1, older_than_seconds=0) == 4  # two folders of data, two lists
    assert table.versions() == [3] and folders() == 1 and rows(table.read()) == [(3, "c", 1)]
