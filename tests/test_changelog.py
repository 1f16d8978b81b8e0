"""Commits, changes, time travel and an index that follows."""

import pytest
from pyspark.sql import functions as F

from corpusq.functions import terms as V
from corpusq.sources.changelog import ChangeLog, follow_index
from corpusq.sources.snapshots import snapshot_diff

SCHEMA = "id long, body string, tag string"


def table(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def got(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_commits_and_changes(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "t"), "id")
    assert log.version() == 0
    with pytest.raises(ValueError, match="no commits"):
        log.read()
    first, second = table(spark, (1, "a", "x"), (2, None, "x"), (3, "c", None)), table(spark, (2, "", "x"), (3, "c", None), (4, "d", "y"))
    assert log.commit(first) == 1
    assert log.commit(first.select("tag", "body", "id")) == 1  # nothing differs
    assert log.commit(second) == 2
    assert log.commit(table(spark, (1, "again", "x"), (3, "c", "z"), (4, "d", "y"))) == 3
    columns = ("id", "kind", "version", "body")
    assert got(log.changes(1, 2), *columns) == [(1, "delete", 2, None), (2, "update", 2, ""), (4, "insert", 2, "d")]
    assert got(log.changes(1, net=True), "id", "kind") == [(1, "insert"), (2, "delete"), (3, "update"), (4, "insert")]
    assert log.changes(3).count() == 0
    for version, state in ((1, first), (2, second)):
        assert got(log.read(version), "id", "body", "tag") == got(state, "id", "body", "tag")
    now = got(log.read(), "id", "body", "tag")
    assert now == [(1, "again", "x"), (3, "c", "z"), (4, "d", "y")]
    log.compact()
    assert got(log.read(), "id", "body", "tag") == now and log.version() == 3
    assert got(log.read(2), "id", "body", "tag") == got(second, "id", "body", "tag")
    assert log.commit(table(spark)) == 4 and log.read().count() == 0
    assert log.changes(3).filter("kind = 'delete'").count() == 3


def test_duplicate_and_null_keys_are_refused(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "t"), "id")
    for bad in (((1, "a", "x"), (1, "b", "x")), ((None, "a", "x"),)):
        with pytest.raises(ValueError, match="not unique"):
            log.commit(table(spark, *bad))
        for sides in ((table(spark, (5, "a", "x")), table(spark, *bad)), (table(spark, *bad), table(spark, (5, "a", "x")))):
            with pytest.raises(Exception, match="not unique"):
                snapshot_diff(*sides, "id").collect()
    assert log.version() == 0


def test_failed_commit_is_overwritten(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "t"), "id")
    log.commit(table(spark, (1, "a", "x")))
    table(spark, (9, "lost", "x")).withColumns({"kind": F.lit("insert"), "_digest": F.lit("")}).write.parquet(f"{log.path}/changes/version=2")
    assert log.read().count() == 1  # its line never came
    log.commit(table(spark, (1, "a", "x"), (2, "b", "x")))
    assert got(log.changes(1), "id", "kind") == [(2, "insert")]


def test_index_follows_the_log(spark, tmp_path):
    source, index = ChangeLog(spark, str(tmp_path / "s"), "id"), ChangeLog(spark, str(tmp_path / "i"), "id")
    assert follow_index(source, index, "body") == 0
    source.commit(table(spark, (1, "a b", "x"), (2, "c", "x"), (3, "d d", "x")))
    assert follow_index(source, index, "body", ["tag"]) == 1
    source.commit(table(spark, (1, "a b", "x"), (3, "d e", "x"), (4, None, "x")))
    source.commit(table(spark, (1, "a b", "x"), (3, "d e f", "x"), (4, None, "x")))
    assert follow_index(source, index, "body", ["tag"]) == 3
    assert follow_index(source, index, "body", ["tag"]) == 3
    assert index.version() == 2 and got(index.changes(1), "id") == [(2,), (3,), (4,)]  # one change per key, none for what stayed
    want = source.read().withColumn("norm2", V.squared_norm(V.term_vector(F.col("body"))))
    assert got(index.read(), "id", "body", "norm2") == got(want, "id", "body", "norm2")
    index.compact()
    source.commit(table(spark, (5, "z", "x")))
    follow_index(source, index, "body", ["tag"])
    assert got(index.read(), "id", "body") == [(5, "z")]


def test_one_commit_is_read_without_moving_its_rows(spark, tmp_path):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    log = ChangeLog(spark, str(tmp_path / "once"), "k")
    log.commit(spark.createDataFrame([(1, "a"), (2, "b")], "k long, x string"))
    assert "Window" not in plan(log.read()) and "Window" not in plan(log.changes(net=True))
    log.commit(spark.createDataFrame([(1, "c")], "k long, x string"))
    assert "Window" in plan(log.read()) and "Window" not in plan(log.changes(1, net=True))
    assert [tuple(r) for r in log.read().collect()] == [(1, "c")]
    taken = ChangeLog(spark, str(tmp_path / "taken"), "k")
    taken.apply(spark.createDataFrame([(1, "a", "update"), (1, "a", "update")], "k long, x string, kind string"), 1)
    assert [tuple(r) for r in taken.read().collect()] == [(1, "a")]
