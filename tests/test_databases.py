"""Keyed database writes through DB-API connections opened by the tasks (a SQLite file)."""

import sqlite3

import pytest

from eventflow.sinks import databases as D


@pytest.fixture
def db(tmp_path):
    path = str(tmp_path / "t.db")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE t (k INTEGER PRIMARY KEY, a TEXT DEFAULT 'dflt', b INTEGER)")
        con.execute("INSERT INTO t VALUES (1, 'one', 10), (2, 'two', NULL)")
    return path


def connect(path):
    return lambda: sqlite3.connect(path, timeout=60)


def stored(path):
    with sqlite3.connect(path) as con:
        return con.execute("SELECT k, a, b FROM t ORDER BY k").fetchall()


def updates(spark):
    rows = [(0, 1, None, 11), (1, 1, "uno", None), (2, 3, None, 30), (3, 2, None, None), (4, 3, "tres", None)]
    return spark.createDataFrame(rows, "n int, K int, A string, b int")


def test_upsert_never_stores_null_over_a_value(spark, db):
    for _ in range(2):  # running it again changes nothing
        D.jdbc_upsert(updates(spark), "t", ["k", "a", "b"], ["k"], ["n"], connect(db))
        assert stored(db) == [(1, "uno", 11), (2, "two", None), (3, "tres", 30)]


def test_update_or_insert(spark, db):
    D.jdbc_update_or_insert(updates(spark), "t", ["k", "a", "b"], "k", ["n"], connect(db))
    assert stored(db) == [(1, "uno", 11), (2, "two", None), (3, "tres", 30)]


def test_update_with_where(spark, db):
    rows = spark.createDataFrame([(0, 1, "one", 5), (1, 2, "other", 5)], "n int, k int, a string, b int")
    D.jdbc_update_or_insert(rows, "t", ["k", "a", "b"], "k", ["n"], connect(db), where=["a"])
    assert stored(db) == [(1, "one", 5), (2, "two", None)]


def test_template(spark, db):
    sql = "INSERT INTO t (k, a, b) VALUES (${key:integer}, ${A:varchar}, ${nope:bigint})"
    template = D.Template.parse(sql)
    assert template.sql == "INSERT INTO t (k, a, b) VALUES (?, ?, ?)"
    assert template.parameters == (("key", "INTEGER"), ("A", "VARCHAR"), ("nope", "BIGINT"))
    rows = spark.createDataFrame([("7", "x"), ("8", None)], "KEY string, a string")
    D.jdbc_template(rows, sql, connect(db), batch_size=1)
    assert stored(db)[2:] == [(7, "x", None), (8, None, None)]


def test_failed_batch_leaves_nothing(spark, db):
    rows = spark.createDataFrame([(5,), (1,)], "k int").coalesce(1)
    with pytest.raises(Exception):
        D.jdbc_template(rows, "INSERT INTO t (k) VALUES (${k:int})", connect(db))
    assert [r[0] for r in stored(db)] == [1, 2]
