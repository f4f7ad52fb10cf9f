"""Registered queries at the smallest scale, each against its SQL equivalent."""

import sys

import duckdb
import pytest

import __spark_entry__ as entry
from eventflow.plans import registry
from tests.conftest import ROOT, SF

sys.path.insert(0, str(ROOT / "tools"))
import check_oracle  # noqa: E402

registry.load_all()
QUERIES, SQL = registry.QUERIES, registry.SQL


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in check_oracle.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF).toArrow()
    want = con.execute(SQL[name]).to_arrow_table()
    assert check_oracle.kinds(got) == check_oracle.kinds(want)
    assert check_oracle.rows_of(got) == check_oracle.rows_of(want)
    assert got.num_rows > 0
