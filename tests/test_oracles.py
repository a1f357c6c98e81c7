"""Every registered query against its SQL form in another engine."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from wirelake.plans import oracles
from wirelake.plans import queries as registry

QUERIES, SQL = registry.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def other():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute("CREATE VIEW events AS SELECT * FROM '/root/testdata/sf0.001/events.parquet'")
    return con


def _value(x):
    if x is None:
        return ""
    if isinstance(x, float):
        return "nan" if math.isnan(x) else f"{x:.6f}"
    return f"{x:.6f}" if isinstance(x, int) and not isinstance(x, bool) else str(x)


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, other, name):
    result = QUERIES[name](spark, sf_dir)
    wanted = other.sql(SQL[name])
    assert sorted(result.columns) == sorted(wanted.columns)
    got = _rows(result.collect(), result.columns)
    assert got == _rows(wanted.fetchall(), wanted.columns)
    assert got


def test_entry(spark, sf_dir):
    assert entry_points.entry(spark).count() == 10
