import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from wirelake.llm import registry

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def test_each_operator_is_registered_once():
    names = registry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(names) <= set(entry_points.queries())
    assert set(registry.oracle_sql()) <= set(names)


def _value(x):
    return f"{x:.9f}" if isinstance(x, float) and not math.isnan(x) else str(x)


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_against_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got, wanted = registry.queries()[name](spark, sf_dir), con.sql(registry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(wanted.columns)
    place = [wanted.columns.index(c) for c in got.columns]
    assert sorted(tuple(map(_value, r)) for r in got.collect()) == sorted(tuple(_value(r[p]) for p in place) for r in wanted.fetchall())
