import random

import pytest
from pyspark.sql import functions as F

from wirelake.operators.batching import batch_count_or_time, batch_list
from tests.conftest import seconds

SCHEMA = "key STRING, seq BIGINT, arrival DOUBLE"


def _loop(arrivals, size, interval):
    """The rule as it reads, one row after the other: batch number and closing of each row."""
    out, filled, batch, flushed = [], 0, 0, arrivals[0]
    for at in arrivals:
        filled += 1
        closes = filled >= size or at - flushed >= interval
        out.append((batch, closes))
        if closes:
            filled, batch, flushed = 0, batch + 1, at
    return out


@pytest.mark.parametrize("seed,size,width,group", [(1, 5, 8, 2), (2, 1, 4, 3), (3, 20, 20, 2), (4, 7, 64, 4), (5, 50, 16, 2)])
def test_equals_the_loop(spark, seed, size, width, group):
    r = random.Random(seed)
    rows, wanted = [], {}
    for key, n in (("hot", 700), ("b", 90), ("c", 1), ("d", size), ("e", size + 1)):
        at, arrivals = 0, []
        for i in range(n):
            at += r.choice([0, 0, 0, 1, 2, 30])
            arrivals.append(at)
            rows.append((key, i * 2, float(at)))
        wanted[key] = _loop(arrivals, size, 10)
    df = seconds(spark, rows, SCHEMA, "arrival").repartition(8)
    out = batch_count_or_time(df, "key", "seq", size, 10_000_000, width=width, group=group)
    got = {}
    for row in out.orderBy("key", "seq").collect():
        got.setdefault(row.key, []).append((row.batch_no, row.closes))
    assert got == wanted


def test_size_and_time_examples(spark):
    three = seconds(spark, [("k", i, 0.0) for i in range(3)], SCHEMA, "arrival")
    row = batch_list(batch_count_or_time(three, "key", "seq", 3, 1_000_000), "key", "seq").collect()
    assert [(r.rows, r.closed) for r in row] == [(3, True)]
    two = batch_list(batch_count_or_time(three.filter("seq < 2"), "key", "seq", 3, 1_000_000), "key", "seq")
    assert [(r.rows, r.closed) for r in two.collect()] == [(2, False)]
    late = seconds(spark, [("k", 0, 0.0), ("k", 1, 1.1)], SCHEMA, "arrival")
    got = batch_list(batch_count_or_time(late, "key", "seq", 100, 1_000_000), "key", "seq").collect()
    assert [(r.rows, r.closed, r.last_seq) for r in got] == [(2, True, 1)]


def test_other_columns_pass_through(spark):
    df = seconds(spark, [("k", 0, 0.0)], SCHEMA, "arrival").withColumn("extra", F.lit("x"))
    assert batch_count_or_time(df, "key", "seq", 2, 1_000_000).columns == [
        "key", "seq", "arrival", "extra", "batch_no", "closes",
    ]


def test_key_may_be_null(spark):
    df = seconds(spark, [(None, i, 0.0) for i in range(5)] + [("k", 0, 0.0)], SCHEMA, "arrival")
    out = batch_list(batch_count_or_time(df, "key", "seq", 2, 1_000_000), "key", "seq").collect()
    assert sorted((r.key or "", r.batch_no, r.rows) for r in out) == [("", 0, 2), ("", 1, 2), ("", 2, 1), ("k", 0, 1)]
