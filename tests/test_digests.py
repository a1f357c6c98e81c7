import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wirelake.operators import digests as D
from wirelake.operators.reconcile import diff_rows
from wirelake.schema import PACKETS, SHAPED_COLUMNS

START = datetime(2024, 1, 1)


def table(spark, rows):
    return spark.createDataFrame(rows, PACKETS)


def row(k, port=None, length=60, proto="eth:ip:tcp"):
    return (START + timedelta(minutes=7 * k), f"10.0.0.{k % 9}", "10.1.0.1", port, 443, proto, length, f"p{k}")


def found(df):
    return sorted(map(str, (tuple(r) for r in df.select(*SHAPED_COLUMNS).collect())))


@pytest.mark.parametrize("cells", [2, 32])
def test_same_rows_as_the_full_comparison(spark, cells):
    rng = random.Random(cells)
    rows = [row(k, rng.choice([None, 1, 2])) for k in range(400) for _ in range(rng.choice([1, 1, 1, 4]))]
    other = [r for r in rows if rng.random() > 0.05] + [row(k, length=61) for k in range(0, 400, 30)] + [row(3)] * 5
    a, b = table(spark, rows), table(spark, other)
    for first, second in ((a, b), (b, a)):
        assert found(D.diff_by_digest(first, second, buckets=4, cells=cells)) == found(diff_rows(first, second, None))


def test_nulls_count_by_their_column(spark):
    a = table(spark, [(START, "a", "b", 5, None, "", 1, ""), (START, "a", "b", None, 5, "", 1, "")])
    b = table(spark, [(START, "a", "b", 5, None, "", 1, "")] * 2)
    assert found(D.diff_by_digest(a, b)) == found(diff_rows(a, b, None)) != []
    assert found(D.diff_by_digest(b, a)) == found(diff_rows(b, a, None)) != []


def test_equal_and_empty_tables(spark):
    a, none = table(spark, [row(k) for k in range(50)]), table(spark, [])
    assert found(D.diff_by_digest(a, a)) == found(D.diff_by_digest(none, a)) == found(D.diff_by_digest(none, none)) == []
    assert found(D.diff_by_digest(a, none)) == found(a)


def test_only_differing_buckets_move_rows(spark):
    a = table(spark, [row(k) for k in range(2000)])
    b = table(spark, [row(k, length=99 if k == 77 else 60) for k in range(2000)])
    first, second = D.numbered(a, 16), D.numbered(b, 16)
    unequal = D.differing_buckets(D.bucket_digests(a, 16), D.bucket_digests(b, 16))
    hour = START + timedelta(minutes=7 * 77)
    hours = {r["chunk"] for r in unequal.collect()}
    assert hours == {hour.replace(minute=0)} and unequal.count() <= 2
    near = D._small(unequal)
    inside = D._within(first, near).count()
    assert 1 <= inside <= 9  # of the hour's packets, those of its bucket
    cells = D.lookup_cells(D._within(first, near), D._within(second, near))
    assert cells.count() <= 2 * D.TABLES  # equal rows are gone, two are left
    assert {(r["n"]) for r in D.differing_rows(D._within(first, near), D._within(second, near)).collect()} == {1, -1}


def test_stored_digests_spare_the_tables(spark, tmp_path):
    rows = [row(k) for k in range(100)]
    a, b = table(spark, rows), table(spark, rows[:-1])
    for name, df in (("a", a), ("b", b)):
        D.bucket_digests(df).write.parquet(f"{tmp_path}/{name}")
    stored = [spark.read.parquet(f"{tmp_path}/{n}") for n in "ab"]
    assert found(D.diff_by_digest(a, b, *stored)) == found(table(spark, rows[-1:]))
    chunks = D.chunk_digests(stored[0])
    assert chunks.agg(F.sum("rows")).first()[0] == 100


def test_peeling():
    cells = {}
    for number, n in {5: 3, -7: -1, 2**62: 2}.items():
        check, places = D._places(number, 32)
        for place in places:
            cell = cells.setdefault(place, [0, 0, 0])
            cell[0] += n
            cell[1] += n * number
            cell[2] += n * check
    assert D.peeled(cells, 32) == ({5: 3, -7: -1, 2**62: 2}, True)
    full = {}
    for number in range(200):
        check, places = D._places(number, 4)
        for place in places:
            cell = full.setdefault(place, [0, 0, 0])
            cell[0], cell[1], cell[2] = cell[0] + 1, cell[1] + number, cell[2] + check
    assert D.peeled(full, 4)[1] is False


def test_buckets_of_an_hour_are_peeled_by_one_call():
    """Each bucket of the call has its own outcome: a number, and too many to tell apart."""
    check, places = D._places(77, 32)
    rows = [(0, 5, place, 1, 77, check) for place in places] + [(0, 9, 3, 2, 10, 1), (0, 6, 4, 0, 0, 0)]
    cells = pd.DataFrame(rows, columns=["chunk", "_bucket", "cell", "n", "ids", "checks"])
    got = D._peel(32)(cells)
    assert [(b, None if pd.isna(i) else int(i), n) for b, i, n in zip(got["_bucket"], got["_id"], got["n"])] == [(5, 77, 1), (9, None, 0)]
