import random
from fractions import Fraction

import pytest
from pyspark.sql import Window, functions as F

from wirelake.operators.pacing import batch_by_count, pace_schedule
from wirelake.operators.scan import BLOCK, in_blocks, ordinal, previous, running
from tests.conftest import seconds


def _rows(spark, n=3000):
    r = random.Random(3)
    # A third of the rows share one key; keys may be NULL; order values have gaps.
    keys = ["hot" if r.random() < 0.34 else r.choice(["a", "b", None, "c"]) for _ in range(n)]
    places = r.sample(range(-5000, 1_000_000), n)
    return spark.createDataFrame(
        [(k, p, r.choice([None, r.randrange(100)])) for k, p in zip(keys, places)], "k STRING, i BIGINT, v BIGINT"
    ).repartition(8)


def test_running_equals_a_plain_window(spark):
    rows = _rows(spark)
    whole = Window.partitionBy("k").orderBy("i")
    for how, fold in (("sum", F.sum), ("max", F.max)):
        for inclusive, last in ((True, 0), (False, -1)):
            got = running(rows, ("k",), "i", F.col("v"), how, "got", inclusive=inclusive)
            wanted = fold("v").over(whole.rowsBetween(Window.unboundedPreceding, last))
            assert got.count() == rows.count()
            assert got.withColumn("wanted", wanted).filter("NOT (got <=> wanted)").count() == 0, (how, inclusive)
            assert got.columns == ["k", "i", "v", BLOCK, "got"]


def test_ordinal_and_previous(spark):
    rows = _rows(spark)
    whole = Window.partitionBy("k").orderBy("i")
    got = previous(ordinal(rows, ("k",), "i"), ("k",), "i", F.col("v"), "p")
    wrong = got.withColumn("n", F.row_number().over(whole) - 1).withColumn("q", F.lag("v").over(whole))
    assert wrong.filter("NOT (n <=> ordinal) OR NOT (p <=> q)").count() == 0


def test_no_window_spans_a_whole_key(spark):
    """Rows are only ever windowed within a range; whole keys hold one row per range."""
    plan = running(_rows(spark), ("k",), "i", F.col("v"), "sum", "s")._jdf.queryExecution().optimizedPlan()
    windows = [line for line in plan.toString().split("\n") if "Window [" in line]
    assert len(windows) == 2
    assert any("_is_carry" in w and BLOCK in w for w in windows)


@pytest.mark.parametrize("step", [1, 2**40])
def test_a_hot_key_is_split_however_dense_its_order(spark, step):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(F.lit(-1)).alias("k"),
        (F.col("id") * step).alias("i"),
        F.lit(1).alias("v"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in in_blocks(rows, ("k",), "i").groupBy(BLOCK).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 10_000


def _paced(arrivals, gap):
    due, out = None, []
    for a in arrivals:
        due = a if due is None else max(a, due + gap)
        out.append(due)
    return out


def test_pace_equals_the_loop(spark):
    r = random.Random(5)
    rows, wanted = [], {}
    for key in ("x", "y"):
        at, arrivals = 0, []
        for i in range(400):
            at += r.choice([0, 0, 1, 3, 40]) * 1000
            arrivals.append(at)
            rows.append((key, i * 3, at / 1e6))
        wanted[key] = _paced(arrivals, 10_000)
    df = seconds(spark, rows, "key STRING, seq BIGINT, arrival DOUBLE", "arrival").repartition(8)
    out = pace_schedule(df, ("key",), "seq", 100.0)
    for key in wanted:
        got = [r[0] for r in out.filter(F.col("key") == key).orderBy("seq").select(F.unix_micros("emit_at")).collect()]
        assert got == wanted[key]


def test_pace_examples(spark):
    ten = seconds(spark, [("k", i, 0.0) for i in range(10)], "key STRING, seq BIGINT, arrival DOUBLE", "arrival")
    last = pace_schedule(ten, ("key",), "seq", 200).agg(F.max(F.unix_micros("emit_at"))).first()[0]
    assert last == 45_000
    assert pace_schedule(ten, ("key",), "seq", 0).filter("emit_at = arrival").count() == 10
    stalled = seconds(
        spark, [("k", 0, 0.0), ("k", 1, 0.05), ("k", 2, 0.05)], "key STRING, seq BIGINT, arrival DOUBLE", "arrival"
    )
    times = [
        r[0] for r in pace_schedule(stalled, ("key",), "seq", 1000).orderBy("seq").select(F.unix_micros("emit_at")).collect()
    ]
    assert times == [0, 50_000, 51_000]


@pytest.mark.parametrize("rate", [3_000, 3_000_000, 7, 0.3])
def test_pace_at_rates_that_do_not_divide_a_second(spark, rate):
    n = 6001
    rows = spark.range(n).select(F.lit("k").alias("key"), F.col("id").alias("seq"), F.lit(0).cast("timestamp").alias("arrival"))
    got = [r[0] for r in pace_schedule(rows, ("key",), "seq", rate).orderBy("seq").select(F.unix_micros("emit_at")).collect()]
    gap = 1_000_000 / Fraction(str(rate))
    assert got == [-(-(i * gap).numerator // (i * gap).denominator) for i in range(n)]


def test_batch_by_count(spark):
    rows = spark.createDataFrame([("k", i * 7) for i in range(8)], "key STRING, seq BIGINT")
    got = [r.batch_no for r in batch_by_count(rows, ("key",), "seq", 3).orderBy("seq").collect()]
    assert got == [0, 0, 0, 1, 1, 1, 2, 2]
