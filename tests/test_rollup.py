from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wirelake.operators import compaction, rollup, storage, traffic
from wirelake.schema import PACKETS, STORED_PACKETS


def packets(spark, rows):
    full = [(datetime(2024, 1, 1, h, m, s), f"10.0.0.{n % 5}", "10.1.0.1", n, None, "eth", 60 + n, "") for h, m, s, n in rows]
    return spark.createDataFrame(full, PACKETS)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "packets")
    storage.append_packets(packets(spark, [(h, m % 7, m, h * 31 + m) for h in range(5) for m in range(40)]), path)
    return path


def refreshed(spark, table, rolled, measure=rollup.PAIR_MINUTES, seen=None):
    def opened():
        df = spark.read.schema(STORED_PACKETS).parquet(table)
        if seen is not None:
            seen.append(df)
        return df

    return [c.hour for c in rollup.refresh(spark, opened, [table], rolled, measure)]


def same(spark, table, rolled):
    whole, kept = spark.read.parquet(table), rollup.stored_rollup(spark, rolled, rollup.PAIR_MINUTES)
    for full, quick in ((traffic.per_minute(whole), rollup.per_minute(kept)), (traffic.talkers_per_minute(whole), rollup.talkers_per_minute(kept))):
        assert sorted(map(str, full.collect())) == sorted(map(str, quick.select(*full.columns).collect()))


def test_only_changed_hours_are_counted(spark, table, tmp_path):
    rolled = str(tmp_path / "rollup")
    assert refreshed(spark, table, rolled) == [0, 1, 2, 3, 4]
    same(spark, table, rolled)
    opened = []
    assert refreshed(spark, table, rolled, seen=opened) == [] and not opened  # not even read
    storage.append_packets(packets(spark, [(1, 5, 5, 1), (6, 0, 0, 2)]), table)  # late, and new
    assert refreshed(spark, table, rolled) == [1, 6]
    same(spark, table, rolled)


def test_compacted_and_expired_hours(spark, table, tmp_path):
    rolled = str(tmp_path / "rollup")
    storage.append_packets(packets(spark, [(2, 5, 5, 1)]), table)
    refreshed(spark, table, rolled)
    assert compaction.compact_table(spark, table, "2024-01-02") >= 1
    assert 2 in refreshed(spark, table, rolled)
    same(spark, table, rolled)
    assert len(compaction.expire_folders(spark, table, "2024-01-02 02:30:00")) == 2
    assert refreshed(spark, table, rolled) == []
    assert {r["chunk"].hour for r in rollup.stored_rollup(spark, rolled, rollup.PAIR_MINUTES).collect()} == {2, 3, 4}
    same(spark, table, rolled)


def test_the_hours_reach_the_scan(spark, table):
    rows = spark.read.schema(STORED_PACKETS).parquet(table).filter(F.col("chunk").isin([datetime(2024, 1, 1, 3)]))
    plan = rollup.PAIR_MINUTES.run(rows)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk" in plan or "PartitionFilters: [(chunk" in plan


def test_merged_sketches_stay_within_their_error(spark, tmp_path):
    rows = spark.range(40_000).select(
        (F.lit(datetime(2024, 1, 1)).cast("timestamp") + F.make_interval(secs=F.col("id") % 36_000)).alias("ts"),
        (F.col("id") * 7919 % 40_000).alias("ms"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("proto"),
    )
    rows = rows.withColumn("landed", F.timestamp_millis(F.unix_millis("ts") + F.col("ms"))).withColumn("chunk", F.date_trunc("HOUR", "ts"))
    path, rolled = str(tmp_path / "p"), str(tmp_path / "r")
    rows.write.partitionBy("chunk").parquet(path)
    measure = rollup.latency_minutes(F.col("proto"))
    assert len(rollup.refresh(spark, lambda: spark.read.parquet(path), [path], rolled, measure)) == 10
    exact = {r["proto"]: r for r in rows.groupBy("proto").agg(
        F.count("*").alias("n"), F.min("ms").alias("lo"), F.max("ms").alias("hi"), F.count_if(F.col("ms") <= 1000).alias("ok"),
        F.sort_array(F.collect_list("ms")).alias("all"),
    ).collect()}
    for r in rollup.latency(rollup.stored_rollup(spark, rolled, measure)).collect():
        e = exact[r["grp"]]
        assert (r["packets"], r["min_ms"], r["max_ms"], r["in_time"]) == (e["n"], e["lo"], e["hi"], e["ok"])
        for q, name in ((0.5, "p50_ms"), (0.95, "p95_ms")):
            rank = sum(x <= r[name] for x in e["all"]) / e["n"]
            assert abs(rank - q) < 0.017


def test_no_table(spark, tmp_path):
    assert refreshed(spark, f"{tmp_path}/none", f"{tmp_path}/r") == []
