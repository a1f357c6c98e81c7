import datetime as dt

import pytest
from pyspark.sql import functions as F

from wirelake.functions.identifiers import checked_name
from wirelake.operators import storage as S, traffic
from wirelake.operators.shape import shape_packets
from wirelake.plans import derived
from wirelake.schema import PACKET_COLUMNS
from wirelake.sources.tables import packets_path, packets_table
from wirelake.session import run_folder
from tests.conftest import at
from tests.test_reconcile import A, packets


def spread_packets(spark, hours):
    one = packets(spark, A)
    return one.withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(hours - 1)))).withColumn(
        "ts", F.expr("ts + make_interval(0, 0, 0, 0, h)")
    ).select(*PACKET_COLUMNS)


@pytest.mark.parametrize("name", ["a b", "7days", "t;t", "t-t", "", "t'", "t.u.v;", "(t", "t\t", "t/*", "é"])
def test_refused_names(name):
    with pytest.raises(ValueError):
        checked_name(name)


@pytest.mark.parametrize("name", ["t", "hourly_2024", "__", "Mixed9"])
def test_accepted_names(name):
    assert checked_name(name) == name


def test_append_keeps_all_rows(spark, sf_dir):
    rows = shape_packets(derived.ek_lines(derived.events(spark, sf_dir)))
    path = run_folder(spark, "t")
    S.append_packets(rows, path)
    S.append_packets(rows, path, in_time_order=True)
    stored = packets_path(spark, path)
    assert stored.count() == 2 * rows.count()
    assert stored.select(*PACKET_COLUMNS).exceptAll(rows.union(rows)).count() == 0
    assert stored.filter("chunk <> date_trunc('HOUR', ts)").count() == 0


def test_time_range_prunes_chunks(spark):
    path = run_folder(spark, "t")
    S.append_packets(spread_packets(spark, 30), path)
    low, high = "2024-01-01 14:00:00", "2024-01-01 16:10:00"
    found = traffic.talker_lookback(packets_path(spark, path), "10.0.0.1", "10.0.0.2", at(low), at(high))
    assert sorted(r.ts.hour for r in found.select("ts").collect()) == [14, 15]
    assert len(found.inputFiles()) == 30  # the table
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(chunk" in plan and "PushedFilters: [IsNotNull(src_ip)" in plan
    scanned = found.select(F.input_file_name()).distinct().count()
    assert scanned == 2


def test_talker_layout_splits_a_hot_hour_and_pair(spark):
    hot = packets(spark, A).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(19999)))).withColumn(
        "ts", F.expr("timestamp_millis(1704110400000 + i)")
    ).select(*PACKET_COLUMNS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = S.talker_layout(hot).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) == 8 and max(r["count"] for r in parts) < 6000


def test_retention_drops_whole_chunks_only(spark):
    path = run_folder(spark, "t")
    S.append_packets(spread_packets(spark, 30), path)
    now = "2024-01-02 13:45:00"
    kept = S.retained(packets_path(spark, path), at(now))
    # 12:30 lies more than a day back, 13:30 does too but its chunk does not.
    assert kept.agg(F.min("ts")).first()[0].hour == 13
    assert S.retained(spread_packets(spark, 30), at(now)).count() == kept.count() == 29


def test_catalog_table(spark, monkeypatch):
    S.create_packets_table(spark, "packets_t")
    monkeypatch.setattr(S, "DROPPED_AT_ONCE", 1)
    S.append_to_table(spread_packets(spark, 30), "packets_t")
    S.append_to_table(spread_packets(spark, 1), "packets_t")
    assert packets_table(spark, "packets_t").count() == 31
    S.create_table_like(spark, "packets_like", "packets_t")
    S.create_table_like(spark, "packets_like", "packets_t")
    assert packets_table(spark, "packets_like").columns == packets_table(spark, "packets_t").columns
    assert packets_table(spark, "packets_like").count() == 0
    now = dt.datetime(2024, 1, 2, 14, 0, 0)
    assert S.expire_chunks(spark, "packets_t", now) == ["2024-01-01 12:00:00", "2024-01-01 13:00:00"]
    assert S.expire_chunks(spark, "packets_t", now) == []
    assert packets_table(spark, "packets_t").count() == 28
    S.truncate_table(spark, "packets_t")
    assert packets_table(spark, "packets_t").count() == 0
    with pytest.raises(ValueError):
        S.truncate_table(spark, "packets_t; x")


def test_variant_column_is_stored(spark, tmp_path):
    S.with_payload_variant(packets(spark, A)).write.parquet(str(tmp_path / "v"))
    row = spark.read.parquet(str(tmp_path / "v")).select(F.try_variant_get("payload_variant", "$.a", "int")).first()
    assert row[0] == 1
