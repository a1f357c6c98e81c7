from pyspark.sql import functions as F

from wirelake.operators import reconcile as R
from wirelake.schema import PACKETS
from wirelake.plans import derived
from wirelake.operators.shape import shape_packets

import datetime as dt

T0 = dt.datetime(2024, 1, 1, 12, 30, 0, 123456)


def packets(spark, *rows):
    full = [(T0 + dt.timedelta(seconds=s), a, b, p, 443, "eth:ip:tcp", n, text) for s, a, b, p, n, text in rows]
    return spark.createDataFrame(full, PACKETS)


A = (0, "10.0.0.1", "10.0.0.2", 1000, 60, '{"a": 1}')
B = (1, "10.0.0.1", "10.0.0.3", None, 61, '{"b":2}')


def test_order_does_not_matter(spark, sf_dir):
    table = shape_packets(derived.ek_lines(derived.events(spark, sf_dir)))
    one = R.table_checksum(table).first()
    other = R.table_checksum(table.orderBy(F.rand(1)).repartition(13)).first()
    assert one == other and one.rows > 900


def test_checksum_by_hand(spark):
    import hashlib

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    row = R.table_checksum(packets(spark, A, B)).first()
    texts = [
        "2024-01-01T12:30:00.123456|10.0.0.1|10.0.0.2|1000|443|eth:ip:tcp|60",
        "2024-01-01T12:30:01.123456|10.0.0.1|10.0.0.3|~|443|eth:ip:tcp|61",
    ]
    assert row.digest == md5(str(sum(int(md5(t)[:8], 16) for t in texts)))
    assert row.payloads == md5(str(sum(int(md5(t)[:8], 16) for t in (A[-1], B[-1]))))


def test_empty_table(spark):
    empty = packets(spark, A).limit(0)
    row = R.table_checksum(empty).first()
    assert (row["rows"], row.digest, row.payloads) == (0, "empty", "empty")
    for a, b in ((empty, empty), (empty, packets(spark, A)), (packets(spark, A), empty)):
        report = R.verify_tables(a, b).first()
        assert not report.passed and report.problems == ["a side is empty"]


def test_verify(spark):
    same = R.verify_tables(packets(spark, A, B), packets(spark, B, A)).first()
    assert same.passed and same.problems == [] and same.rows_a == same.rows_b == 2
    fewer = R.verify_tables(packets(spark, A, B), packets(spark, A)).first()
    assert fewer.problems[0] == "rows differ: 2 and 1" and not fewer.passed
    text = packets(spark, A, (*B[:-1], '{"b": 2}'))
    raw = R.verify_tables(packets(spark, A, B), text).first()
    assert raw.problems == ["payloads differ"]
    assert R.verify_tables(packets(spark, A, B), text, canonical=True).first().passed


def test_canonical_payload_falls_back_on_repeated_keys(spark):
    double = packets(spark, (*A[:-1], '{"a":1,"a":2}'))
    assert R.verify_tables(double, double, canonical=True).first().passed


def test_diff_counts_copies(spark):
    a, b = packets(spark, A, A, A, B), packets(spark, A, B, B)
    assert [r.src_port for r in R.diff_rows(a, b).collect()] == [1000, 1000]
    assert [r.src_port for r in R.diff_rows(b, a).collect()] == [None]
    assert R.diff_rows(a, b, 1).count() == 1
    assert "payload" not in R.diff_rows(a, b).columns


def test_many_copies_are_given_out_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(R, "_COPIES", 100)
    many = packets(spark, A).withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(1050)))).drop("i")
    out = R.diff_rows(many, packets(spark, A, A), None)
    assert out.count() == 1048
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert out.select(F.spark_partition_id()).distinct().count() > 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert R.diff_rows(many, packets(spark, A), 7).count() == 7
    same = R.diff_rows(many, packets(spark, B), None).exceptAll(many.select(*R.SHAPED_COLUMNS))
    assert same.count() == 0
