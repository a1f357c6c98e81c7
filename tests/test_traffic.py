import json

import pytest
from pyspark.sql import functions as F

from wirelake.functions.payload import contains, payload_contains, payload_variant, promoted
from wirelake.functions.text import leaf_protocol, mebibytes, proto_parts
from wirelake.operators import traffic as Q
from wirelake.operators.shape import dead_letters, good_packets, shape_lines
from tests.test_reconcile import A, B, packets
from tests.test_shape import doc

DOCUMENT = {"a": {"b": "443", "n": 443, "x": 1.5, "t": True, "z": None}, "l": [1, "two", {"k": [3]}], "e": {}}

CONTAINMENT = [
    ({}, True), ({"a": {}}, True), ({"a": {"b": "443"}}, True), ({"a": {"b": 443}}, False),
    ({"a": {"n": 443}}, True), ({"a": {"n": 443.0}}, True), ({"a": {"n": "443"}}, False),
    ({"a": {"x": 1.5}}, True), ({"a": {"t": True}}, True), ({"a": {"t": 1}}, False), ({"a": {"z": None}}, True),
    ({"a": {"missing": None}}, False), ({"l": [1]}, True), ({"l": ["two", 1]}, True), ({"l": [{"k": [3]}]}, True),
    ({"l": [{"k": [4]}]}, False), ({"l": 1}, False), ({"l": []}, True), ({"a": []}, False), ({"e": {}}, True),
    ({"b": "443"}, False), ([], False), ("x", False),
]


@pytest.mark.parametrize("pattern,wanted", CONTAINMENT, ids=[json.dumps(p) for p, _ in CONTAINMENT])
def test_containment(spark, pattern, wanted):
    df = spark.createDataFrame([(json.dumps(DOCUMENT),)], "p STRING")
    assert df.select(contains(payload_variant(F.col("p")), pattern)).first()[0] is wanted


def test_containment_at_the_top(spark):
    df = spark.createDataFrame([('["x", 1]',), ('"x"',), ("1",), ('{"a":1,"a":2}',)], "p STRING")
    got = [r[0] for r in df.select(contains(payload_variant(F.col("p")), "x")).collect()]
    assert got == [True, True, False, False]


def test_of_a_repeated_key_the_last_value_counts(spark):
    df = spark.createDataFrame([('{"a":1,"a":2}',), ('{"a":{"b":1},"a":{"c":3}}',)], "payload STRING")
    assert [payload_contains(df, p).count() for p in ({"a": 1}, {"a": 2}, {"a": {"b": 1}}, {"a": {"c": 3}})] == [0, 1, 0, 1]


def test_a_host_in_any_form(spark):
    df = spark.createDataFrame([("2001:db8::1", "10.0.0.1", 1, 2, "ip")], "src_ip STRING, dst_ip STRING, src_port INT, dst_port INT, proto STRING")
    assert [df.filter(Q.traffic_filter(host=h)).count() for h in ("2001:DB8:0:0::1", "10.0.0.1", "10.0.0.2", "name")] == [1, 1, 0, 0]


def test_promoted_columns(spark):
    df = spark.createDataFrame([('{"l":{"h":{"x":"v"},"d":5}}',), ("{}",), ("broken",)], "p STRING")
    rows = df.select(promoted(F.col("p"), {"x": ("l", "h", "x"), "d": ("l", "d")}).alias("s")).select("s.*").collect()
    assert [tuple(r) for r in rows] == [("v", "5"), (None, None), (None, None)]


def test_filters(spark):
    df = packets(spark, A, B)
    assert df.filter(Q.traffic_filter("tcp", 443)).count() == 2
    assert df.filter(Q.traffic_filter("udp")).count() == 0
    assert df.filter(Q.traffic_filter(port=1000)).count() == 1
    assert df.filter(Q.traffic_filter(port=1000, negate=True)).count() == 1
    assert df.filter(Q.traffic_filter(host="10.0.0.3")).count() == 1
    assert df.filter(Q.traffic_filter(host="10.0.0.3", negate=True)).count() == 1
    assert df.filter(Q.traffic_filter()).count() == 2


def test_latest_and_top(spark):
    df = packets(spark, A, A, B)
    assert Q.row_count(df).first().n == 3
    assert Q.latest_packets(df, 1).first().dst_ip == "10.0.0.3"
    assert [(r.dst_ip, r.cnt) for r in Q.top_talkers(df, 2).collect()] == [("10.0.0.2", 2), ("10.0.0.3", 1)]
    plan = Q.top_talkers(df)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_busy_minute_is_limited_before_the_shuffle(spark):
    plan = Q.talkers_per_minute(packets(spark, A, B), 1)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_dedup_keeps_one_copy(spark):
    df = packets(spark, A, A, B, (*A[:4], 10, "{}"))
    rows = {r.dst_ip: r for r in Q.dedup_packets(df).collect()}
    assert rows["10.0.0.2"].copies == 3 and rows["10.0.0.2"].length == 10 and rows["10.0.0.2"].payload == "{}"
    assert rows["10.0.0.3"].copies == 1 and len(rows["10.0.0.3"].msg_id) == 64


def test_reconcile_counts(spark):
    lines = spark.createDataFrame([(doc(timestamp=str(t)),) for t in range(10)] + [("x",), ("y",), ("x",)], "value STRING")
    shaped = shape_lines(lines)
    stored, letters = good_packets(shaped), dead_letters(shaped, F.current_timestamp())

    def judged(packets, bad=letters):
        r = Q.reconcile_counts(shaped, packets, bad).first()
        return r.status, r.lines_in, r.packets, r.dead_letters, r.distinct_ids, r.lost, r.doubled, r.duplicates

    assert judged(stored) == ("complete", 13, 10, 3, 10, 0, 0, 0)
    early = F.unix_millis("ts") < 5
    # as many lost as stored twice, which totals cannot show
    assert judged(stored.filter(early).union(stored.filter(early))) == ("lost_and_doubled", 13, 10, 3, 5, 5, 5, 5)
    assert judged(stored.filter(early)) == ("lost", 13, 5, 3, 5, 5, 0, 0)
    assert judged(stored.union(stored)) == ("doubled", 13, 20, 3, 10, 0, 10, 10)
    assert judged(stored, letters.limit(0)) == ("lost", 13, 10, 0, 10, 3, 0, 0)
    assert judged(stored, letters.filter("raw_ek_line = 'x'").limit(1))[5] == 2
    none = Q.reconcile_counts(shaped.limit(0), stored.limit(0), letters.limit(0)).first()
    assert none.status == "empty" and none.lines_in == 0


def test_latency(spark):
    df = packets(spark, A, B).withColumn("landed", F.expr("ts + INTERVAL 0.9 SECOND"))
    row = Q.ingest_latency(df, "landed").first()
    assert (row.packets, row.min_ms, row.p95_ms, row.in_time) == (2, 900, 900, 2)


def test_exact_latency(spark):
    delays = [*range(1, 100), 5000]
    df = spark.createDataFrame([(k, d) for k, d in enumerate(delays)], "k INT, d INT").select(
        F.timestamp_millis("k").alias("ts"), F.timestamp_millis(F.col("k") + F.col("d")).alias("landed")
    )
    row = Q.ingest_latency(df, "landed", accuracy=None).first()
    assert (row.packets, row.min_ms, row.max_ms, row.p50_ms, row.p95_ms, row.in_time) == (100, 1, 5000, 50, 95, 99)


def test_text_functions(spark):
    df = spark.createDataFrame([("eth:ip:tcp",), ("",), ("arp",)], "p STRING")
    rows = df.select(proto_parts(F.col("p")), leaf_protocol(F.col("p"))).collect()
    assert [tuple(r) for r in rows] == [(["eth", "ip", "tcp"], "tcp"), ([], ""), (["arp"], "arp")]
    sizes = spark.createDataFrame([(14680064.0,), (0.25 * 1048576,), (4e7,)], "b DOUBLE")
    assert [r[0] for r in sizes.select(mebibytes(F.col("b"))).collect()] == ["14.0 MiB", "0.2 MiB", "38.1 MiB"]
