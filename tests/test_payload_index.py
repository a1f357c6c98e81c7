import pytest
from pyspark.sql import functions as F

from wirelake.functions.payload import payload_contains
from wirelake.operators import payload_index as I
from wirelake.operators import storage
from wirelake.schema import PACKETS

DOCUMENTS = [
    '{"a": {"b": "x"}, "n": 443}', '{"a": {"b": "443"}, "n": "443"}', '{"a": [1, {"b": null}, [2.50]]}', '{"a": {}, "l": []}',
    '{"a": {"b": true}, "n": 443.0000000001}', '["x", 2.5, null, false]', '"x"', "443", "null", "not json", '{"n": -0.0, "n2": 1e300}',
    '{"a.b": "dot", "a": {"b\'c": "quote"}}', '{"deep": ' + '{"d": ' * 12 + '"end"' + "}" * 13, '{"a": {"b": "x"}, "a": {"b": "y"}}', '{"n": 0.1}',
]
PATTERNS = [
    {"a": {"b": "x"}}, {"a": {"b": "y"}}, {"n": 443}, {"n": "443"}, {"n": 443.0}, {"a": [1]}, {"a": [{"b": None}]}, {"a": [[2.5]]},
    {"a": {}}, {"l": []}, {}, [], ["x", 2.5], [None], [False], "x", 443, None, {"n": 0}, {"n": 0.1}, {"n2": 1e300}, {"a.b": "dot"},
    {"deep": {"d": {"d": {"d": {"d": {"d": {"d": {"d": {"d": {"d": {"d": {"d": {"d": "end"}}}}}}}}}}}}}, {"missing": 1}, {"a": {"b": True}}, {"a": {"b'c": "quote"}},
]


def packets(spark, documents, hour=0):
    rows = [(i, d) for i, d in enumerate(documents)]
    ts = F.to_timestamp(F.lit(f"2024-01-01 {hour:02}:00:00")) + F.make_interval(secs=F.col("i"))
    df = spark.createDataFrame(rows, "i int, payload string").select(
        ts.alias("ts"), F.lit("10.0.0.1").alias("src_ip"), F.lit("10.0.0.2").alias("dst_ip"), F.lit(None).cast("int").alias("src_port"),
        F.lit(None).cast("int").alias("dst_port"), F.lit("eth").alias("proto"), F.col("i").alias("length"), "payload",
    )
    return spark.createDataFrame(df.rdd, PACKETS)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A document per file, in hours of their own."""
    base = str(tmp_path_factory.mktemp("payloads"))
    for hour, document in enumerate(DOCUMENTS):
        packets(spark, [document], hour).withColumn("chunk", F.date_trunc("HOUR", "ts")).write.mode("append").partitionBy("chunk").parquet(f"{base}/t")
    assert I.index_payloads(spark, f"{base}/t", f"{base}/i") == len(DOCUMENTS)
    return base


@pytest.mark.parametrize("pattern", PATTERNS, ids=repr)
def test_same_packets_as_without_the_index(spark, stored, pattern):
    table = spark.read.parquet(f"{stored}/t")
    wanted = {r["payload"] for r in payload_contains(table, pattern).collect()}
    assert {r["payload"] for r in I.search_payloads(spark, f"{stored}/t", f"{stored}/i", pattern).collect()} == wanted


def test_only_files_with_the_values_are_read(spark, stored):
    def read(pattern, **times):
        return len(I.matching_files(spark, f"{stored}/t", f"{stored}/i", pattern, **times))

    assert len(spark.read.parquet(f"{stored}/t").inputFiles()) == len(DOCUMENTS)
    assert read({"a": {"b": "443"}}) == 1 and read({"a": {"b": "443"}, "n": "443"}) == 1
    assert read({"n": 443}) == 2 and read({"n": "no such"}) == 0
    assert read({"a": {"b": "x"}, "n": "443"}) == 0  # in no file together
    assert read({}) == len(DOCUMENTS)
    at = F.lit("2024-01-01 02:00:00").cast("timestamp")
    assert read({"n": 443}, low=at) == 1 and read({"n": 443}, high=at) == 1
    found = I.search_payloads(spark, f"{stored}/t", f"{stored}/i", {"n": 443}, high=at)
    assert len(found.inputFiles()) == 1 and found.count() == 1


def test_files_of_one_write_share_a_name(spark, tmp_path):
    """A task names its files in all hours alike, so an hour belongs to a file's name."""
    table, index = f"{tmp_path}/t", f"{tmp_path}/i"
    two = packets(spark, DOCUMENTS[:1], 1).unionByName(packets(spark, DOCUMENTS[1:2], 2)).coalesce(1)
    two.withColumn("chunk", F.date_trunc("HOUR", "ts")).write.partitionBy("chunk").parquet(table)
    assert len({f.rsplit("/", 1)[1] for f in spark.read.parquet(table).inputFiles()}) == 1
    assert I.index_payloads(spark, table, index) == 2
    for pattern in ({"a": {"b": "x"}}, {"n": "443"}):
        assert len(I.matching_files(spark, table, index, pattern)) == 1 and I.search_payloads(spark, table, index, pattern).count() == 1


def test_new_files_are_read_until_they_are_indexed(spark, tmp_path):
    table, index, pattern = f"{tmp_path}/t", f"{tmp_path}/i", {"a": {"b": "x"}}
    storage.append_packets(packets(spark, DOCUMENTS[:1]), table)
    assert I.search_payloads(spark, table, index, pattern).count() == 1  # no index at all
    assert I.index_payloads(spark, table, index) == 1 and I.index_payloads(spark, table, index) == 0
    storage.append_packets(packets(spark, DOCUMENTS[1:3], 1), table)
    assert len(I.matching_files(spark, table, index, {"a": {"b": "443"}})) >= 1
    assert I.search_payloads(spark, table, index, pattern).count() == 1
    fresh = len(spark.read.parquet(table).inputFiles()) - 1
    assert I.index_payloads(spark, table, index) == fresh
    assert len(I.matching_files(spark, table, index, pattern)) == 1


def test_hashes_reach_the_scan(spark, stored):
    pairs = spark.read.schema("pair BIGINT, file STRING, chunk TIMESTAMP").parquet(f"{stored}/i/pairs").filter(F.col("pair").isin([1, 2]))
    assert "In(pair" in pairs._jdf.queryExecution().executedPlan().toString()
