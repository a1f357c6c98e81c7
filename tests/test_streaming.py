import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from wirelake.operators import counters, storage
from wirelake.operators.shape import dead_letters, shape_lines, shape_packets
from wirelake.plans import derived
from wirelake.session import run_folder, state_on_disk
from wirelake.sources.ek import ek_stream
from wirelake.streaming import fanout, ingest, packets
from wirelake.streaming.packets import dedup_stream, per_minute_stream
from tests.conftest import at
from tests.test_shape import doc

ONCE = {"availableNow": True}


def write_lines(spark, sf_dir, folder, files=6):
    lines = derived.raw_lines(derived.events(spark, sf_dir)).orderBy("event_id", "line_no").select("value")
    lines.repartition(files).write.mode("append").text(folder)


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_stream_lands_what_batch_finds(spark, sf_dir):
    folder = run_folder(spark, "s")
    write_lines(spark, sf_dir, f"{folder}/in")
    stream = ek_stream(spark, f"{folder}/in", max_files_per_trigger=2)
    run(ingest.ingest_stream(stream, folder, f"{folder}/cp", trigger=ONCE))

    shaped = shape_lines(derived.ek_lines(derived.events(spark, sf_dir)))
    good, bad = shaped.filter("reason IS NULL"), shaped.filter("reason IS NOT NULL")
    stored = ingest.stored_packets(spark, folder)
    assert stored.select("batch_id").distinct().count() == 3
    columns = ["ts", "src_ip", "dst_ip", "src_port", "dst_port", "proto", "length", "payload"]
    assert stored.select(columns).exceptAll(good.select(columns)).count() == 0
    assert stored.count() == good.count()
    letters = ingest.stored_dead_letters(spark, folder)
    assert letters.select("error", "raw_ek_line").exceptAll(bad.select("error", "payload")).count() == 0
    assert letters.count() == bad.count()

    totals = ingest.run_metrics(spark, folder).groupBy("name").agg(F.max("value").alias("v"))
    totals = {r.name: r.v for r in totals.collect()}
    assert totals["worker_rows_inserted_total"] == good.count()
    assert totals["worker_deadletter_total"] == bad.count()
    assert totals["ingestor_lines_read_total"] == shaped.count()
    assert totals["worker_batch_flush_total"] == 3
    assert totals["worker_db_errors_total"] == 0
    assert totals["worker_buffer_size"] == 0 and totals["ingestor_msgs_published_total"] == shaped.count()


def test_restart_continues_and_a_repeated_batch_is_not_doubled(spark, sf_dir):
    folder = run_folder(spark, "s")
    write_lines(spark, sf_dir, f"{folder}/in", files=2)
    start = lambda: ingest.ingest_stream(ek_stream(spark, f"{folder}/in", 1), folder, f"{folder}/cp", trigger=ONCE)
    run(start())
    first = ingest.stored_packets(spark, folder).count()
    write_lines(spark, sf_dir, f"{folder}/in", files=1)
    run(start())
    assert ingest.stored_packets(spark, folder).count() == 2 * first

    # The last micro-batch is run again, as after a crash before its offsets were recorded.
    batch = spark.read.text(f"{folder}/in").filter(F.col("value").contains("timestamp")).limit(50)
    ingest.write_batch(batch, 99, f"{folder}/again")
    ingest.write_batch(batch, 99, f"{folder}/again")
    landed = ingest.stored_packets(spark, f"{folder}/again").count()
    landed += ingest.stored_dead_letters(spark, f"{folder}/again").count()
    assert landed == 50
    assert ingest.run_metrics(spark, f"{folder}/again").filter("name = 'ingestor_lines_read_total'").first().value == 50


def test_batches_without_packets_or_without_dead_letters(spark):
    folder = run_folder(spark, "s")
    ingest.write_batch(spark.createDataFrame([("x",)], "value STRING"), 0, folder)
    ingest.write_batch(spark.createDataFrame([(doc(),)], "value STRING"), 1, folder)
    assert ingest.stored_packets(spark, folder).count() == 1
    assert ingest.stored_dead_letters(spark, folder).count() == 1


def test_stream_into_a_table_with_retention(spark):
    folder = run_folder(spark, "s")
    storage.create_packets_table(spark, "live_packets", by_batch=True)
    hour = 3_600_000
    lines = spark.createDataFrame([(doc(timestamp=str(t * hour)),) for t in range(30)] + [("x",)], "value STRING")
    lines.repartition(1).write.text(f"{folder}/in")
    stream = ek_stream(spark, f"{folder}/in")
    run(ingest.ingest_stream(stream, folder, f"{folder}/cp", table="live_packets", trigger=ONCE))
    assert spark.table("live_packets").count() == 30
    for _ in range(2):
        ingest.write_batch(lines.limit(1), 7, folder, "live_packets")
    assert spark.table("live_packets").count() == 31
    parts = [r["partition"] for r in spark.sql("SHOW PARTITIONS live_packets").collect()]
    assert all(p.startswith("chunk=") and "/batch_id=" in p for p in parts)  # the hour on top
    now = dt.datetime(1970, 1, 2, 2)
    assert storage.expire_chunks(spark, "live_packets", now) == ["1970-01-01 00:00:00", "1970-01-01 01:00:00"]
    assert spark.table("live_packets").count() == 28
    assert storage.expire_chunks(spark, "live_packets", now) == []


def test_failed_write_is_counted_and_raised(spark, tmp_path, monkeypatch):
    line = spark.createDataFrame([(doc(),)], "value STRING")
    ingest.write_batch(line, 0, str(tmp_path))


    def broken(*args):
        raise OSError("the store is away")

    with monkeypatch.context() as patch, pytest.raises(OSError, match="away"):
        patch.setattr(ingest, "_overwrite", broken)
        ingest.write_batch(line, 1, str(tmp_path))
    assert [r.delta for r in ingest.failed_writes(spark, str(tmp_path)).collect()] == [1.0]
    ingest.write_batch(line, 2, str(tmp_path))
    errors = ingest.run_metrics(spark, str(tmp_path)).filter("name = 'worker_db_errors_total'").orderBy("scrape_ts")
    assert [r.value for r in errors.collect()] == [0.0, 1.0, 1.0]


def test_the_gate_judges_our_own_run(spark):
    folder = run_folder(spark, "s")
    for k in range(2):
        ingest.write_batch(spark.createDataFrame([(doc(),)] * 5, "value STRING"), k, folder)
    samples = ingest.run_metrics(spark, folder)
    assert counters.soak_gate(samples, max_rss_bytes=64e9).first().passed  # all required metrics are there
    assert counters.soak_gate(samples, max_rss_bytes=64e9, min_elapsed_s=1800).first().failures == ["run_too_short"]
    assert counters.soak_gate(samples, max_rss_bytes=1).first().failures == ["memory_over_limit"]


def test_fan_out(spark, sf_dir):
    folder = run_folder(spark, "s")
    write_lines(spark, sf_dir, f"{folder}/in", files=2)
    sinks = {
        "packets": fanout.parquet_sink(f"{folder}/packets", ONCE),
        "letters": fanout.dead_letter_sink(f"{folder}/letters", ONCE),
        "lines": fanout.line_sink(f"{folder}/lines", ONCE),
    }
    for query in fanout.fan_out(ek_stream(spark, f"{folder}/in"), sinks, f"{folder}/cp").values():
        run(query)
    packets = spark.read.parquet(f"{folder}/packets").count()
    letters = [json.loads(r[0]) for r in spark.read.text(f"{folder}/letters").collect()]
    assert packets + len(letters) == spark.read.text(f"{folder}/lines").count() == 1000
    assert all(list(letter) == ["error", "raw_ek_line", "ts"] for letter in letters)


def _packet_stream(spark, folder, lines):
    spark.createDataFrame([(line,) for line in lines], "value STRING").coalesce(1).write.mode("append").text(folder)
    return shape_packets(ek_stream(spark, folder, 1))


@pytest.mark.parametrize("salts", [1, 4])
def test_dedup_stream(spark, salts):
    folder = run_folder(spark, "s")
    _packet_stream(spark, f"{folder}/in", [doc()] * 20 + [doc(timestamp="1755123456322")])
    packets = _packet_stream(spark, f"{folder}/in", [doc()] * 20)
    run(
        dedup_stream(packets, salts=salts).drop("payload").writeStream.format("parquet")
        .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp").trigger(**ONCE).start()
    )
    assert spark.read.parquet(f"{folder}/out").count() == 2


def test_dedup_stream_keeps_each_id_once(spark):
    folder, provider = run_folder(spark, "s"), spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for _ in range(2):  # copies come from other tasks of the same and of a later micro-batch
        packets = _packet_stream(spark, f"{folder}/in", [doc(timestamp=str(1755123456000 + t)) for t in range(30)] * 20)
        kept = dedup_stream(packets, late="10 days")
        with state_on_disk(spark):
            query = (
                kept.writeStream.format("parquet").option("path", f"{folder}/out")
                .option("checkpointLocation", f"{folder}/cp").trigger(**ONCE).start()
            )
        run(query)
        states = [p["stateOperators"] for p in query.recentProgress]
        assert states and all(len(s) == 1 and any("rocksdb" in m for m in s[0]["customMetrics"]) for s in states)
    assert spark.read.parquet(f"{folder}/out").count() == 30
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == provider


def test_first_of_equal_ids_in_a_batch(spark):
    rows = spark.createDataFrame([(k, None if k % 5 == 0 else str(k % 3)) for k in range(3000)], "k int, id string").coalesce(1)
    kept = rows.filter(packets._first_of_batch()("id")).collect()
    assert {r["id"] for r in kept} == {None, "0", "1", "2"} and len(kept) == 4


def test_per_minute_stream(spark):
    folder = run_folder(spark, "s")
    minute = 60_000
    packets = _packet_stream(spark, f"{folder}/in", [doc(timestamp=str(t)) for t in (0, 1, minute, 10 * minute)])
    run(
        per_minute_stream(packets).writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/cp").trigger(**ONCE).start()
    )
    got = spark.read.parquet(f"{folder}/out").orderBy("minute").collect()
    assert [(r.packets, r.bytes) for r in got] == [(2, 1804), (1, 902)]


def test_dead_letters_take_the_given_time(spark):
    shaped = shape_lines(spark.createDataFrame([("x",)], "value STRING"))
    assert dead_letters(shaped, at("1970-01-01 00:01:00")).first().ts == 60
