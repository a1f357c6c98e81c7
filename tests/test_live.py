"""Streams beside what is stored: copies, rows at fault, what waits, and live rates."""

import random
from datetime import datetime
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wirelake.operators import counters
from wirelake.operators.shape import shape_packets
from wirelake.session import run_folder
from wirelake.sources.ek import ek_stream
from wirelake.sources.tables import packets_path
from wirelake.streaming import backlog, heavy, ingest, isolate
from wirelake.streaming.packets import dedup_into, refuse_stored, stored_copies
from wirelake.streaming.rates import WindowedRate, live_rates
from tests.test_shape import doc

ONCE = {"availableNow": True}
MINUTE = 60_000
START = 1_704_067_200_000


def land(spark, folder, lines):
    spark.createDataFrame([(line,) for line in lines], "value STRING").coalesce(1).write.mode("append").text(folder)


def test_a_copy_beyond_the_watermark_is_refused(spark):
    folder = run_folder(spark, "s")

    def deliver(lines):
        land(spark, f"{folder}/in", lines)
        packets = shape_packets(ek_stream(spark, f"{folder}/in", 1))
        dedup_into(packets, f"{folder}/out", f"{folder}/cp", late="365 days", trigger=ONCE).awaitTermination()
        return packets_path(spark, f"{folder}/out").count()

    assert deliver([doc(timestamp=str(START + t * MINUTE)) for t in (0, 1, 1, 90)]) == 3
    assert deliver([doc(timestamp=str(START + 900 * 24 * 60 * MINUTE))]) == 4  # the watermark passes the first ones
    batch = shape_packets(spark.createDataFrame([(doc(timestamp=str(START + t * MINUTE)),) for t in (0, 0, 90, 91)], "value STRING"))
    rows = batch.withColumn("chunk", F.date_trunc("HOUR", "ts"))
    stored = packets_path(spark, f"{folder}/out")
    assert stored_copies(rows, stored).count() == 2
    assert [r["ts"].minute for r in refuse_stored(rows, stored).collect()] == [31]
    # in another stream, whose state never saw the first ones
    land(spark, f"{folder}/more", [doc(timestamp=str(START + t * MINUTE)) for t in (0, 1, 5)])
    packets = shape_packets(ek_stream(spark, f"{folder}/more"))
    dedup_into(packets, f"{folder}/out", f"{folder}/cp2", first_batch=1000, trigger=ONCE).awaitTermination()
    assert packets_path(spark, f"{folder}/out").count() == 5


def test_only_hours_of_the_batch_are_read(spark):
    folder = run_folder(spark, "s")
    land(spark, f"{folder}/in", [doc(timestamp=str(START + h * 60 * MINUTE)) for h in range(5)])
    dedup_into(shape_packets(ek_stream(spark, f"{folder}/in")), f"{folder}/out", f"{folder}/cp", late="365 days", trigger=ONCE).awaitTermination()
    batch = shape_packets(spark.createDataFrame([(doc(timestamp=str(START + 2 * 60 * MINUTE)),)], "value STRING")).withColumn("chunk", F.date_trunc("HOUR", "ts"))
    plan = stored_copies(batch, packets_path(spark, f"{folder}/out"))._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "dst_port" in line)
    assert "payload" not in scan and "chunk" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_rows_at_fault_are_found(spark):
    rows = spark.range(300).select(F.col("id"), F.lit(None).cast("string").alias("x"))
    tries = []

    def attempt(part):
        tries.append(1)
        part.select(F.when(F.col("id").isin(7, 250), F.raise_error(F.lit("no"))).otherwise(F.col("id"))).write.format("noop").mode("overwrite").save()

    refused = isolate.isolate(rows, attempt)
    assert {r["id"] for r in isolate.only(rows, refused).collect()} == {7, 250} and isolate.without(rows, refused).count() == 298
    assert len(tries) < 60

    def away(part):
        raise OSError("away")

    assert isolate.isolate(rows, away, most=3) == []  # every row fails: the store, not the rows


def test_many_rows_at_fault_are_found(spark, monkeypatch):
    monkeypatch.setattr(isolate, "PART_ROWS", 1 << 7)
    rows = spark.range(20_000).select("id", F.lit(None).cast("string").alias("x")).union(spark.range(1).select("id", F.lit("copy").alias("x")))

    def attempt(part):
        part.select(F.when(F.col("id") % 190 == 0, F.raise_error(F.lit("no"))).otherwise(F.col("id"))).write.format("noop").mode("overwrite").save()

    refused = isolate.isolate(rows, attempt)
    assert len(refused) == len(set(refused)) == 107  # more than a hundred
    assert isolate.only(rows, refused).filter("id % 190 = 0").count() == 107 and isolate.without(rows, refused).count() == 19_894

    def full(part):
        if part.count():
            raise OSError("full")

    assert isolate.isolate(rows, full) == []


def test_one_bad_row_does_not_stop_the_stream(spark):
    folder = run_folder(spark, "s")

    def strict(packets):
        bad = F.col("ts") == F.timestamp_millis(F.lit(5 * MINUTE))
        return packets.withColumn("length", F.when(bad, F.raise_error(F.lit("bad")).cast("int")).otherwise(F.col("length")))

    land(spark, f"{folder}/in", [doc(timestamp=str(t * MINUTE)) for t in range(10)] + ["x"])
    land(spark, f"{folder}/in", [doc(timestamp=str(t * MINUTE)) for t in range(10, 14)])
    ingest.ingest_stream(ek_stream(spark, f"{folder}/in", 1), folder, f"{folder}/cp", trigger=ONCE, prepare=strict).awaitTermination()
    assert ingest.stored_packets(spark, folder).count() == 13
    letters = {(r["error"].split(":")[0], '"300000"' in r["raw_ek_line"]) for r in ingest.stored_dead_letters(spark, folder).collect()}
    assert letters == {("unmarshal ek", False), ("refused", True)}
    last = ingest.run_metrics(spark, folder).groupBy("name").agg(F.max("value").alias("v")).collect()
    values = {r["name"]: r["v"] for r in last}
    assert (values["worker_db_errors_total"], values["worker_deadletter_total"], values["worker_rows_inserted_total"]) == (1, 2, 13)


def test_the_buffer_tells_what_waits(spark):
    folder = run_folder(spark, "s")
    for part in range(3):
        land(spark, f"{folder}/in", [doc(timestamp=str(1_000_000 + part * 100 + t)) for t in range(20)])
    ingest.ingest_stream(
        ek_stream(spark, f"{folder}/in", 1), folder, f"{folder}/cp", trigger=ONCE, source=f"{folder}/in", clock=F.lit(datetime(2024, 1, 1))
    ).awaitTermination()
    samples = ingest.run_metrics(spark, folder)
    gauge = samples.filter(F.col("name") == ingest.BUFFER).orderBy("scrape_ts").collect()
    assert [r["value"] for r in gauge] == [40.0, 20.0, 0.0]
    assert counters.backlog_alert(samples, cap=40).count() == 1  # 40 is above three quarters of it
    episodes = counters.backlog_episodes(samples, "1 day", cap=20).collect()
    assert [(r["peak"], r["samples"]) for r in episodes] == [(40.0, 2)]
    assert {r["landed"] for r in ingest.stored_packets(spark, folder).collect()} == {datetime(2024, 1, 1)}
    memory = samples.filter(F.col("name") == ingest.MEMORY).agg(F.min("value")).first()[0]
    assert memory > 1e6


def test_offsets_of_a_topic(spark):
    source = {"latestOffset": '{"t":{"0":10,"1":7}}', "endOffset": {"t": {"0": 4}}}
    files = {"latestOffset": None, "endOffset": {"logOffset": 3}}
    assert backlog.behind({"sources": [source, files]}) == 13
    assert backlog.behind({"sources": [files]}) is None and backlog.behind({}) is None
    listener = backlog.BacklogListener("mine")
    for name, progress in (("mine", source), ("other", source), ("mine", files)):
        listener.add({"name": name, "batchId": 3, "timestamp": "2024-01-01T00:00:00.000Z", "sources": [progress]})
    assert [(r["name"], r["value"], r["batch_id"]) for r in listener.rows(spark).collect()] == [(backlog.BUFFER, 13.0, 3)]


def test_episodes(spark):
    rows = [("a", t, v) for t, v in ((0, 39e3), (10, 38e3), (41, 41e3), (70, 1.0), (100, 50e3))] + [("b", 0, 37e3)]
    samples = spark.createDataFrame(rows, "service STRING, s INT, value DOUBLE").select(
        "service", F.timestamp_seconds("s").alias("scrape_ts"), F.lit("worker_buffer_size").alias("name"), "value"
    )
    got = counters.backlog_episodes(samples, "30 seconds", "service").orderBy("started").collect()
    assert [(r["service"], r["started"].second, r["ended"].second, r["peak"], r["samples"]) for r in got] == [
        ("a", 0, 10, 39e3, 2), ("a", 41, 41, 41e3, 1), ("a", 40, 40, 50e3, 1)
    ]


@pytest.mark.parametrize("size", [3, 1000])
def test_heavy_talkers(spark, size):
    folder = run_folder(spark, "s")
    for part in range(3):
        lines = []
        for k in range(120):
            pair = "10.0.0.1" if k % 2 else "10.0.0.2" if k % 3 == 0 else f"10.1.{part}.{k}"
            lines.append(doc(timestamp=str(START + k), ip={"ip_ip_src": pair, "ip_ip_dst": "10.9.9.9"}))
        land(spark, f"{folder}/in", lines)
    packets = shape_packets(ek_stream(spark, f"{folder}/in", 1))
    heavy.heavy_talkers(packets, f"{folder}/heavy", f"{folder}/cp", size=size, trigger=ONCE).awaitTermination()
    exact = {r["src_ip"]: r["cnt"] for r in shape_packets(spark.read.text(f"{folder}/in")).groupBy("src_ip").agg(F.count("*").alias("cnt")).collect()}
    found = heavy.summary(spark, f"{folder}/heavy").collect()
    assert len(found) <= size and len(exact) == 122
    for r in found:
        assert r["cnt"] <= exact[r["src_ip"]] <= r["cnt"] + r["slack"] and r["slack"] <= r["seen"] / (size + 1) and r["seen"] == 360
    assert {"10.0.0.1", "10.0.0.2"} <= {r["src_ip"] for r in found}
    if size == 1000:
        assert {r["src_ip"]: r["cnt"] for r in found} == exact


def test_steps_of_live_rates_are_milliseconds(spark):
    with pytest.raises(ValueError):
        live_rates(spark.range(1), step_us=1500)


class Held:
    """State in memory that counts the samples that are read from it."""

    def __init__(self):
        self.lists, self.maps, self.timers, self.read = {}, {}, set(), 0
        self.registerTimer = self.timers.add

    def getListState(self, name, schema):
        held = self

        class State:
            rows = []
            appendList = rows.extend

            def get(self):
                held.read += len(self.rows)
                return list(self.rows)

            def put(self, rows):
                self.rows[:] = rows

            def clear(self):
                self.rows.clear()

        return State()

    def getMapState(self, name, key, value):
        held, rows = self, self.maps.setdefault(name, {})

        class State:
            containsKey, updateValue, removeKey = rows.__contains__, rows.__setitem__, rows.pop

            def getValue(self, key):
                held.read += len(rows[key][0]) // 8 if isinstance(rows[key][0], bytes) else 0
                return rows[key]

        return State()


@pytest.mark.parametrize("window, step", [(60, 15), (50, 20), (10, 30)])
def test_a_timer_of_live_rates_reads_its_window_only(window, step):
    rng, state = random.Random(3), Held()
    window, step = window * 1_000_000, step * 1_000_000
    rate = WindowedRate(("series",), window, step)
    rate.init(state)
    samples = [(rng.randrange(3_000_000_000) // 1_000_000 * 1_000_000, float(rng.randrange(50))) for _ in range(2000)]
    parts = [pd.DataFrame(samples[k : k + 300], columns=["us", "value"]) for k in range(0, 2000, 300)]
    assert not list(rate.handleInputRows(("a",), iter(parts), None))
    got = {}
    for ms in sorted(state.timers):
        for row in rate.handleExpiredTimer(("a",), None, SimpleNamespace(getExpiryTimeInMs=lambda ms=ms: ms)):
            got[int(row["at_us"][0])] = float(row["increase"][0])
    want = {}
    for end in range(0, 3_100_000_000, step):
        inside = [v for u, v in sorted(samples) if end - window <= u <= end]
        if len(inside) > 1:
            want[end] = sum(b - a if b >= a else b for a, b in zip(inside, inside[1:]))
    assert got == want
    assert state.read <= 2000 * (window // step + 3)
    assert not any(state.maps.values())
