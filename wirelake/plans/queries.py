"""The registered queries: each takes a session and a folder of tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, functions as F

from wirelake.functions.ip import ip_version
from wirelake.functions import payload
from wirelake.functions.payload import promoted
from wirelake.functions.text import leaf_protocol, mebibytes
from wirelake.operators import (
    batching, counters, digests, pacing, payload_index as indexed, reconcile, rollup, shape, storage, traffic,
)
from wirelake.operators.scan import kept
from wirelake.plans import derived, settings as P
from wirelake.schema import PACKET_COLUMNS
from wirelake.session import run_folder, state_on_disk, use_utc
from wirelake.sources import ek, exposition, replay
from wirelake.sources.ek import clean_lines
from wirelake.sources.files import file_sizes
from wirelake.sources.tables import packets_path
from wirelake.streaming import fanout, heavy, ingest
from wirelake.streaming.rates import live_rates as live
from wirelake.streaming.packets import dedup_into, dedup_stream as deduplicated

Query = Callable[[SparkSession, str], DataFrame]

_REGISTRY: dict[str, Query] = {}
_ONCE = {"availableNow": True}


def _query(run: Query) -> Query:
    name = run.__name__

    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain_times(run(use_utc(spark), sf_dir))

    _REGISTRY[name] = prepared
    return run


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _plain_times(df: DataFrame) -> DataFrame:
    """Times without a zone, as the checking engine reads them."""
    return df.select(
        *[
            F.col(f"`{name}`").cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        ]
    )


def _shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.shape_lines(derived.ek_lines(derived.events(spark, sf_dir)))


def _packets(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return shape.good_packets(_shaped(spark, sf_dir), keep)


def _samples(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    # Each event becomes many lines, and a file may have few row groups: events are dealt evenly before.
    rows = derived.events(spark, sf_dir).hint("rebalance")
    return exposition.metrics_parse(derived.metric_lines(rows), names=names)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of its files."""
    # The pattern names the table's file or folder alike, wherever the tables lie.
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def _stored_at(spark: SparkSession, sf_dir: str) -> str:
    """The folder of packets written to a chunked table."""
    path = run_folder(spark, "packets")
    storage.append_packets(_packets(spark, sf_dir), path)
    return path


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packets_path(spark, _stored_at(spark, sf_dir))


def _line_files(spark: SparkSession, sf_dir: str, folder: str, part: int, files: int) -> None:
    """Every second packet line, as new text files of a folder."""
    lines = derived.ek_lines(derived.events(spark, sf_dir)).filter(F.col("event_id") % 2 == part)
    lines.repartition(files, "event_id").select("value").write.mode("append").text(folder)


def _at(text: str):
    return F.lit(text).cast("timestamp")


# Sources


@_query
def ek_scan(spark, sf_dir):
    return clean_lines(derived.raw_lines(derived.events(spark, sf_dir))).select("event_id", "value")


@_query
def ek_stream(spark, sf_dir):
    """Lines from a stream of several files, one per micro-batch, stopped and started again."""
    folder = run_folder(spark, "lines")
    schema = "event_id BIGINT, value STRING"
    for part in range(2):
        raw = derived.raw_lines(derived.events(spark, sf_dir)).filter(F.col("event_id") % 2 == part)
        raw.select(F.concat("event_id", F.lit("\v"), "value").alias("value")).repartition(2).write.mode("append").option(
            "lineSep", "\f"
        ).text(f"{folder}/in")
        arriving = spark.readStream.schema("value STRING").option("maxFilesPerTrigger", 1).option("lineSep", "\f").text(f"{folder}/in")
        split = arriving.select(
            F.split_part("value", F.lit("\v"), F.lit(1)).cast("bigint").alias("event_id"), F.split_part("value", F.lit("\v"), F.lit(2)).alias("value")
        )
        clean_lines(split).writeStream.format("parquet").option("path", f"{folder}/out").option(
            "checkpointLocation", f"{folder}/checkpoint"
        ).trigger(**_ONCE).start().awaitTermination()
    return spark.read.schema(schema).parquet(f"{folder}/out")


@_query
def replay_expand(spark, sf_dir):
    lines = derived.ek_lines(derived.events(spark, sf_dir)).select("event_id", "value")
    return replay.replay_expand(lines, "event_id", P.PASSES)


@_query
def packets_scan(spark, sf_dir):
    return _stored(spark, sf_dir).select(*PACKET_COLUMNS)


@_query
def metrics_parse(spark, sf_dir):
    return _samples(spark, sf_dir).select(
        "service", "scrape_ts", "series", "name",
        F.col("labels")["service"].alias("service_label"),
        F.col("labels")["shard"].alias("shard_label"),
        "value",
    )


# Shaping


@_query
def shape_packets(spark, sf_dir):
    return _packets(spark, sf_dir)


@_query
def layer_precedence(spark, sf_dir):
    return _packets(spark, sf_dir, "event_id").select(
        "event_id", ip_version("src_ip").alias("ip_version"), "src_ip", "dst_ip", "src_port", "dst_port"
    )


@_query
def payload_verbatim(spark, sf_dir):
    return _packets(spark, sf_dir, "event_id").select(
        "event_id", "payload", F.md5(F.col("payload").cast("binary")).alias("payload_md5")
    )


@_query
def ip_canonical(spark, sf_dir):
    # Addresses of all documents, also of those that are refused for another reason.
    document = ~F.col("reason").eqNullSafe("malformed_json")
    return _shaped(spark, sf_dir).filter(document).select("event_id", "src_ip", "dst_ip")


@_query
def quarantine(spark, sf_dir):
    return (
        _shaped(spark, sf_dir)
        .filter(F.col("reason").isNotNull())
        .select("event_id", "reason", "error", F.col("value").alias("line"))
    )


@_query
def dead_letters(spark, sf_dir):
    return shape.dead_letters(_shaped(spark, sf_dir), _at(P.NOW))


@_query
def ingest_counters(spark, sf_dir):
    batch = F.floor(F.col("event_id") / F.lit(P.BATCH_ROWS))
    return shape.ingest_counters(_shaped(spark, sf_dir), batch)


# Storage


@_query
def packets_append(spark, sf_dir):
    """Two appends into one table, by the protocol of the packet."""
    path = run_folder(spark, "packets")
    packets = _packets(spark, sf_dir)
    dns = traffic.traffic_filter(port=53)
    storage.append_packets(packets.filter(dns), path)
    storage.append_packets(packets.filter(~dns), path)
    return packets_path(spark, path).select(*PACKET_COLUMNS)


@_query
def chunked_table(spark, sf_dir):
    return _stored(spark, sf_dir).select(*PACKET_COLUMNS, "chunk")


@_query
def talker_layout(spark, sf_dir):
    return storage.talker_layout(_packets(spark, sf_dir)).select(*PACKET_COLUMNS, "chunk")


@_query
def retention(spark, sf_dir):
    """What a catalog table still holds after its old chunks were dropped."""
    name = f"packets_{uuid.uuid4().hex}"
    storage.create_packets_table(spark, name)
    storage.append_to_table(_packets(spark, sf_dir), name)
    storage.expire_chunks(spark, name, P.NOW)
    return spark.table(name).select(*PACKET_COLUMNS)


@_query
def retained_packets(spark, sf_dir):
    return storage.retained(_stored(spark, sf_dir), _at(P.NOW)).select(*PACKET_COLUMNS)


@_query
def compacted_packets(spark, sf_dir):
    """Ingested micro-batches after compaction and expiry, with the number of files of their hour."""
    folder = _ingested(spark, sf_dir)
    ingest.compact(spark, folder, P.END)
    ingest.expire(spark, folder, P.NOW)
    packets = ingest.stored_packets(spark, folder)
    listed = file_sizes(spark, f"{folder}/packets").unionByName(file_sizes(spark, f"{folder}/compacted"))
    return packets.join(listed.groupBy("chunk").agg(F.count("*").alias("files")), "chunk").select(*PACKET_COLUMNS, "files")


@_query
def table_lifecycle(spark, sf_dir):
    """A table, an empty one like it that is filled, and one that is emptied again."""
    names = [f"packets_{uuid.uuid4().hex}" for _ in range(3)]
    storage.create_packets_table(spark, names[0])
    packets = _packets(spark, sf_dir)
    for name in names[1:]:
        storage.create_table_like(spark, name, names[0])
        storage.create_table_like(spark, name, names[0])  # it is there already
        storage.append_to_table(packets, name)
    storage.truncate_table(spark, names[2])
    counts = [traffic.row_count(spark.table(n)).withColumn("step", F.lit(s)) for n, s in zip(names, ("created", "filled", "emptied"))]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# Traffic


@_query
def row_count(spark, sf_dir):
    return traffic.row_count(_packets(spark, sf_dir))


@_query
def latest_packets(spark, sf_dir):
    return traffic.latest_packets(_packets(spark, sf_dir))


@_query
def top_talkers(spark, sf_dir):
    return traffic.top_talkers(_packets(spark, sf_dir))


@_query
def talker_lookback(spark, sf_dir):
    rows = traffic.talker_lookback(_stored(spark, sf_dir), *P.TALKER, _at(P.LOW), _at(P.HIGH))
    return rows.select(*PACKET_COLUMNS)


@_query
def capture_filter(spark, sf_dir):
    return _packets(spark, sf_dir).filter(traffic.traffic_filter("tcp", 443))


@_query
def capture_filter_not(spark, sf_dir):
    return _packets(spark, sf_dir).filter(traffic.traffic_filter(port=53, negate=True))


_PATTERN = {"layers": {"udp": {"udp_udp_dstport": "53"}, "dns": {"dns_dns_qry_name": "click.example"}}}


@_query
def payload_contains(spark, sf_dir):
    packets = _packets(spark, sf_dir, "event_id").select("event_id", "payload")
    return payload.payload_contains(packets, _PATTERN)


@_query
def payload_index(spark, sf_dir):
    """The same search on a stored table, of which only files that the index names are read."""
    path = _stored_at(spark, sf_dir)
    indexed.index_payloads(spark, path, f"{path}-index")
    return indexed.search_payloads(spark, path, f"{path}-index", _PATTERN).select(*PACKET_COLUMNS)


@_query
def payload_variant(spark, sf_dir):
    packets = storage.with_payload_variant(_packets(spark, sf_dir, "event_id"))
    return packets.select(
        "event_id",
        F.try_variant_get("payload_variant", "$.layers.frame.frame_frame_len", "string").alias("frame_len"),
        F.try_variant_get("payload_variant", "$.layers.udp.udp_udp_dstport", "string").alias("udp_port"),
    )


@_query
def app_columns(spark, sf_dir):
    fields = {
        "http_host": ("layers", "http", "http_http_host"),
        "dns_query": ("layers", "dns", "dns_dns_qry_name"),
    }
    return (
        _packets(spark, sf_dir, "event_id")
        .withColumn("app", promoted(F.col("payload"), fields))
        .select("event_id", "src_ip", "dst_ip", "app.*")
    )


@_query
def proto_parts(spark, sf_dir):
    return traffic.protocol_counts(_packets(spark, sf_dir))


@_query
def dedup_packets(spark, sf_dir):
    packets = _packets(spark, sf_dir)
    delivered = packets.unionByName(packets.filter(traffic.traffic_filter(port=53)))
    return traffic.dedup_packets(delivered)


@_query
def pps_per_minute(spark, sf_dir):
    return traffic.per_minute(_packets(spark, sf_dir)).withColumn("pps", F.round("pps", 6))


@_query
def talkers_per_minute(spark, sf_dir):
    return traffic.talkers_per_minute(_packets(spark, sf_dir), 3)


@_query
def pps_rollup(spark, sf_dir):
    """Per-minute packets from a rollup that was refreshed before and after late packets came."""
    return rollup.per_minute(_rolled_up(spark, sf_dir)).withColumn("pps", F.round("pps", 6))


@_query
def talkers_rollup(spark, sf_dir):
    return rollup.talkers_per_minute(_rolled_up(spark, sf_dir), 3)


def _rolled_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = run_folder(spark, "packets")
    packets = _packets(spark, sf_dir)
    late = traffic.traffic_filter(port=53) & (F.col("ts") >= F.lit(P.NOW).cast("timestamp"))
    for part in (~late, late):
        storage.append_packets(packets.filter(part), path)
        rollup.refresh(spark, lambda: packets_path(spark, path), [path], f"{path}-rollup")
    return rollup.stored_rollup(spark, f"{path}-rollup", rollup.PAIR_MINUTES)


@_query
def ingest_latency(spark, sf_dir):
    """Delays of packets per event type, and of ingested packets per protocol.

    The quantiles are exact; of ingested packets, the row also tells whether those of the stored
    sketches lie within the error.
    """
    by_id = F.expr("make_dt_interval(0, 0, 0, (event_id * 7) % 3000 / 1000)")
    landed = shape.good_packets(_shaped(spark, sf_dir), ("event_id", "event_type")).withColumn("landed", F.col("ts") + by_id)
    per_type = traffic.ingest_latency(landed, "landed", "event_type", accuracy=None)

    delay = F.make_dt_interval(secs=(F.col("length") * 7 % 3000 / 1000).cast("decimal(18,6)"))
    folder = _ingested(spark, sf_dir, clock=F.col("ts") + delay)
    measure = rollup.latency_minutes(leaf_protocol(F.col("proto")))
    tables = [f"{folder}/packets", f"{folder}/compacted"]
    rollup.refresh(spark, lambda: ingest.stored_packets(spark, folder), tables, f"{folder}/latency", measure)
    found = rollup.latency(rollup.stored_rollup(spark, f"{folder}/latency", measure))

    packets = ingest.stored_packets(spark, folder).select(
        leaf_protocol(F.col("proto")).alias("grp"), (F.unix_millis("landed") - F.unix_millis("ts")).alias("ms")
    )
    ranks = packets.join(found.select("grp", "p50_ms", "p95_ms"), "grp").groupBy("grp").agg(
        *[F.avg((F.col("ms") < F.col(p)).cast("int")).alias(f"_below_{p}") for p in ("p50_ms", "p95_ms")],
        *[F.avg((F.col("ms") <= F.col(p)).cast("int")).alias(f"_upto_{p}") for p in ("p50_ms", "p95_ms")],
    )

    def within(p: str, share: float):
        return ((F.col(f"_below_{p}") <= share + P.RANK_ERROR) & (F.col(f"_upto_{p}") >= share - P.RANK_ERROR)).alias(p.replace("_ms", "_ok"))

    judged = found.join(ranks, "grp").select("grp", within("p50_ms", 0.5), within("p95_ms", 0.95))
    stored = ingest.stored_packets(spark, folder).withColumn("grp", leaf_protocol(F.col("proto")))
    per_leaf = traffic.ingest_latency(stored, "landed", "grp", accuracy=None).join(judged, "grp", "left")
    figures = ("packets", "min_ms", "max_ms", "p50_ms", "p95_ms", "in_time")
    untold = [F.lit(None).cast("boolean").alias(c) for c in ("p50_ok", "p95_ok")]
    return per_type.select(F.lit("event_type").alias("kind"), F.col("event_type").alias("grp"), *figures, *untold).unionByName(
        per_leaf.select(F.lit("leaf").alias("kind"), "grp", *figures, "p50_ok", "p95_ok")
    )


# Reconciliation


def _other(packets: DataFrame) -> DataFrame:
    """A second writer's table: other lengths for some packets, payloads written anew."""
    return packets.withColumn(
        "length", F.when(F.col("proto").endswith(":icmp"), F.col("length") + 1).otherwise(F.col("length"))
    ).withColumn("payload", F.replace("payload", F.lit(","), F.lit(", ")))


@_query
def table_checksum(spark, sf_dir):
    return reconcile.table_checksum(_packets(spark, sf_dir)).select("rows", "digest")


@_query
def payload_checksum(spark, sf_dir):
    return reconcile.table_checksum(_packets(spark, sf_dir)).select("payloads")


@_query
def diff_rows(spark, sf_dir):
    packets = _packets(spark, sf_dir)
    return reconcile.diff_rows(packets, _other(packets), None)


@_query
def diff_by_digest(spark, sf_dir):
    """The same rows, found from digests and lookup tables."""
    packets = kept(_packets(spark, sf_dir), "packets")  # read several times; lines are parsed once
    return digests.diff_by_digest(packets, _other(packets))


@_query
def diff_sample(spark, sf_dir):
    packets = _packets(spark, sf_dir)
    return reconcile.diff_rows(packets, _other(packets), 5)


@_query
def verify_tables(spark, sf_dir):
    packets = _packets(spark, sf_dir)
    report = reconcile.verify_tables(packets, _other(packets))
    return report.withColumn("problems", F.concat_ws("; ", "problems"))


@_query
def reconcile_counts(spark, sf_dir):
    """Runs that stored everything, lost packets, stored some twice, and did both in equal number."""
    shaped = _shaped(spark, sf_dir)
    packets, letters = shape.good_packets(shaped, ("event_id",)), shape.dead_letters(shaped, _at(P.NOW))
    dns, slot = traffic.traffic_filter(port=53), F.col("event_id") % 20

    def runs(df: DataFrame, *names: str) -> DataFrame:
        return df.withColumn("run", F.explode(F.array(*[F.lit(n) for n in names])))

    stored = (
        runs(packets, "whole", "twice").unionByName(runs(packets.filter(~dns), "holes"))
        .unionByName(runs(packets.filter(dns), "twice"))
        .unionByName(runs(packets.filter(slot != 1), "both"))
        .unionByName(runs(packets.filter(slot == 2), "both"))
    )
    every = ("whole", "holes", "twice", "both")
    return traffic.reconcile_counts(runs(shaped, *every), stored, runs(letters, *every), "run")


# Counters


@_query
def sum_across_labels(spark, sf_dir):
    return counters.sum_across_labels(_samples(spark, sf_dir), "service", "scrape_ts")


@_query
def metric_contract(spark, sf_dir):
    return counters.metric_contract(_samples(spark, sf_dir), "service")


@_query
def backlog_alert(spark, sf_dir):
    return counters.backlog_alert(_samples(spark, sf_dir, "worker_buffer_size")).select("service", "scrape_ts", "series", "value")


@_query
def backlog_episodes(spark, sf_dir):
    samples = _samples(spark, sf_dir, "worker_buffer_size")
    return counters.backlog_episodes(samples, f"{P.EPISODE_S} seconds", "service")


@_query
def memory_text(spark, sf_dir):
    return _samples(spark, sf_dir, "process_memory_bytes").select("service", "scrape_ts", mebibytes(F.col("value")).alias("size"))


@_query
def gauge_sum(spark, sf_dir):
    return counters.gauge_sum(_samples(spark, sf_dir, "process_memory_bytes"), P.STEP_US, "process_memory_bytes")


@_query
def gauge_per_service(spark, sf_dir):
    return counters.gauge_sum(_samples(spark, sf_dir, "process_memory_bytes"), P.STEP_US, "process_memory_bytes", "service")


def _rates(spark: SparkSession, sf_dir: str, extrapolate: bool) -> DataFrame:
    rows = _samples(spark, sf_dir, "worker_rows_inserted_total")
    rates = counters.counter_rate(
        rows, ("service", "series"), P.WINDOW_US, P.STEP_US, extrapolate=extrapolate
    )
    return rates.withColumn("increase", F.round("increase", 6)).withColumn("rate", F.round("rate", 6))


@_query
def counter_rate(spark, sf_dir):
    return _rates(spark, sf_dir, extrapolate=False)


@_query
def counter_rate_extrapolated(spark, sf_dir):
    return _rates(spark, sf_dir, extrapolate=True)


@_query
def counter_increase(spark, sf_dir):
    rows = _samples(spark, sf_dir, "worker_rows_inserted_total")
    total = counters.counter_increase(
        rows, ("service", "series"), window_us=P.WINDOW_US, step_us=P.STEP_US
    )
    return total.withColumn("increase", F.round("increase", 6))


@_query
def soak_gate(spark, sf_dir):
    return (
        counters.soak_gate(_samples(spark, sf_dir), "service", min_elapsed_s=P.SOAK_S)
        .withColumn("missing", F.concat_ws(",", "missing"))
        .withColumn("failures", F.concat_ws("; ", "failures"))
        .withColumn("elapsed_s", F.round("elapsed_s", 6))
        .withColumn("throughput", F.round("throughput", 9))
    )


@_query
def settled_at(spark, sf_dir):
    polls = derived.poll_counts(derived.events(spark, sf_dir))
    return counters.settled_at(polls, ("table_name",), P.STABLE_US)


# Pacing and batches


@_query
def pace_schedule(spark, sf_dir):
    rows = derived.arrivals(derived.events(spark, sf_dir))
    return pacing.pace_schedule(rows, ("key",), "seq", Fraction(P.PACE_ROWS * 1_000_000, P.PACE_US))


@_query
def batch_by_count(spark, sf_dir):
    rows = derived.arrivals(derived.events(spark, sf_dir)).select("key", "seq")
    return pacing.batch_by_count(rows, ("key",), "seq", P.BATCH_ROWS)


@_query
def batch_count_or_time(spark, sf_dir):
    rows = derived.arrivals(derived.events(spark, sf_dir))
    marked = batching.batch_count_or_time(rows, "key", "seq", P.BATCH_ROWS, P.BATCH_US)
    return batching.batch_list(marked, "key", "seq")


# Streams


def _line_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.ek_lines(_event_stream(spark, sf_dir)).select("value")


def _ingested(spark: SparkSession, sf_dir: str, **options) -> str:
    """Packets ingested from files, one per micro-batch; the stream is stopped and started again."""
    folder = run_folder(spark, "ingest")
    for part, files in ((0, 2), (1, 1)):
        _line_files(spark, sf_dir, f"{folder}/in", part, files)
        ingest.ingest_stream(
            ek.ek_stream(spark, f"{folder}/in", 1), folder, f"{folder}/checkpoint", trigger=_ONCE, source=f"{folder}/in", **options
        ).awaitTermination()
    return folder


@_query
def ingest_stream(spark, sf_dir):
    return ingest.stored_packets(spark, _ingested(spark, sf_dir)).select(*PACKET_COLUMNS)


@_query
def run_metrics(spark, sf_dir):
    """All series at the end of the run; for the buffer, whether it fell; used memory is no fixed number."""
    samples = ingest.run_metrics(spark, _ingested(spark, sf_dir))
    return samples.groupBy("name").agg(
        F.max_by("value", "scrape_ts").alias("value"), (F.max("value") > F.max_by("value", "scrape_ts")).alias("fell")
    ).select(
        "name", F.when(F.col("name") != ingest.MEMORY, F.col("value")).alias("value"),
        F.when(F.col("name") == ingest.BUFFER, F.col("fell")).alias("fell"),
    )


@_query
def own_soak(spark, sf_dir):
    """The gate on a run of our own, and the samples and episodes of its buffer above nothing."""
    samples = ingest.run_metrics(spark, _ingested(spark, sf_dir))
    gate = counters.soak_gate(samples, max_rss_bytes=P.RUN_MEMORY, max_dead_letters=P.RUN_DEAD_LETTERS)
    alerts = counters.backlog_alert(samples, cap=1, share=0).count()
    episodes = counters.backlog_episodes(samples, "1 day", cap=1, share=0).count()
    return gate.select(
        "samples", "dead_letters", "db_errors", "msgs_consumed", "final_buffer",
        F.lit(alerts).alias("alerts"), F.lit(episodes).alias("episodes"),
        F.concat_ws(",", "missing").alias("missing"), F.concat_ws("; ", "failures").alias("failures"), "passed",
    )


@_query
def isolated_batch(spark, sf_dir):
    """A step before the store that fails on some packets: they are set aside, all others land once."""

    def strict(packets: DataFrame) -> DataFrame:
        odd = (F.col("length") == P.ODD_LENGTH) & (F.col("dst_ip") == P.ODD_ADDRESS)
        return packets.withColumn("length", F.when(odd, F.raise_error(F.lit("odd length")).cast("int")).otherwise(F.col("length")))

    folder = _ingested(spark, sf_dir, prepare=strict)
    packets = ingest.stored_packets(spark, folder).select(F.lit("packet").alias("kind"), F.col("payload").alias("line"))
    letters = ingest.stored_dead_letters(spark, folder)
    refused = F.col("error").startswith("refused: ")
    return packets.unionByName(
        letters.select(F.when(refused, "refused").otherwise("dead letter").alias("kind"), F.col("raw_ek_line").alias("line"))
    )


@_query
def parquet_sink(spark, sf_dir):
    path = run_folder(spark, "subscriber")
    start = fanout.parquet_sink(path, _ONCE)
    start(_line_stream(spark, sf_dir), f"{path}-checkpoint").awaitTermination()
    return packets_path(spark, path).select(*PACKET_COLUMNS)


@_query
def fan_out(spark, sf_dir):
    folder = run_folder(spark, "fanout")
    sinks = {
        "packets": fanout.parquet_sink(f"{folder}/packets", _ONCE),
        "dead_letters": fanout.dead_letter_sink(f"{folder}/dead_letters", _ONCE),
        "lines": fanout.line_sink(f"{folder}/lines", _ONCE),
    }
    running = fanout.fan_out(_line_stream(spark, sf_dir), sinks, f"{folder}/checkpoints")
    for query in running.values():
        query.awaitTermination()

    def landed(sink: str, rows: DataFrame, line, error=F.lit(None).cast("string")) -> DataFrame:
        return rows.select(F.lit(sink).alias("sink"), line.alias("line"), error.alias("error"))

    letters = spark.read.text(f"{folder}/dead_letters")
    return (
        landed("packets", packets_path(spark, f"{folder}/packets"), F.col("payload"))
        .unionByName(
            landed("dead_letters", letters, F.get_json_object("value", "$.raw_ek_line"), F.get_json_object("value", "$.error"))
        )
        .unionByName(landed("lines", spark.read.text(f"{folder}/lines"), F.col("value")))
    )


@_query
def dedup_stream(spark, sf_dir):
    """Packets by message id from a stream of several files, stopped and started again."""
    folder = run_folder(spark, "dedup")
    lines = derived.ek_lines(derived.events(spark, sf_dir)).select("event_id", "value")
    half = 8  # files of a micro-batch
    # Every packet comes twice, in files of its own.
    for _ in range(2):
        lines.repartition(2 * half, "event_id").select("value").write.mode("append").text(f"{folder}/in")
        arriving = shape.shape_packets(ek.ek_stream(spark, f"{folder}/in", half))
        kept = deduplicated(arriving, late="3650 days").select(*traffic.IDENTITY)
        with state_on_disk(spark):  # all ids stay within so long a time
            kept.writeStream.format("parquet").option("path", f"{folder}/out").option(
                "checkpointLocation", f"{folder}/checkpoint"
            ).trigger(**_ONCE).start().awaitTermination()
    return spark.read.schema(kept.schema).parquet(f"{folder}/out")


@_query
def heavy_talkers(spark, sf_dir):
    """The true top pairs, and whether the stream's summary of fixed size counts them within its bounds."""
    folder = run_folder(spark, "heavy")
    for part, files in ((0, 2), (1, 1)):
        _line_files(spark, sf_dir, f"{folder}/in", part, files)
        arriving = shape.shape_packets(ek.ek_stream(spark, f"{folder}/in", 1))
        heavy.heavy_talkers(arriving, f"{folder}/pairs", f"{folder}/checkpoint", size=P.HEAVY_PAIRS, trigger=_ONCE).awaitTermination()
    found = heavy.summary(spark, f"{folder}/pairs")
    most, seen = found.agg(F.max("slack"), F.max("seen")).first()
    top = traffic.top_talkers(_packets(spark, sf_dir))
    counted = top.join(found.select("src_ip", "dst_ip", F.col("cnt").alias("low"), "slack"), ["src_ip", "dst_ip"], "left")
    low = F.coalesce("low", F.lit(0))
    within = (low <= F.col("cnt")) & (F.col("cnt") <= low + F.lit(most)) & F.lit(most * (P.HEAVY_PAIRS + 1) <= seen)
    return counted.select("src_ip", "dst_ip", "cnt", within.alias("within"))


@_query
def live_rates(spark, sf_dir):
    """Rates of samples that arrive in files, one per micro-batch, with a stop in between."""
    folder = run_folder(spark, "rates")
    samples = _samples(spark, sf_dir, "worker_rows_inserted_total").select("service", "series", "scrape_ts", "value")
    kept = f"{folder}/all"
    samples.write.parquet(kept)
    samples = spark.read.schema(samples.schema).parquet(kept)
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    spark.conf.set(store, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        cuts = [F.lit(t).cast("timestamp") for t in ("1970-01-01", P.LOW, P.HIGH, "9999-01-01")]
        for run in ((0, 1), (2,)):
            for k in run:
                part = samples.filter((F.col("scrape_ts") >= cuts[k]) & (F.col("scrape_ts") < cuts[k + 1]))
                part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
            if run == (2,):  # a last sample of another series moves the watermark beyond all steps
                for hours in (1, 2):
                    end = F.lit(P.END).cast("timestamp") + F.make_interval(days=F.lit(hours))
                    last = spark.range(1).select(F.lit("").alias("service"), F.lit("end").alias("series"), end.alias("scrape_ts"), F.lit(0.0).alias("value"))
                    last.coalesce(1).write.mode("append").parquet(f"{folder}/in")
            arriving = spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
            rates = live(arriving, ("service", "series"), P.WINDOW_US, P.STEP_US, "1 second")
            rates.writeStream.format("parquet").option("path", f"{folder}/out").option(
                "checkpointLocation", f"{folder}/checkpoint"
            ).trigger(**_ONCE).start().awaitTermination()
    finally:
        spark.conf.set(store, before)
    found = spark.read.schema(rates.schema).parquet(f"{folder}/out")
    return found.withColumn("increase", F.round("increase", 6)).withColumn("rate", F.round("rate", 6))


@_query
def dedup_stored(spark, sf_dir):
    """Packets that come again to a stream whose state does not know them, refused by what is stored."""
    folder = run_folder(spark, "stored")
    lines = derived.ek_lines(derived.events(spark, sf_dir)).select("value")
    for run in range(2):
        lines.write.text(f"{folder}/in{run}")  # all of a run's files are one micro-batch
        arriving = shape.shape_packets(ek.ek_stream(spark, f"{folder}/in{run}"))
        dedup_into(
            arriving, f"{folder}/out", f"{folder}/checkpoint{run}", late="3650 days", trigger=_ONCE, first_batch=1000 * run
        ).awaitTermination()
    return packets_path(spark, f"{folder}/out").select(*traffic.IDENTITY)
