"""Continuous ingestion: shape, quarantine, append and count, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from wirelake.functions.identifiers import checked_name
from wirelake.operators import compaction
from wirelake.operators.scan import BLOCK, running
from wirelake.operators.shape import dead_letters, good_packets, shape_lines
from wirelake.operators.storage import talker_layout
from wirelake.schema import PACKET_COLUMNS, STORED_PACKETS
from wirelake.session import run_folder
from wirelake.sources import files
from wirelake.streaming.backlog import BUFFER, MEMORY, used_memory, waiting_lines
from wirelake.streaming.isolate import isolate, only, without

# Fixed value: the counter of failed writes.
ERRORS = "worker_db_errors_total"
GAUGES = (BUFFER, MEMORY)
LANDED = "landed"
#: What an ingest folder holds of a packet.
INGESTED = T.StructType(
    [*STORED_PACKETS.fields, T.StructField("batch_id", T.LongType()), T.StructField(LANDED, T.TimestampType())]
)


def ingest_stream(
    lines: DataFrame,
    folder: str,
    checkpoint: str,
    *,
    column: str = "value",
    table: str | None = None,
    trigger: dict | None = None,
    name: str = "ingest",
    clock: Column | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    source: str | None = None,
) -> StreamingQuery:
    """Start ingestion of a stream of lines into ``folder``.

    ``folder/packets`` goes by hour and below that by micro-batch, ``folder/dead_letters`` and
    ``folder/metrics`` by micro-batch. A micro-batch that is run again after a failure overwrites its own part, so
    every line lands once. The size of a micro-batch is set at the source, the pace by
    ``trigger`` (one second by default). With ``table``, packets go into that catalog table
    (``storage.create_packets_table(.., by_batch=True)``), whose old chunks can be dropped.

    Packets in ``folder`` carry ``landed``, the time their micro-batch was taken up, or what
    ``clock`` says. ``prepare`` may change packet columns before they are written; rows on which
    it or the store fails are set aside as dead letters (see ``isolate``), so that one row does
    not stop the stream for good. ``source`` names the folder that a stream of files reads; with
    it, the buffer gauge tells the lines of the files that wait. (For a topic see
    ``backlog.BacklogListener``.)
    """
    def waiting(batch_id: int, taken: int) -> float:
        return waiting_lines(lines.sparkSession, source, checkpoint, batch_id, taken) if source else 0.0

    return (
        lines.select(F.col(column).alias("value"))
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, folder, table, clock, prepare, waiting))
        .start()
    )


def write_batch(
    batch: DataFrame,
    batch_id: int,
    folder: str,
    table: str | None = None,
    clock: Column | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    waiting: Callable[[int, int], float] = lambda batch_id, lines: 0.0,
) -> None:
    """Write one micro-batch: packets, dead letters and its counters.

    The shaped batch is kept while its two parts are written, so lines are parsed once;
    counting happens on the way, not in passes of its own. If packets cannot be written, the
    rows at fault are looked for and become dead letters, and the others are written. A write
    that fails without such rows is counted and raised; the query then starts again from its
    checkpoint.
    """
    spark = batch.sparkSession
    shaped = shape_lines(batch).select(*PACKET_COLUMNS, "reason", "error")
    shaped = shaped.persist(StorageLevel.MEMORY_AND_DISK)
    bad_seen = Observation()
    counted = F.count(F.lit(1)).alias("n")
    landed = F.current_timestamp() if clock is None else clock

    def write(packets: DataFrame) -> int:
        seen = Observation()
        ready = packets if prepare is None else prepare(packets)
        # Counted behind the shuffle: to find its ranges, the shuffle reads its input twice.
        good = talker_layout(ready).observe(seen, counted)
        if table is None:
            _overwrite_chunks(good.withColumn(LANDED, landed), batch_id, f"{folder}/packets")
        else:
            _overwrite_in_table(good, batch_id, checked_name(table))
        return seen.get["n"]

    def trial(packets: DataFrame) -> None:
        ready, path = packets if prepare is None else prepare(packets), run_folder(spark, "trial")
        try:
            ready.select(*PACKET_COLUMNS).write.parquet(path)
        finally:
            files.remove_folder(spark, path)

    try:
        packets, letters = good_packets(shaped), dead_letters(shaped, F.current_timestamp())
        try:
            good_lines = write(packets)
        except Exception as cause:
            refused = isolate(packets, trial)
            if not refused:
                raise
            _count_error(spark, batch_id, folder)
            good_lines = write(without(packets, refused))
            text = f"refused: {getattr(cause, 'getCondition', lambda: None)() or type(cause).__name__}"
            letters = letters.unionByName(_refused_letters(only(packets, refused), text, letters))
        bad = letters.observe(bad_seen, counted)
        _overwrite(bad.withColumn("at", F.timestamp_seconds("ts")), batch_id, f"{folder}/dead_letters")
    except Exception as first:
        try:
            _count_error(spark, batch_id, folder)
        except Exception as second:  # the store is gone for this as well; the first error tells more
            first.add_note(f"not counted: {second}")
        raise
    finally:
        shaped.unpersist()
    bad_lines = bad_seen.get["n"]
    # The names of the counters.
    changes = {
        "ingestor_lines_read_total": good_lines + bad_lines,
        "ingestor_msgs_published_total": good_lines + bad_lines,
        "worker_msgs_consumed_total": good_lines,
        "worker_rows_inserted_total": good_lines,
        "worker_batch_flush_total": int(good_lines > 0),
        "worker_deadletter_total": bad_lines,
        ERRORS: 0,
        BUFFER: waiting(batch_id, good_lines + bad_lines),
        MEMORY: used_memory(spark),
    }
    _overwrite(_changes(spark, changes), batch_id, f"{folder}/metrics")


def _refused_letters(packets: DataFrame, text: str, like: DataFrame) -> DataFrame:
    """Dead letters of packets that could not be written, their line being the payload."""
    return packets.select(
        F.lit(text).alias("error"), F.col("payload").alias("raw_ek_line"), F.unix_timestamp(F.current_timestamp()).alias("ts")
    ).select(*like.columns)


def _count_error(spark: SparkSession, batch_id: int, folder: str) -> None:
    _changes(spark, {ERRORS: 1}).withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("append").parquet(
        f"{folder}/errors"
    )



def _changes(spark: SparkSession, changes: dict[str, int]) -> DataFrame:
    rows = [(name, float(value)) for name, value in changes.items()]
    return spark.createDataFrame(rows, "name STRING, delta DOUBLE").coalesce(1).withColumn(
        "scrape_ts", F.current_timestamp()
    )


def _overwrite(rows: DataFrame, batch_id: int, table: str, *parts: str) -> None:
    """Write a micro-batch's part of a table, a partition folder of its own."""
    rows.write.mode("overwrite").partitionBy(*parts).parquet(f"{table}/batch_id={batch_id}")


def _overwrite_chunks(packets: DataFrame, batch_id: int, table: str) -> None:
    """Write a micro-batch's files below the hours they belong to, and replace no others.

    With the hour on top, a range of time lists its own hours only, however many batches there are.
    """
    numbered = packets.select(*PACKET_COLUMNS, LANDED, "chunk", F.lit(batch_id).cast("bigint").alias("batch_id"))
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "chunk", "batch_id"
    ).parquet(table)


def _overwrite_in_table(packets: DataFrame, batch_id: int, table: str) -> None:
    """Replace the partitions of this micro-batch, and no others."""
    rows = packets.select(*PACKET_COLUMNS, "chunk", F.lit(batch_id).cast("bigint").alias("batch_id"))
    conf, mode = packets.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(mode)
    conf.set(mode, "dynamic")  # an insertion knows this mode by the session alone
    try:
        rows.write.mode("overwrite").insertInto(table)
    finally:
        conf.set(mode, before)


def stored_packets(spark: SparkSession, folder: str) -> DataFrame:
    """The packets of an ingest folder with chunk, batch_id and landed, compacted hours included."""
    return compaction.current(spark, f"{folder}/packets", f"{folder}/compacted", INGESTED)


def compact(spark: SparkSession, folder: str, now, **how) -> int:
    """Merge the micro-batch files of closed hours; returns how many hours (see ``compaction``)."""
    return compaction.compact_ingested(spark, f"{folder}/packets", f"{folder}/compacted", now, INGESTED, **how)


def expire(spark: SparkSession, folder: str, now, keep: str = "1 day") -> list[str]:
    """Delete the packets of hours that lie wholly before ``now - keep``; returns the hours."""
    hours = [compaction.expire_folders(spark, f"{folder}/{part}", now, keep) for part in ("packets", "compacted")]
    return sorted({hour for part in hours for hour in part})


def stored_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    schema = "error STRING, raw_ek_line STRING, ts BIGINT, at TIMESTAMP, batch_id BIGINT"
    return spark.read.schema(schema).parquet(f"{folder}/dead_letters")


def run_metrics(spark: SparkSession, folder: str, service: str = "ingest") -> DataFrame:
    """The run's metrics after each micro-batch, as metric samples.

    Failed writes count with the micro-batch that failed, whether or not it was written later.
    """
    changes = spark.read.schema(
        "name STRING, delta DOUBLE, scrape_ts TIMESTAMP, batch_id BIGINT"
    ).parquet(f"{folder}/metrics")
    failed = failed_writes(spark, folder)
    summed = (
        changes.filter(~F.col("name").isin(*GAUGES)).unionByName(failed)
        .groupBy("name", "batch_id")
        .agg(F.sum("delta").alias("delta"), F.max("scrape_ts").alias("scrape_ts"))
    )
    counters = running(summed, ("name",), "batch_id", F.col("delta"), "sum", "value").drop(BLOCK)
    gauges = changes.filter(F.col("name").isin(*GAUGES)).withColumn("value", F.col("delta"))
    return counters.unionByName(gauges).select(
        "scrape_ts",
        F.concat("name", F.lit(f'{{service="{service}"}}')).alias("series"),
        "name",
        F.create_map(F.lit("service"), F.lit(service)).alias("labels"),
        "value",
    )


def failed_writes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per failed write of a micro-batch, as changes of the error counter."""
    schema = "name STRING, delta DOUBLE, scrape_ts TIMESTAMP, batch_id BIGINT"
    try:
        return spark.read.schema(schema).parquet(f"{folder}/errors")
    except AnalysisException as missing:  # no write has failed
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
