"""Packet tables: hour chunks, layout, appending and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wirelake.functions.identifiers import checked_name
from wirelake.functions.payload import payload_variant
from wirelake.operators.scan import kept
from wirelake.operators.traffic import chunk_width
from wirelake.schema import PACKET_COLUMNS


#: Partitions that one statement drops.
DROPPED_AT_ONCE = 500


def with_chunk(packets: DataFrame) -> DataFrame:
    """Add the hour a packet belongs to, the partition of the stored table."""
    return packets.withColumn("chunk", F.date_trunc("HOUR", F.col("ts")))


def talker_layout(packets: DataFrame) -> DataFrame:
    """Order rows for lookups by chunk, address pair and time.

    Range partitioning on the whole sort key splits a busy hour, and a busy pair in it, over
    several tasks and files; packets equal in it are split by a hash of all their columns, which
    is the same if a task runs again. The files of a chunk then cover separate address ranges,
    and their row groups can be skipped by minimum and maximum.
    """
    order = ("chunk", "src_ip", "dst_ip", "ts")
    placed = with_chunk(packets).withColumn("_tie", F.xxhash64(*PACKET_COLUMNS))
    return placed.repartitionByRange(*order, "_tie").sortWithinPartitions(*order).drop("_tie")


def local_layout(packets: DataFrame) -> DataFrame:
    """The same order within each task, without a shuffle.

    Fits captures, which come in order of time: a task then holds few hours and writes few files.
    """
    return with_chunk(packets).sortWithinPartitions("chunk", "src_ip", "dst_ip", "ts")


def append_packets(packets: DataFrame, path: str, *, in_time_order: bool = False) -> None:
    """Append packets to a chunked table of files.

    Rows are ranged first, so that each task writes few files. Finding the ranges reads the rows
    once more, so they are written to the shared folder before, and lines are parsed once; a
    capture that is known to come in order of time can go without.
    """
    rows = local_layout(packets) if in_time_order else talker_layout(_staged(packets))
    rows.select(*PACKET_COLUMNS, "chunk").write.mode("append").partitionBy("chunk").parquet(path)


def _staged(packets: DataFrame) -> DataFrame:
    return kept(packets.select(*PACKET_COLUMNS), "staged")


def create_packets_table(spark: SparkSession, name: str, *, by_batch: bool = False) -> None:
    """A catalog table by hour; ``by_batch`` also by micro-batch, for a stream to write into."""
    columns = (
        "ts TIMESTAMP, src_ip STRING, dst_ip STRING, src_port INT, dst_port INT, "
        "proto STRING, length INT, payload STRING, chunk TIMESTAMP"
    )
    more, parts = (", batch_id BIGINT", "chunk, batch_id") if by_batch else ("", "chunk")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {checked_name(name)} ({columns}{more}) "
        f"USING parquet PARTITIONED BY ({parts})"
    )


def append_to_table(packets: DataFrame, name: str) -> None:
    rows = talker_layout(_staged(packets)).select(*PACKET_COLUMNS, "chunk")
    rows.write.mode("append").format("parquet").partitionBy("chunk").saveAsTable(checked_name(name))


def create_table_like(spark: SparkSession, name: str, like: str) -> None:
    """An empty table with the columns and partitions of another, if it is not there yet."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {checked_name(name)} LIKE {checked_name(like)}")


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {checked_name(name)}")


def with_payload_variant(packets: DataFrame) -> DataFrame:
    """Add the payload as a searchable VARIANT column next to the raw text."""
    return packets.withColumn("payload_variant", payload_variant(F.col("payload")))


def retained(packets: DataFrame, now: Column, keep: str = "1 day") -> DataFrame:
    """Rows whose whole chunk is not older than ``keep``; prunes chunks on a stored table."""
    chunk = F.col("chunk") if "chunk" in packets.columns else F.date_trunc("HOUR", F.col("ts"))
    return packets.filter(chunk > now - F.expr(f"INTERVAL {keep}") - chunk_width())


def expire_chunks(spark: SparkSession, name: str, now, keep: str = "1 day") -> list[str]:
    """Drop the table's chunks that lie wholly before ``now - keep``; returns their names.

    Works on the list of partitions only (one per hour and micro-batch), no packet is read.
    """
    table = checked_name(name)
    decoded = F.url_decode("partition")
    started = F.to_timestamp(F.regexp_extract(decoded, "chunk=([^/]*)", 1))
    limit = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {keep}") - chunk_width()
    # A folder name such as chunk=2024-01-01 12:00:00/batch_id=3 as a partition to drop.
    spec = F.regexp_replace(F.regexp_replace(decoded, "=([^/]*)", " = '$1'"), "/", ", ")
    old = (
        spark.sql(f"SHOW PARTITIONS {table}")
        .filter(started <= limit)
        .select(F.date_format(started, "yyyy-MM-dd HH:mm:ss").alias("chunk"), spec.alias("spec"))
        .toLocalIterator()
    )
    chunks, specs = set(), []

    def drop() -> None:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(f'PARTITION ({s})' for s in specs)}")
        specs.clear()

    for row in old:
        chunks.add(row.chunk)
        specs.append(row.spec)
        if len(specs) == DROPPED_AT_ONCE:
            drop()
    if specs:
        drop()
    return sorted(chunks)


def write_packets_jdbc(packets: DataFrame, url: str, name: str, batch_rows: int = 500, **options: str) -> None:
    """Append packets to a database table in batches (needs the JDBC driver)."""
    (
        packets.select(*PACKET_COLUMNS)
        .write.format("jdbc")
        .mode("append")
        .option("url", url)
        .option("dbtable", checked_name(name))
        .option("batchsize", batch_rows)
        .options(**options)
        .save()
    )
