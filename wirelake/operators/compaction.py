"""Fewer, larger files for closed hours, and expiry of hours, of tables that are folders of files."""

from __future__ import annotations

import math
import re
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wirelake.operators.traffic import chunk_width
from wirelake.schema import PACKET_COLUMNS, STORED_PACKETS
from wirelake.sources import files

#: Bytes of a compacted file, and hours that one job rewrites.
FILE_BYTES, HOURS_AT_ONCE = 128 << 20, 200
#: Folders that one step of an expiry deletes.
FOLDERS_AT_ONCE = 500
_CHUNK = re.compile(r"chunk=([^/]*)$")


def closed_hours(sizes: DataFrame, now, *, late: str = "0 seconds", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Hours that are over for at least ``late`` and have more files than they need.

    chunk, folder, files, bytes and bins, the number of files of about ``file_bytes`` that hold the hour.
    """
    over = F.col("chunk") + chunk_width() + F.expr(f"INTERVAL {late}") <= F.lit(now).cast("timestamp")
    hours = sizes.filter(over).groupBy("chunk").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    bins = F.greatest(F.ceil(F.col("bytes") / F.lit(file_bytes)), F.lit(1))
    return hours.select("chunk", files.hour_folder("chunk").alias("folder"), "files", "bytes", bins.alias("bins")).filter(
        F.col("files") > F.col("bins")
    )


def binned(packets: DataFrame, hours: list) -> DataFrame:
    """Packets dealt into their hour's bins, one task and so one file each, in talker order.

    A bin holds whole minutes of address pairs, so a busy pair is spread and a quiet one's minutes
    lie together.
    """
    first, total = [], 0
    for hour in hours:
        first.append((hour["chunk"], total, hour["bins"]))
        total += hour["bins"]
    known = packets.sparkSession.createDataFrame(first, "chunk TIMESTAMP, _first INT, _bins INT")
    dealt = packets.join(F.broadcast(known), "chunk")  # a row for each hour of this job
    minute = F.date_trunc("MINUTE", F.col("ts"))
    place = F.col("_first") + F.pmod(F.xxhash64("src_ip", "dst_ip", minute), F.col("_bins")).cast("int")
    placed = dealt.withColumn("_bin", place).drop("_first", "_bins").repartitionById(total, "_bin")
    return placed.drop("_bin").sortWithinPartitions("chunk", "src_ip", "dst_ip", "ts")


def _steps(hours: DataFrame) -> list[list]:
    found = hours.orderBy("chunk").collect()  # one row per hour that is due
    return [found[i : i + HOURS_AT_ONCE] for i in range(0, len(found), HOURS_AT_ONCE)]


def _replace(packets: DataFrame, path: str) -> None:
    """Write whole hours; they replace what the table has of them, other hours stay."""
    packets.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk").parquet(path)


def compact_table(spark: SparkSession, path: str, now, *, late: str = "0 seconds", file_bytes: int = FILE_BYTES) -> int:
    """Rewrite closed hours of an appended table with too many files; returns how many hours.

    Each hour is replaced as a whole when its new files are complete. Nothing may be appended to
    an hour while it is rewritten; ``late`` is the time after its end that it still may be.
    """
    done = 0
    for hours in _steps(closed_hours(files.file_sizes(spark, path), now, late=late, file_bytes=file_bytes)):
        rows = spark.read.schema(STORED_PACKETS).parquet(path)
        rows = rows.filter(F.col("chunk").isin([h["chunk"] for h in hours])).select(*PACKET_COLUMNS, "chunk")
        _replace(binned(rows, hours), path)
        done += len(hours)
    return done


def compact_ingested(
    spark: SparkSession,
    landed: str,
    compacted: str,
    now,
    schema: T.StructType,
    *,
    late: str = "0 seconds",
    file_bytes: int = FILE_BYTES,
) -> int:
    """Move closed hours of micro-batch files from ``landed`` to ``compacted``; returns how many hours.

    Compacted rows keep the number of their micro-batch. If this stops between writing an hour and
    removing its micro-batches, or if one of them is run again later, its rows are known by that
    number: readers (``current``) and the next compaction count them once. A micro-batch that comes
    late for an hour is merged by the next run.
    """
    here, there = files.file_sizes(spark, landed), files.file_sizes(spark, compacted)
    due = closed_hours(here.unionByName(there), now, late=late, file_bytes=file_bytes)
    leftover = here.select("chunk").distinct()
    done = 0
    for hours in _steps(due.join(leftover, "chunk", "left_semi")):
        chunks = [h["chunk"] for h in hours]
        # What is removed later is what is listed now: a micro-batch that lands meanwhile stays.
        gone = [f for h in hours for f in files.folders(spark, f"{landed}/{h['folder']}")]
        rows = current(spark, landed, compacted, schema).filter(F.col("chunk").isin(chunks))
        _replace(binned(rows, hours), compacted)
        for folder in gone:
            files.remove_folder(spark, folder)
        done += len(hours)
    return done


def current(spark: SparkSession, landed: str, compacted: str, schema: T.StructType) -> DataFrame:
    """The packets of both folders, with the columns of ``schema``; a micro-batch of an hour counts once."""

    def read(path: str) -> DataFrame:
        if not files.exists(spark, path):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())

    if not files.exists(spark, compacted):
        return read(landed)
    large = read(compacted)
    known = large.select("chunk", "batch_id").distinct()
    small = read(landed).join(known, ["chunk", "batch_id"], "left_anti")
    return large.unionByName(small)


def expire_folders(spark: SparkSession, path: str, now, keep: str = "1 day", at_once: int = FOLDERS_AT_ONCE) -> list[str]:
    """Delete the hours of a folder of packets that lie wholly before ``now - keep``; returns them.

    Works on the names of the hour folders, in steps; an hour that was deleted in a run that
    failed is gone, the next run goes on with the others.
    """
    limit = spark.range(1).select(
        (F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {keep}") - chunk_width()).cast("timestamp_ntz")
    ).first()[0]
    expired: list[str] = []
    step: list[tuple[str, str]] = []

    def drop() -> None:
        for folder, hour in step:
            files.remove_folder(spark, folder)
            expired.append(hour)
        step.clear()

    for folder in files.folders(spark, path):
        found = _CHUNK.search(folder)
        if not found:
            continue
        hour = unquote(found.group(1))
        if _time(hour) <= limit:
            step.append((folder, hour))
        if len(step) == at_once:
            drop()
    drop()
    return sorted(expired)


def _time(text: str) -> datetime:
    return datetime.fromisoformat(text)
