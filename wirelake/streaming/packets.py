"""Stateful streaming forms: duplicates and minutes."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from wirelake.operators.storage import with_chunk
from wirelake.operators.traffic import IDENTITY, packet_id
from wirelake.schema import PACKET_COLUMNS, STORED_PACKETS
from wirelake.sources import files

#: Bits of the filter that the ids of a micro-batch are sent out as: 1 MB at most.
FILTER_BITS = 1 << 23


def dedup_stream(packets: DataFrame, late: str = "10 minutes", salts: int = 16) -> DataFrame:
    """Drop packets whose message id was seen within ``late``; older ids leave the state.

    Copies are first dropped where they are read, within each batch of rows that a task takes at
    once, so of a packet with very many copies few are left for the task that decides. That step
    keeps nothing; ``salts=1`` does without it.
    """
    known = packets.withColumn("msg_id", packet_id()).withWatermark("ts", late)
    if salts > 1:
        known = known.filter(_first_of_batch()("msg_id"))
    return known.dropDuplicatesWithinWatermark(["msg_id"])


def _first_of_batch() -> Callable[..., Column]:
    """True for the first of equal values in each batch of rows, the null ones among them."""

    def first(ids: pa.Array) -> pa.Array:
        values = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
        out = np.zeros(len(values), bool)
        out[np.unique(values, return_index=True)[1]] = True
        return pa.array(out)

    return F.arrow_udf(first, "boolean").asNondeterministic()


def per_minute_stream(packets: DataFrame, late: str = "2 minutes") -> DataFrame:
    """Packets and bytes per minute; a minute is final once ``late`` has passed."""
    return (
        packets.withWatermark("ts", late)
        .groupBy(F.window("ts", "1 minute").alias("w"))
        .agg(F.count("*").alias("packets"), F.sum("length").alias("bytes"))
        .select(F.col("w.start").alias("minute"), "packets", "bytes")
    )


def _filter_place() -> Column:
    return F.pmod(F.xxhash64(F.unix_micros("ts"), *IDENTITY[1:]), F.lit(FILTER_BITS))


def _same_packet(left: DataFrame, right: DataFrame) -> Column:
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in IDENTITY])


def stored_copies(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """The identity columns of stored packets that a micro-batch (with ``chunk``) holds again.

    Only the hours of the micro-batch are read, and of those only the identity columns. The ids
    of the micro-batch go to every task as a bitmap of fixed size, so of the stored rows only its
    hits, and few others, are shuffled and compared.
    """
    hours = [r["chunk"] for r in batch.select("chunk").distinct().collect()]  # hours, however many packets
    place = _filter_place()
    bitmap = batch.groupBy(F.bitmap_bucket_number(place).alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")
    )
    near = stored.filter(F.col("chunk").isin(hours)).select(*IDENTITY, place.alias("_place"))
    near = near.withColumn("_part", F.bitmap_bucket_number("_place")).join(F.broadcast(bitmap), "_part")
    bit = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.expr("substring(_bits, CAST(bitmap_bit_position(_place) div 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    hit = F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(1) == 1
    return near.filter(hit).select(*IDENTITY).distinct()


def refuse_stored(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """A micro-batch (with ``chunk``) without packets that are stored already, copies within it once."""
    known = stored_copies(batch, stored)
    fresh = batch.join(known, _same_packet(batch, known), "left_anti")
    return fresh.dropDuplicates([*IDENTITY])


def dedup_into(
    packets: DataFrame,
    path: str,
    checkpoint: str,
    *,
    late: str = "10 minutes",
    trigger: dict | None = None,
    first_batch: int = 0,
) -> StreamingQuery:
    """Store a stream of packets in a folder by hour and micro-batch, each packet once for good.

    Copies within ``late`` are dropped by the stream's state; a copy that comes later, when its id
    has left the state, is compared with what is stored. A micro-batch that is run again replaces
    its own part and is not compared with it. A stream with a new checkpoint needs a
    ``first_batch`` beyond the numbers that the folder has.
    """
    schema = T.StructType([*STORED_PACKETS.fields, T.StructField("batch_id", T.LongType())])

    def write(batch: DataFrame, number: int) -> None:
        spark, batch_id = batch.sparkSession, first_batch + number
        rows = with_chunk(batch.select(*PACKET_COLUMNS)).persist()
        try:
            if files.exists(spark, path):
                before = spark.read.schema(schema).parquet(path).filter(F.col("batch_id") != batch_id)
                fresh = refuse_stored(rows, before)
            else:
                fresh = rows.dropDuplicates([*IDENTITY])
            ordered = fresh.repartitionByRange("chunk", "src_ip", "dst_ip", "ts").sortWithinPartitions("chunk", "src_ip", "dst_ip", "ts")
            ordered.select(*PACKET_COLUMNS, "chunk", F.lit(batch_id).cast("bigint").alias("batch_id")).write.mode(
                "overwrite"
            ).option("partitionOverwriteMode", "dynamic").partitionBy("chunk", "batch_id").parquet(path)
        finally:
            rows.unpersist()

    return (
        dedup_stream(packets, late)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .foreachBatch(write)
        .start()
    )
