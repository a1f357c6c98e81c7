"""Several independent subscribers to the same stream of lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from wirelake.operators.shape import dead_letter_json, dead_letters, shape_packets, shape_lines
from wirelake.operators.storage import with_chunk

Sink = Callable[[DataFrame, str], StreamingQuery]


def fan_out(lines: DataFrame, sinks: dict[str, Sink], checkpoints: str) -> dict[str, StreamingQuery]:
    """Start one query per sink; each keeps its own position and fails on its own."""
    return {name: start(lines, f"{checkpoints}/{name}") for name, start in sinks.items()}


def parquet_sink(path: str, trigger: dict, spread: int = 4) -> Sink:
    """Packets as Parquet files by hour, written exactly once by the file sink.

    The packets of an hour are brought together by address pair in up to ``spread`` tasks, so a
    micro-batch writes that many files an hour at most, and a busy hour is not one task.
    """

    def start(lines: DataFrame, checkpoint: str) -> StreamingQuery:
        packets = with_chunk(shape_packets(lines)).withColumn("_part", F.pmod(F.xxhash64("src_ip", "dst_ip"), F.lit(spread)))
        packets = packets.repartition("chunk", "_part").drop("_part")
        return (
            packets.writeStream.format("parquet")
            .partitionBy("chunk")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )

    return start


def dead_letter_sink(path: str, trigger: dict) -> Sink:
    """Dead letters as lines of JSON."""

    def start(lines: DataFrame, checkpoint: str) -> StreamingQuery:
        letters = dead_letter_json(dead_letters(shape_lines(lines), F.current_timestamp()))
        return (
            letters.writeStream.format("text")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )

    return start


def line_sink(path: str, trigger: dict) -> Sink:
    """The lines themselves, passed on unchanged."""

    def start(lines: DataFrame, checkpoint: str) -> StreamingQuery:
        return (
            lines.select("value")
            .writeStream.format("text")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )

    return start


def topic_sink(servers: str, topic: str, trigger: dict) -> Sink:
    """The lines as messages of a topic. Needs Spark's Kafka package on the class path."""

    def start(lines: DataFrame, checkpoint: str) -> StreamingQuery:
        return (
            lines.select("value")
            .writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )

    return start
