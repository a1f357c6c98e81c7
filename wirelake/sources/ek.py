"""Dissector output: newline-delimited JSON lines, from files or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wirelake.functions.text import strip


def is_packet_line(line: Column) -> Column:
    """Index lines are interleaved with packet lines; they and blank lines carry no packet."""
    return (line != "") & ~line.startswith('{"index"')


def clean_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Strip white space and keep packet lines; all other columns pass through."""
    return lines.withColumn(column, strip(F.col(column))).filter(is_packet_line(F.col(column)))


def ek_scan(spark: SparkSession, path) -> DataFrame:
    return clean_lines(spark.read.text(path))


def ek_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded form: files that appear in a folder. The limit bounds one micro-batch."""
    reader = spark.readStream.schema("value STRING")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return clean_lines(reader.text(path))


def ek_topic(spark: SparkSession, servers: str, topic: str, max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Unbounded form: a message topic. Needs Spark's Kafka package on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return clean_lines(reader.load().select(F.col("value").cast("string")))
