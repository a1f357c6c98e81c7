"""What waits at the source of a stream, as samples of the buffer gauge."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from wirelake.sources import files

# The gauge of lines that wait, and of the memory of this process.
BUFFER = "worker_buffer_size"
MEMORY = "process_memory_bytes"


def _plain(path: Column) -> Column:
    """A file's address with one slash behind its scheme, as listings and logs write it differently."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def taken_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``path, batch``: the files that a stream of files has planned into micro-batches so far."""
    entries = spark.read.text(f"{checkpoint}/sources/0").select(
        F.from_json("value", "path STRING, batchId BIGINT").alias("e")
    )
    return entries.filter("e.path IS NOT NULL").select(_plain(F.col("e.path")).alias("path"), F.col("e.batchId").alias("batch")).distinct()


def waiting_lines(spark: SparkSession, folder: str, checkpoint: str, batch_id: int, lines: int) -> float:
    """How many lines wait in a folder's files that no micro-batch has taken yet.

    The bytes of the files are set against those of micro-batch ``batch_id``, which had ``lines``.
    """
    present = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        .select(_plain(F.col("path")).alias("path"), "length")
    )
    taken = taken_files(spark, checkpoint)
    found = present.join(taken, "path", "left").agg(
        F.coalesce(F.sum(F.when(F.col("batch").isNull(), F.col("length"))), F.lit(0)).alias("waiting"),
        F.coalesce(F.sum(F.when(F.col("batch") == batch_id, F.col("length"))), F.lit(0)).alias("read"),
    ).first()
    return float(round(found["waiting"] * lines / found["read"])) if found["read"] else 0.0


def used_memory(spark: SparkSession) -> float:
    """Bytes of heap that the driver's JVM has in use."""
    runtime = spark._jvm.java.lang.Runtime.getRuntime()
    return float(runtime.totalMemory() - runtime.freeMemory())


def behind(progress: dict) -> int | None:
    """How many messages wait by a progress report, for sources whose offsets are numbers.

    Such a source (a message topic) reports its latest and its processed offset per partition;
    None if no source does.
    """

    def numbers(offset) -> dict:
        if isinstance(offset, str):
            try:
                offset = json.loads(offset)
            except ValueError:
                return {}
        if not isinstance(offset, dict):
            return {}
        return {(t, p): n for t, parts in offset.items() if isinstance(parts, dict) for p, n in parts.items()}

    total = None
    for source in progress.get("sources", []):
        latest, done = numbers(source.get("latestOffset")), numbers(source.get("endOffset"))
        if latest:
            total = (total or 0) + sum(max(n - done.get(key, 0), 0) for key, n in latest.items())
    return total


class BacklogListener(StreamingQueryListener):
    """Keeps a sample of the buffer gauge for every micro-batch of a topic's stream.

    ``samples`` holds (scrape time, gauge, value, micro-batch); ``rows`` gives them as a table.
    """

    def __init__(self, name: str | None = None):
        self.name = name
        self.samples: list[tuple[str, str, float, int]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.add(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def add(self, progress: dict) -> None:
        waiting = behind(progress)
        if waiting is not None and self.name in (None, progress.get("name")):
            self.samples.append((progress["timestamp"], BUFFER, float(waiting), int(progress["batchId"])))

    def rows(self, spark: SparkSession) -> DataFrame:
        made = spark.createDataFrame(self.samples, "at STRING, name STRING, value DOUBLE, batch_id BIGINT")
        return made.select(F.to_timestamp("at").alias("scrape_ts"), "name", "value", "batch_id")
