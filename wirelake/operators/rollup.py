"""Per-hour results of a packet table that are kept up to date.

A rollup holds partial results of each hour, and with them a mark of the files they come from. A
refresh compares the marks with the table's present files, by name and size, and measures only
hours whose files have changed: new ones, and those that late packets, compaction or expiry have
touched. Partial results of hours merge into any longer answer.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wirelake.sources import files

#: Hours that one job measures anew.
HOURS_AT_ONCE = 500
#: Normalised rank error of a sketch of this size is about 1.7 percent.
SKETCH_SIZE = 200
_MARK = "mark BIGINT, chunk TIMESTAMP"


@dataclass(frozen=True)
class Measure:
    """What a rollup keeps of an hour: the rows of ``run`` (on packets with chunk) and their columns."""

    run: Callable[[DataFrame], DataFrame]
    columns: str

    @property
    def names(self) -> list[str]:
        return [c.split()[0] for c in self.columns.split(", ")]


def _pair_minutes(packets: DataFrame) -> DataFrame:
    return packets.groupBy("chunk", F.date_trunc("MINUTE", F.col("ts")).alias("minute"), "src_ip", "dst_ip").agg(
        F.count("*").alias("packets"), F.sum("length").alias("bytes")
    )


#: Packets and bytes of each minute and address pair.
PAIR_MINUTES = Measure(_pair_minutes, "minute TIMESTAMP, src_ip STRING, dst_ip STRING, packets BIGINT, bytes BIGINT")


def latency_minutes(group: Column, within_ms: int = 1000, landed: str = "landed") -> Measure:
    """The delays from packet time to landing of each minute and ``group``, as mergeable sketches."""

    def run(packets: DataFrame) -> DataFrame:
        delay = F.unix_millis(landed) - F.unix_millis("ts")
        return (
            packets.select("chunk", F.date_trunc("MINUTE", F.col("ts")).alias("minute"), group.alias("grp"), delay.alias("_ms"))
            .groupBy("chunk", "minute", "grp")
            .agg(
                F.count("_ms").alias("packets"), F.min("_ms").alias("min_ms"), F.max("_ms").alias("max_ms"),
                F.count_if(F.col("_ms") <= within_ms).alias("in_time"),
                F.kll_sketch_agg_bigint("_ms", SKETCH_SIZE).alias("sketch"),
            )
        )

    return Measure(
        run, "minute TIMESTAMP, grp STRING, packets BIGINT, min_ms BIGINT, max_ms BIGINT, in_time BIGINT, sketch BINARY"
    )


def stored_rollup(spark: SparkSession, rollup: str, measure: Measure) -> DataFrame:
    schema = f"{measure.columns}, {_MARK}"
    if not files.exists(spark, rollup):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(rollup)


def _marks(spark: SparkSession, tables: list[str]) -> DataFrame:
    """``chunk, mark``: a number that changes with the names and sizes of the hour's files."""
    found = None
    for table in tables:
        sizes = files.file_sizes(spark, table)
        found = sizes if found is None else found.unionByName(sizes)
    name = F.regexp_extract("path", "[^/]*$", 0)
    each = found.filter("chunk IS NOT NULL").select("chunk", F.xxhash64(name, "length").alias("_h"))
    return each.groupBy("chunk").agg(F.expr("bit_xor(_h)").alias("mark"))


def refresh(
    spark: SparkSession, packets: Callable[[], DataFrame], tables: list[str], rollup: str, measure: Measure = PAIR_MINUTES
) -> list:
    """Bring the rollup up to date; returns the hours that were measured anew.

    ``packets`` opens the table, with chunk, whose files lie in the folders ``tables``. An hour's
    old results are replaced when its new ones are complete, so a refresh that stops is taken up
    by the next one. Hours that the table no longer has are removed.
    """
    known = stored_rollup(spark, rollup, measure).groupBy("chunk").agg(F.max("mark").alias("known"))
    both = _marks(spark, tables).join(known, "chunk", "full")
    # One row per hour that has changed, from file names alone.
    changed = both.filter(~F.col("mark").eqNullSafe(F.col("known"))).select(
        "chunk", "mark", files.hour_folder("chunk").alias("folder")
    ).orderBy("chunk").collect()
    due = [r for r in changed if r["mark"] is not None]
    for i in range(0, len(due), HOURS_AT_ONCE):
        hours = due[i : i + HOURS_AT_ONCE]
        marks = spark.createDataFrame([(h["chunk"], h["mark"]) for h in hours], "chunk TIMESTAMP, mark BIGINT")
        rows = packets().filter(F.col("chunk").isin([h["chunk"] for h in hours]))
        measured = measure.run(rows).join(F.broadcast(marks), "chunk")  # a row for each hour of this job
        ordered = measured.repartitionByRange("chunk", "minute").sortWithinPartitions("chunk", "minute")
        ordered.select(*measure.names, "mark", "chunk").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("chunk").parquet(rollup)
    for r in changed:
        if r["mark"] is None:
            files.remove_folder(spark, f"{rollup}/{r['folder']}")
    return [r["chunk"] for r in due]


def per_minute(rolled: DataFrame) -> DataFrame:
    """Packets, bytes and packets per second for each minute, from pair minutes."""
    return rolled.groupBy("minute").agg(F.sum("packets").alias("packets"), F.sum("bytes").alias("bytes")).withColumn(
        "pps", F.col("packets") / 60.0
    )


def talkers_per_minute(rolled: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` busiest address pairs of each minute, from pair minutes."""
    rank = Window.partitionBy("minute").orderBy(F.col("packets").desc(), "src_ip", "dst_ip")
    counted = rolled.select("minute", "src_ip", "dst_ip", "packets")
    return counted.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)


def latency(rolled: DataFrame) -> DataFrame:
    """Spread of the delays per group, from latency minutes; p50_ms and p95_ms from the merged sketches."""
    merged = rolled.groupBy("grp").agg(
        F.sum("packets").alias("packets"), F.min("min_ms").alias("min_ms"), F.max("max_ms").alias("max_ms"),
        F.sum("in_time").alias("in_time"), F.kll_merge_agg_bigint("sketch", SKETCH_SIZE).alias("_sketch"),
    )
    quantiles = [F.kll_sketch_get_quantile_bigint("_sketch", F.lit(q)).alias(f"p{round(100 * q)}_ms") for q in (0.5, 0.95)]
    return merged.select("grp", "packets", "min_ms", "max_ms", "in_time", *quantiles)
