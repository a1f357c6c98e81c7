"""The busiest address pairs of a stream, in memory of fixed size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from wirelake.sources import files

_SUMMARY = "src_ip STRING, dst_ip STRING, cnt BIGINT, slack BIGINT, seen BIGINT, batch_id BIGINT"
PAIR = ("src_ip", "dst_ip")


def merged(counts: DataFrame, size: int) -> DataFrame:
    """At most ``size`` pairs of ``src_ip, dst_ip, cnt``, and ``cut``, by which each was lessened.

    The count that comes next is taken off all of them; a pair that is left out had no more.
    """
    summed = counts.groupBy(*PAIR).agg(F.sum("cnt").alias("cnt"))
    first = summed.orderBy(F.col("cnt").desc(), *PAIR).limit(size + 1)  # of fixed size from here on
    rows = [tuple(r) for r in first.collect()]
    cut = rows[size][2] if len(rows) > size else 0
    kept = [(s, d, n - cut, cut) for s, d, n in rows[:size] if n > cut]
    return counts.sparkSession.createDataFrame(kept or [(None, None, 0, cut)], "src_ip STRING, dst_ip STRING, cnt BIGINT, cut BIGINT")


def heavy_talkers(packets: DataFrame, folder: str, checkpoint: str, *, size: int = 1000, trigger: dict | None = None) -> StreamingQuery:
    """Keep the busiest pairs of a stream of packets in ``folder``, a summary per micro-batch.

    A summary has at most ``size`` pairs, however many there are. A pair's true count lies between
    ``cnt`` and ``cnt + slack``, and ``slack`` is at most the packets seen divided by ``size + 1``; a
    pair without a row has ``slack`` packets at most. A micro-batch that is run again starts from
    the summary before it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counts = batch.groupBy(*PAIR).agg(F.count("*").alias("cnt"))
        counts = counts.persist()
        try:
            before = summary(spark, folder, batch_id)
            old = before.agg(F.coalesce(F.max("slack"), F.lit(0)), F.coalesce(F.max("seen"), F.lit(0))).first()
            seen = old[1] + (counts.agg(F.sum("cnt")).first()[0] or 0)
            known = before.filter("cnt > 0").select(*PAIR, "cnt")
            now = merged(counts.unionByName(known), size).select(
                *PAIR, "cnt", (F.col("cut") + F.lit(old[0])).alias("slack"), F.lit(seen).cast("bigint").alias("seen")
            )
            now.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")
        finally:
            counts.unpersist()

    return (
        packets.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .foreachBatch(write)
        .start()
    )


def summary(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """The last summary, or the last one of a micro-batch below ``before``; a row without a pair counts 0."""
    if not files.exists(spark, folder):
        return spark.createDataFrame([], _SUMMARY)
    rows = spark.read.schema(_SUMMARY).parquet(folder)
    if before is not None:
        rows = rows.filter(F.col("batch_id") < before)
    last = rows.agg(F.max("batch_id")).first()[0]
    return rows.filter(F.col("batch_id") == F.lit(last))
