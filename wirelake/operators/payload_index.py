"""An index of what the payloads of a packet table contain, kept beside the table.

For every file the index holds the hashes of its documents' paths and values, each once, sorted
by hash below the hour. A search hashes the values of its pattern the same way, keeps the files
that hold all of them, and only reads and parses those. Hashes stand for a path without places in
arrays and for a value of a kind, so a file that the index names may still have no match; one
that it leaves out has none. Files that are not indexed yet are always read.
"""

from __future__ import annotations

import re
from urllib.parse import unquote, unquote_plus

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wirelake.functions.payload import payload_contains, payload_variant
from wirelake.operators.traffic import time_range
from wirelake.schema import STORED_PACKETS

#: Steps from a document's top down to which values are indexed; deeper ones do not narrow a search.
DEPTH = 8
_PAIRS = "pair BIGINT, file STRING, chunk TIMESTAMP"
_FILES = "file STRING"
_TOP = 0


def _object_step(path: Column, key: Column) -> Column:
    return F.xxhash64(path, F.lit("."), key)


def _array_step(path: Column) -> Column:
    return F.xxhash64(path, F.lit("[]"))


def _scalar(kind: Column, text: Column, number: Column) -> Column:
    """A scalar's text for hashing; null for objects and arrays.

    Whatever a search takes as equal has one text: numbers count by their value to three places.
    """
    plain = F.concat(F.lit("n"), (F.round(number, 3) + F.lit(0.0)).cast("string"))
    return (
        F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(None).cast("string"))
        .when(kind == "VOID", "null")
        .when(kind == "BOOLEAN", F.concat(F.lit("b"), text))
        .when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), plain)
        .otherwise(F.concat(F.lit("s"), text))
    )


def payload_pairs(packets: DataFrame, *keep: str, payload: str = "payload", depth: int = DEPTH) -> DataFrame:
    """A row for each value in each payload: the ``keep`` columns and ``pair``, the hash of path and value."""
    rows = packets.select(*keep, payload_variant(F.col(payload)).alias("_value"), F.lit(_TOP).cast("bigint").alias("_path"))
    for _ in range(depth):
        # Scalars give one row without a value, and pass through as they are.
        inside = rows.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col("_value").outer()))
        step = F.when(F.col("key").isNotNull(), _object_step(F.col("_path"), F.col("key"))).otherwise(_array_step(F.col("_path")))
        rows = inside.select(
            *keep,
            F.coalesce("value", "_value").alias("_value"),
            F.when(F.col("value").isNull(), F.col("_path")).otherwise(step).alias("_path"),
        )
    value = F.col("_value")
    text = _scalar(
        F.schema_of_variant(value), F.try_variant_get(value, "$", "string"), F.try_variant_get(value, "$", "double")
    )
    return rows.filter(value.isNotNull()).select(*keep, F.col("_path"), text.alias("_text")).filter(
        F.col("_text").isNotNull()
    ).select(*keep, F.xxhash64("_path", "_text").alias("pair"))


def pattern_pairs(pattern, depth: int = DEPTH) -> list[Column]:
    """The hashes that a document must have to contain ``pattern``; none if nothing can be said."""
    if not isinstance(pattern, (dict, list)):
        return []  # a document that is this value, or an array with it

    def walk(path: Column, level: int, wanted) -> list[Column]:
        if isinstance(wanted, dict):
            return [p for k, v in wanted.items() for p in walk(_object_step(path, F.lit(k)), level + 1, v)]
        if isinstance(wanted, list):
            return [p for v in wanted for p in walk(_array_step(path), level + 1, v)]
        if level > depth:
            return []
        if wanted is None:
            kind, value = "VOID", F.lit(None)
        elif isinstance(wanted, bool):
            kind, value = "BOOLEAN", F.lit(wanted)
        else:
            kind, value = ("STRING" if isinstance(wanted, str) else "DOUBLE"), F.lit(wanted)
        number = F.lit(None).cast("double") if isinstance(wanted, str) else value.cast("double")
        return [F.xxhash64(path, _scalar(F.lit(kind), value.cast("string"), number))]

    return walk(F.lit(_TOP).cast("bigint"), 0, pattern)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of the index, without rows if it has not been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


#: A file's partition folders and name: one task gives its files in several folders one name.
_NAME = "(?:[A-Za-z_]+=[^/]*/)*[^/]*$"


def _name(path: str) -> str:
    return re.search(_NAME, unquote_plus(path)).group()


def _files(spark: SparkSession, table: str) -> dict[str, str]:
    """The table's files by name, as Spark's own listing has them."""
    found = spark.read.schema(STORED_PACKETS).parquet(table).inputFiles()
    return {_name(f): unquote(f) for f in found}


def _packets(spark: SparkSession, table: str, files: list[str]) -> DataFrame:
    return spark.read.schema(STORED_PACKETS).option("basePath", table).parquet(*files)


def index_payloads(spark: SparkSession, table: str, index: str) -> int:
    """Index the table's files that are not indexed yet; returns how many.

    Payloads are parsed once; equal hashes of a file are reduced before the shuffle. The list of
    indexed files is written last, so files of a run that failed are indexed again.
    """
    known = {r["file"] for r in _read(spark, f"{index}/files", _FILES).toLocalIterator()}
    fresh = {name: path for name, path in _files(spark, table).items() if name not in known}
    if not fresh:
        return 0
    packets = _packets(spark, table, list(fresh.values())).withColumn("file", F.regexp_extract(F.url_decode("_metadata.file_path"), _NAME, 0))
    found = payload_pairs(packets, "file", "chunk").distinct()
    found.repartitionByRange("chunk", "pair", "file").sortWithinPartitions("chunk", "pair").write.mode("append").partitionBy(
        "chunk"
    ).parquet(f"{index}/pairs")
    spark.createDataFrame([(n,) for n in fresh], _FILES).coalesce(1).write.mode("append").parquet(f"{index}/files")
    return len(fresh)


def matching_files(
    spark: SparkSession, table: str, index: str, pattern, low: Column | None = None, high: Column | None = None
) -> list[str]:
    """The table's files that may hold a match, by the index; those not indexed are among them."""
    files = _files(spark, table)
    wanted = pattern_pairs(pattern)
    if not wanted:
        return list(files.values())
    hashes = spark.range(1).select(F.array_distinct(F.array(*wanted))).first()[0]
    pairs = _read(spark, f"{index}/pairs", _PAIRS).filter(F.col("pair").isin(hashes))
    if low is not None:
        pairs = pairs.filter(F.col("chunk") > low - F.expr("INTERVAL 1 HOUR"))
    if high is not None:
        pairs = pairs.filter(F.col("chunk") < high)
    hit = pairs.groupBy("file").agg(F.count_distinct("pair").alias("n")).filter(F.col("n") == len(hashes))
    named = {r["file"] for r in hit.toLocalIterator()}
    known = {r["file"] for r in _read(spark, f"{index}/files", _FILES).toLocalIterator()}
    return [path for name, path in files.items() if name in named or name not in known]


def search_payloads(
    spark: SparkSession, table: str, index: str, pattern, low: Column | None = None, high: Column | None = None
) -> DataFrame:
    """Packets of a table whose payload contains ``pattern``, as ``payload_contains`` finds them.

    Only files that the index names, or does not know, are read. ``low`` and ``high`` (times) narrow
    both the index and the packets.
    """
    files = matching_files(spark, table, index, pattern, low, high)
    if not files:
        return spark.createDataFrame([], STORED_PACKETS)
    packets = _packets(spark, table, files)
    if low is not None or high is not None:
        first, last = (F.lit(t).cast("timestamp") for t in ("0001-01-01", "9999-12-31"))
        packets = time_range(packets, first if low is None else low, last if high is None else high)
    return payload_contains(packets, pattern)
