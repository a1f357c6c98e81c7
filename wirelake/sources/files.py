"""Files and folders of a table, through Spark's own file system layer."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``length``, ``chunk`` and ``batch_id`` of a table's Parquet files; no content is read.

    ``chunk`` is null for files outside of hour folders, ``batch_id`` outside of micro-batch folders.
    A missing table has no files.
    """
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path STRING, length BIGINT")
    decoded = F.url_decode("path")
    return files.select(
        "path", "length",
        F.try_to_timestamp(F.regexp_extract(decoded, "/chunk=([^/]*)/", 1)).alias("chunk"),
        F.expr("try_cast(regexp_extract(path, '/batch_id=([^/]*)/', 1) AS BIGINT)").alias("batch_id"),
    )


def hour_folder(chunk: str) -> Column:
    """The name of an hour's folder in a table that is partitioned by ``chunk``."""
    return F.date_format(chunk, "'chunk='yyyy-MM-dd HH'%3A'mm'%3A'ss")


def folders(spark: SparkSession, path: str) -> Iterator[str]:
    """The folders right below ``path``, one after the other; none if it is missing."""
    system, root = _system(spark, path)
    if not system.exists(root):
        return
    found = system.listStatusIterator(root)
    while found.hasNext():
        status = found.next()
        if status.isDirectory():
            yield status.getPath().toString()


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder with all it holds; False if there is none."""
    system, target = _system(spark, path)
    return bool(system.delete(target, True))


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _system(spark, path)
    return bool(system.exists(target))


def _system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target
