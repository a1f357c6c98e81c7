"""Reading packet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wirelake.functions.identifiers import checked_name
from wirelake.schema import STORED_PACKETS


def packets_path(spark: SparkSession, path: str) -> DataFrame:
    """A packet table stored as files; the schema is given, so nothing is inferred."""
    return spark.read.schema(STORED_PACKETS).parquet(path)


def packets_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": checked_name(name)})


def packets_jdbc(
    spark: SparkSession, url: str, name: str, lower: str, upper: str, partitions: int, **options: str
) -> DataFrame:
    """A packet table in a database, read in time slices (needs the JDBC driver)."""
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", checked_name(name))
        .option("partitionColumn", "ts")
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .options(**options)
        .load()
    )

