"""Helpers the operators share: tables, written steps, and running offsets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wirelake.session import run_folder

#: Bytes that separate words: space and the controls from tab to carriage return.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The rows written to the shared folder and read back; cuts the lineage for good.

    Shuffle files of the writing go as soon as it is done, not when the driver's memory is next
    searched for what nobody refers to.
    """
    spark = df.sparkSession
    path = path or run_folder(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once even if a lambda uses it for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as it takes to be no column of the rows."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
