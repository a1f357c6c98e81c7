"""Running values per key that do not need one key to fit into one task.

A window over a whole key sorts all its rows in a single task. Here the rows are ranged over
``(keys, order)`` and written once, each with the number of its range, so a range holds a bounded
share of all rows, whatever the keys and however dense the order. Totals of each key in each range
are aggregated and carried forward, one row per range that the key reaches; each range then gets
its carry as one extra row that sorts before its own rows, and a window over ``(keys, range)``
does the rest.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from wirelake.session import shared_folder

#: The column that names a row's range; the functions below keep it, the last caller drops it.
BLOCK = "_block"
_FOLDS = {"sum": F.sum, "max": F.max}


def kept(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read back, for steps that read them more than once."""
    path = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def in_blocks(rows: DataFrame, keys: tuple[str, ...], order: str) -> DataFrame:
    """Rows with the range they lie in; rows that have one already are left as they are.

    Rows equal in keys and order are split by a hash of their other columns. The table in the
    shared folder fixes the ranges, which come from sampling, for all that follows, and a source
    is parsed for it and the sampling alone.
    """
    if BLOCK in rows.columns:
        return rows
    plain = [f.name for f in rows.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    ranged = rows.withColumn("_tie", F.xxhash64(*plain)).repartitionByRange(*keys, order, "_tie").drop("_tie")
    ranged = ranged.withColumn(BLOCK, F.spark_partition_id())
    return kept(ranged, "blocks")


def running(
    rows: DataFrame,
    keys: tuple[str, ...],
    order: str,
    value: Column,
    how: str,
    name: str,
    *,
    inclusive: bool = True,
) -> DataFrame:
    """Add column ``name``: the ``sum`` or ``max`` of ``value`` over the key's rows up to this one.

    ``order`` is a number that is unique within its key. ``max`` also works on structs that start
    with the order value, which makes it "the latest value so far". An empty range gives NULL.
    """
    total, fold = "_total", _FOLDS[how]
    blocked = in_blocks(rows, keys, order).withColumn(total, value)
    totals = blocked.groupBy(*keys, BLOCK).agg(fold(total).alias(total))
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry_rows = totals.withColumn("_carry", fold(total).over(before)).select(
        *keys, BLOCK, F.col("_carry").alias(total), F.lit(True).alias("_is_carry")
    )
    together = blocked.withColumn("_is_carry", F.lit(False)).unionByName(
        carry_rows, allowMissingColumns=True
    )
    last = Window.currentRow if inclusive else -1
    within = (
        Window.partitionBy(*keys, BLOCK)
        .orderBy(F.col("_is_carry").desc(), order)
        .rowsBetween(Window.unboundedPreceding, last)
    )
    return (
        together.withColumn(name, fold(total).over(within))
        .filter(~F.col("_is_carry"))
        .drop(total, "_is_carry")
    )


def ordinal(rows: DataFrame, keys: tuple[str, ...], order: str, name: str = "ordinal") -> DataFrame:
    """Add ``name``: the row's place, from 0, in its key by ``order``."""
    one = F.lit(1).cast("bigint")
    return running(rows, keys, order, one, "sum", name).withColumn(name, F.col(name) - 1)


def previous(rows: DataFrame, keys: tuple[str, ...], order: str, value: Column, name: str) -> DataFrame:
    """Add ``name``: ``value`` of the row before this one in its key, NULL for the first."""
    entry = F.struct(F.col(order).alias("at"), value.alias("value"))
    return running(rows, keys, order, entry, "max", name, inclusive=False).withColumn(name, F.col(name)["value"])
