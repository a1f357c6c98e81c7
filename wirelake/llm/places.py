"""Places of rows within ordered groups, however large a group is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from wirelake.llm.shards import numbered

#: Rows of one stretch of the order; a group's rows in it are looked up by group and stretch.
STRETCH = 1 << 16


def grouped(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Rows with ``start`` (a group's first place in the whole order), ``pos`` (from 0) and ``n``.

    Groups lie one behind the other, null first, so ``start`` also names the group and sorts as
    it does. Rows are ranged over group and order and numbered by range; a group's start and size
    come from one row per group and stretch, so no task sees a whole group. Rows equal in the
    whole order are numbered in any order. An empty table gives no rows.
    """
    placed, _ = numbered(rows, [group, *order])
    placed = placed.withColumn("_stretch", F.expr(f"place div {STRETCH}"))
    parts = placed.groupBy(group, "_stretch").agg(F.min("place").alias("_low"), F.count("*").alias("_rows"))
    whole = parts.groupBy(F.col(group).alias("_group")).agg(F.min("_low").alias("start"), F.sum("_rows").alias("n"))
    known = parts.join(whole, F.col(group).eqNullSafe(F.col("_group"))).select(
        "_group", F.col("_stretch").alias("_part"), "start", "n"
    )
    found = placed.join(
        known, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_stretch") == F.col("_part"))
    )
    return found.withColumn("pos", F.col("place") - F.col("start")).drop("place", "_stretch", "_group", "_part")
