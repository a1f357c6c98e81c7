"""Comparing packet tables: order-independent digests and differences with multiplicity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wirelake.functions.text import utc_micros_text
from wirelake.schema import SHAPED_COLUMNS

_EXACT = "decimal(20,0)"


def row_text() -> Column:
    """A packet's shaped columns joined by ``|``, NULL as ``~``."""
    texts = [utc_micros_text(F.col("ts"))] + [F.col(c).cast("string") for c in SHAPED_COLUMNS[1:]]
    return F.concat_ws("|", *[F.coalesce(t, F.lit("~")) for t in texts])


def _hash32(text: Column) -> Column:
    """The first 32 bits of the text's MD5 as an unsigned number."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast(_EXACT)


def _digest(total: Column) -> Column:
    return F.coalesce(F.md5(total.cast("string").cast("binary")), F.lit("empty"))


def payload_text(canonical: bool = False) -> Column:
    """The raw payload, or its normalised JSON (raw where the text is no JSON; of a repeated key the last value)."""
    raw = F.col("payload")
    return F.coalesce(F.to_json(F.try_parse_json(raw)), raw) if canonical else raw


def table_checksum(packets: DataFrame, *groups: str, canonical: bool = False) -> DataFrame:
    """``rows, digest, payloads`` of a table; the same rows in any order give the same digests.

    Each row adds the first 32 bits of its MD5 to a sum, and the sum's text is hashed. Sums
    are taken in each task first, so only totals are shuffled. An empty table is ``empty``.
    """
    return (
        packets.groupBy(*groups)
        .agg(
            F.count("*").alias("rows"),
            F.sum(_hash32(row_text())).alias("_rows"),
            F.sum(_hash32(payload_text(canonical))).alias("_payloads"),
        )
        .select(
            *groups, "rows", _digest(F.col("_rows")).alias("digest"),
            _digest(F.col("_payloads")).alias("payloads"),
        )
    )


# Copies of one row that a task gives out; further copies go to other tasks.
_COPIES = 100_000


def diff_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """Shaped rows that ``a`` has more often than ``b``, with the number of copies missing.

    Copies are added up in each task before the shuffle.
    """
    signed = a.select(*SHAPED_COLUMNS, F.lit(1).alias("_sign")).unionByName(
        b.select(*SHAPED_COLUMNS, F.lit(-1).alias("_sign"))
    )
    return signed.groupBy(*SHAPED_COLUMNS).agg(F.sum("_sign").alias("missing")).filter("missing > 0")


def diff_rows(a: DataFrame, b: DataFrame, limit: int | None = 5) -> DataFrame:
    """Rows of ``a`` missing from ``b``, counting copies, on the shaped columns.

    A limited answer is a sample for the reader; it takes the first rows in column order, so
    that it is the same each time.
    """
    counts = diff_counts(a, b)
    if limit is not None:
        first = counts.orderBy(*SHAPED_COLUMNS).limit(limit)
        copies = F.least("missing", F.lit(limit))
        rows = first.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
        return rows.orderBy(*SHAPED_COLUMNS).limit(limit).select(*SHAPED_COLUMNS)
    last_part = F.floor((F.col("missing") - 1) / _COPIES)
    parts = counts.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), last_part)))
    copies = F.least(F.col("missing") - F.col("_part") * _COPIES, F.lit(_COPIES))
    return (
        parts.repartition(*SHAPED_COLUMNS, "_part")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
        .select(*SHAPED_COLUMNS)
    )


def verify_tables(a: DataFrame, b: DataFrame, canonical: bool = False) -> DataFrame:
    """One row: both checksums, the list of problems, and whether the tables agree.

    Both sides are read in one pass over their union. An empty side is a problem, for two
    empty tables prove nothing.
    """
    columns = [*SHAPED_COLUMNS, "payload"]
    sides = a.select(F.lit("a").alias("side"), *columns).unionByName(
        b.select(F.lit("b").alias("side"), *columns)
    )
    sums = table_checksum(sides, "side", canonical=canonical)

    def of(side: str, column: str, default) -> Column:
        return F.coalesce(F.max(F.when(F.col("side") == side, F.col(column))), F.lit(default))

    row = sums.agg(
        *[
            of(side, column, default).alias(f"{column}_{side}")
            for side in ("a", "b")
            for column, default in (("rows", 0), ("digest", "empty"), ("payloads", "empty"))
        ]
    )
    empty = (F.col("rows_a") == 0) | (F.col("rows_b") == 0)
    problems = F.filter(
        F.array(
            F.when(empty, F.lit("a side is empty")),
            F.when(
                ~empty & (F.col("rows_a") != F.col("rows_b")),
                F.format_string("rows differ: %d and %d", F.col("rows_a"), F.col("rows_b")),
            ),
            F.when(~empty & (F.col("digest_a") != F.col("digest_b")), F.lit("columns differ")),
            F.when(~empty & (F.col("payloads_a") != F.col("payloads_b")), F.lit("payloads differ")),
        ),
        lambda p: p.isNotNull(),
    )
    return row.withColumn("problems", problems).withColumn("passed", F.size("problems") == 0)
