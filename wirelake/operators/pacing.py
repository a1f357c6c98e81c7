"""Emission schedules and batches by count, in arrival order."""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

from pyspark.sql import DataFrame, functions as F

from wirelake.operators.scan import BLOCK, ordinal, running


def pace_schedule(
    rows: DataFrame,
    keys: tuple[str, ...],
    order: str,
    rate: float | Fraction,
    *,
    arrival: str = "arrival",
) -> DataFrame:
    """Add ``emit_at``: at most ``rate`` rows per second and key, in order.

    A row leaves at its arrival or one interval after the row before it, whichever is later;
    after a pause nothing is caught up. ``e(i) = max(a(i), e(i-1) + d)`` unrolls to
    ``max over j <= i of (a(j) - j d) + i d``, a running maximum. The interval is the exact
    fraction of the rate; only the time given is rounded up to whole microseconds. A rate of zero
    or less lets everything pass at once.
    """
    if rate <= 0:
        return rows.withColumn("emit_at", F.col(arrival))
    exact = rate if isinstance(rate, Fraction) else Fraction(str(rate))
    # In parts of a microsecond, of which the interval and a microsecond are whole numbers.
    gap, unit = (F.lit(Decimal(n)) for n in (exact.denominator * 1_000_000, exact.numerator))
    number = F.col("_i").cast("decimal(19,0)")
    numbered = ordinal(rows, keys, order, "_i")
    slack = F.unix_micros(arrival).cast("decimal(19,0)") * unit - number * gap
    due = running(numbered, keys, order, slack, "max", "_slack").withColumn("_due", F.col("_slack") + number * gap)
    rounded = F.expr(f"(_due + {exact.numerator - 1}BD) div {exact.numerator}BD")
    return due.withColumn("emit_at", F.timestamp_micros(rounded)).drop("_i", "_slack", "_due", BLOCK)


def batch_by_count(
    rows: DataFrame, keys: tuple[str, ...], order: str, size: int = 500
) -> DataFrame:
    """Add ``batch_no``: every ``size`` rows of a key, in order, form a batch."""
    return (
        ordinal(rows, keys, order, "_i")
        .withColumn("batch_no", F.floor(F.col("_i") / F.lit(size)).cast("bigint"))
        .drop("_i", BLOCK)
    )
