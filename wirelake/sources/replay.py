"""Bounded replay: the same lines, in order, for a number of passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wirelake.operators.scan import BLOCK, ordinal


def replay_expand(lines: DataFrame, order: str, passes: int) -> DataFrame:
    """Repeat every line ``passes`` times; ``emit_idx`` is its place in the whole replay.

    ``order`` is a unique integer. Each row is copied where it is, so no join makes the
    copies, and the number of lines is a one-row subquery. No input or no pass, no output.
    """
    lines_total = lines.agg(F.count("*")).scalar()
    passes_list = F.sequence(F.lit(0), F.lit(max(passes, 1) - 1))
    return (
        ordinal(lines, (), order, name="seq")
        .withColumn("pass", F.explode(passes_list))
        .withColumn("emit_idx", F.col("pass").cast("bigint") * lines_total + F.col("seq"))
        .filter(F.lit(passes > 0))
        .drop(BLOCK)
    )
