"""One-row results as text for a reader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wirelake.functions.text import mebibytes


def soak_report(gate: DataFrame, *run: str) -> DataFrame:
    """The rows of a soak gate as ``report``: a verdict, then a table of measure, start, most and end."""

    def line(measure: str, *cells: Column) -> Column:
        return F.concat_ws(" | ", F.rpad(F.lit(measure), 9, " "), *[F.lpad(c, 12, " ") for c in cells])

    def number(name: str) -> Column:
        return F.format_string("%.0f", F.col(name))

    blank = F.lit("")
    verdict = F.when(F.col("passed"), F.lit("passed")).otherwise(F.lit("not passed"))
    text = F.concat_ws(
        "\n",
        F.concat(verdict, F.format_string(" after %d scrapes in %.0f seconds", "samples", "elapsed_s")),
        line("measure", F.lit("start"), F.lit("most"), F.lit("end")),
        line("memory", mebibytes(F.col("first_rss")), mebibytes(F.col("peak_rss")), mebibytes(F.col("final_rss"))),
        line("buffer", blank, number("peak_buffer"), number("final_buffer")),
        line("rejected", blank, blank, number("dead_letters")),
        line("errors", blank, blank, number("db_errors")),
        line("messages", blank, blank, number("msgs_consumed")),
        line("new rows", blank, blank, number("rows_inserted")),
        line("per second", blank, blank, F.coalesce(F.format_string("%.1f", "throughput"), F.lit("-"))),
        F.transform("failures", lambda code: F.concat(F.lit("broken: "), code)),
        F.transform("missing", lambda name: F.concat(F.lit("never seen: "), name)),
    )
    return gate.select(*run, "passed", text.alias("report"))
