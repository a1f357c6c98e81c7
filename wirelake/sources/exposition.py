"""Metrics in the text exposition format, one line per sample."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from wirelake.functions.text import strip

# The numbers a sample may have, and labels as name="text".
_NUMBER = r"^(?:[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|(?i:inf|infinity))|(?i:nan))\z"
_LABEL = r'([A-Za-z_][A-Za-z0-9_]*)="([^"\\]*(?:\\.[^"\\]*)*)"'


def metrics_parse(lines: DataFrame, column: str = "line", names: tuple[str, ...] = ()) -> DataFrame:
    """``line`` -> ``series, name, labels, value``; other columns pass through.

    With ``names``, only these metrics; other lines are left out by their first letters, before
    they are taken apart.

    The value is the last word, the series all before it. Comments, blank lines, lines of one
    word and lines whose last word is no number, or one beyond a double, are dropped. The stripped line and its
    two parts pass through ``explode(array(..))``, so that filters on them do not strip or split it again.
    """
    text = F.col("_text")
    number = F.substring_index(text, " ", -1)
    parts = F.struct(
        F.left(text, F.length(text) - F.length(number) - 1).alias("series"), number.alias("number")
    )
    words = lines.filter(F.col(column).contains(" "))  # a line of one word is not worth stripping
    stripped = words.withColumn("_text", F.explode(F.array(strip(F.col(column)))))
    if names:
        stripped = stripped.filter(reduce(or_, [text.startswith(name) for name in names]))
    samples = (
        stripped.filter(~text.startswith("#") & text.contains(" "))
        .withColumn("_parts", F.explode(F.array(parts)))
        .filter(F.col("_parts.number").rlike(_NUMBER))
        .withColumn("value", F.col("_parts.number").try_cast("double"))
        .filter((F.abs("value") < float("inf")) | F.col("_parts.number").rlike("(?i)inf|nan"))
        .withColumn("series", F.col("_parts.series"))
        .drop(column, "_text", "_parts")
        .withColumn("name", metric_name(F.col("series")))
        .withColumns(dict(zip(("_label_names", "_label_values"), _label_parts(F.col("series")))))
        .withColumn("labels", _label_map(F.col("_label_names"), F.col("_label_values")))
        .drop("_label_names", "_label_values")
    )
    return samples.filter(F.col("name").isin(*names)) if names else samples


def _label_parts(series: Column) -> tuple[Column, Column]:
    """Label names and values, as written between their quotes; null without a label set."""
    # From the brace on: within a long name the pattern would start anew at every letter.
    text = F.substring(series, F.instr(series, "{"), F.length(series))
    names, values = (F.regexp_extract_all(text, F.lit(_LABEL), F.lit(group)) for group in (1, 2))
    return F.when(series.contains("{"), names), F.when(series.contains("{"), values)


def _label_map(names: Column, values: Column) -> Column:
    """The labels as a map; of a repeated name the last counts."""

    def last(_: Column, i: Column) -> Column:
        return ~F.array_contains(F.slice(names, i + 2, F.size(names)), F.element_at(names, i + 1))

    # Repeated names are rare; only they are worth comparing each name with all others.
    repeats = F.size(F.array_distinct(names)) < F.size(names)
    return (
        F.when(names.isNull(), F.create_map().cast("map<string,string>"))
        .when(repeats, F.map_from_arrays(F.filter(names, last), F.filter(values, last)))
        .otherwise(F.map_from_arrays(names, values))
    )


def metric_name(series):
    """The text before the label set; a series that starts with its labels has no other name."""
    return F.when(series.startswith("{"), series).otherwise(F.substring_index(series, "{", 1))
