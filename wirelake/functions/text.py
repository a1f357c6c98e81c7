"""Text helpers: trimming, strict integers, protocol paths, size labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that count as white space around a line.
WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# \z and not $: $ would accept a trailing line feed.
_INTEGER = r"^[+-]?[0-9]+\z"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def strict_bigint_sql(text: str) -> str:
    """SQL for base-10 int64 text with an optional sign; anything else, blanks included, is NULL."""
    return f"CASE WHEN {text} RLIKE r'{_INTEGER}' THEN try_cast({text} AS BIGINT) END"


def proto_parts(proto: Column) -> Column:
    """Protocol path ``eth:ethertype:ip:tcp`` as an array of names; empty text has none."""
    return F.when(proto == "", F.array().cast("array<string>")).otherwise(F.split(proto, ":"))


def leaf_protocol(proto: Column) -> Column:
    return F.substring_index(proto, ":", -1)


def mebibytes(size: Column) -> Column:
    """``14.0 MiB``; ties go to the even digit."""
    return F.format_string("%.1f MiB", F.bround(size / F.lit(1048576.0), 1))


def message_id(*columns: Column) -> Column:
    """SHA-256 over columns joined by ``|`` with ``~`` for NULL."""
    return F.sha2(joined(*columns), 256)


def joined(*columns: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in columns])


def utc_micros_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
