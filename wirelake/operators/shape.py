"""Turn one JSON line into a typed packet row, or into an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wirelake.functions.ip import ip_canonical_sql
from wirelake.functions.text import strict_bigint_sql
from wirelake.schema import EK_DDL, PACKET_COLUMNS

_STRICT = "'allowSingleQuotes', 'false', 'allowNonNumericNumbers', 'false'"

# The epoch milliseconds a timestamp column can hold, and the int32 range.
MIN_MS, MAX_MS = -210866803200000, 9223372036854775
MIN_INT, MAX_INT = -(2**31), 2**31 - 1


def shape_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Add the eight packet columns, ``reason`` (an error class) and ``error`` (its text).

    Rows without an error have both NULL. Each line is parsed once with the wanted fields and
    once more, cheaply, to see whether text follows the document. Parse results and verdict pass
    through generators (``explode``, ``inline``): a later filter on ``reason`` would otherwise be
    pushed below the projection and repeat the parse for every field it mentions.
    """
    taken = {*PACKET_COLUMNS, "reason", "error"} & set(lines.columns)
    if taken:
        raise ValueError(f"rename these columns first: {sorted(taken)}")
    parsed = _parse(lines, f"`{column}`")
    texts = parsed.selectExpr("*", *_TEXTS)
    numbers = texts.selectExpr("*", *_NUMBERS)
    typed = numbers.selectExpr("*", *_TYPED, f"`{column}` AS payload")
    kept = [f"`{c}`" for c in lines.columns]
    return typed.selectExpr(*kept, *PACKET_COLUMNS, f"inline(array({_verdict()})) AS (reason, error)")


def _parse(lines: DataFrame, line: str) -> DataFrame:
    # The parser ignores what follows a complete document, so the line is parsed again inside
    # an array before an element that holds the line's own hash: text after the document
    # breaks the array, ends it early or adds elements.
    marked = lines.selectExpr("*", f"hex(xxhash64({line})) AS _mark")
    corrupt = "'mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '_corrupt'"
    parsed = marked.selectExpr(
        "*",
        f"from_json({line}, '{EK_DDL}, _corrupt STRING', map({_STRICT}, {corrupt})) AS _ek",
        f"""from_json(concat('[', {line}, ',{{"timestamp":"', _mark, '"}}]'),
          'array<struct<timestamp: string>>', map({_STRICT})) AS _pair""",
    )
    # A line that is just `null` is a document without any field.
    valid = f"""coalesce(size(_pair) = 2 AND element_at(_pair, -1).timestamp = _mark, false)
      AND (_ek._corrupt IS NULL OR {line} = 'null')"""
    return parsed.selectExpr("*", f"explode(array(struct(_ek AS ek, {valid} AS valid))) AS _p")


# A layer that is present wins even if its fields are empty.
def _address(end: str) -> str:
    return f"""CASE WHEN _p.ek.layers.ip IS NOT NULL THEN _p.ek.layers.ip.ip_ip_{end}
      ELSE _p.ek.layers.ipv6.ipv6_ipv6_{end} END"""


def _port(end: str) -> str:
    return f"""CASE WHEN _p.ek.layers.tcp IS NOT NULL THEN _p.ek.layers.tcp.tcp_tcp_{end}port
      ELSE _p.ek.layers.udp.udp_udp_{end}port END"""


_TEXTS = [
    f"coalesce({value}, '') AS {name}"
    for name, value in (
        ("_time_text", "_p.ek.timestamp"),
        ("_src_text", _address("src")),
        ("_dst_text", _address("dst")),
        ("_sport_text", _port("src")),
        ("_dport_text", _port("dst")),
        ("_len_text", "_p.ek.layers.frame.frame_frame_len"),
        ("proto", "_p.ek.layers.frame.frame_frame_protocols"),
    )
]
_NUMBERS = [
    f"{strict_bigint_sql('_time_text')} AS _ms",
    f"{ip_canonical_sql('_src_text')} AS src_ip",
    f"{ip_canonical_sql('_dst_text')} AS dst_ip",
    f"{strict_bigint_sql('_sport_text')} AS _sport",
    f"{strict_bigint_sql('_dport_text')} AS _dport",
    f"CASE WHEN _len_text = '' THEN 0L ELSE {strict_bigint_sql('_len_text')} END AS _len",
]
_TYPED = [
    f"CASE WHEN _ms BETWEEN {MIN_MS} AND {MAX_MS} THEN timestamp_millis(_ms) END AS ts",
    "try_cast(_sport AS INT) AS src_port",
    "try_cast(_dport AS INT) AS dst_port",
    "try_cast(_len AS INT) AS length",
]


def _quoted(prefix: str, text: str, *fields: str) -> str:
    """Error text with the value as it stands in the line; parsing turns 12.50 into 12.5."""
    if not fields:
        return f"""concat('{prefix} "', {text}, '"')"""
    pattern = f'"(?:{"|".join(fields)})"\\s*:\\s*(-?[0-9][0-9.eE+-]*)'
    written = f"regexp_extract(payload, r'{pattern}', 1)"
    same = f"try_cast({written} AS DOUBLE) = try_cast({text} AS DOUBLE)"
    return f"""concat('{prefix} "', CASE WHEN {same} THEN {written} ELSE {text} END, '"')"""


def _verdict() -> str:
    """The first check that fails, as a struct of class and text; NULL if none does."""
    # The error texts, which stored dead letters have to equal.
    checks = [
        ("NOT _p.valid", "malformed_json", "'unmarshal ek'"),
        ("_ms IS NULL", "bad_timestamp", _quoted("parse timestamp", "_time_text", "timestamp")),
        (
            "_src_text = '' OR _dst_text = ''",
            "missing_ip",
            "concat('missing IP addresses: src=', _src_text, ', dst=', _dst_text)",
        ),
        ("src_ip IS NULL", "invalid_src_ip", _quoted("invalid src IP", "_src_text")),
        ("dst_ip IS NULL", "invalid_dst_ip", _quoted("invalid dst IP", "_dst_text")),
        (
            "_sport_text <> '' AND _sport IS NULL",
            "invalid_port",
            _quoted("invalid port", "_sport_text", "tcp_tcp_srcport", "udp_udp_srcport"),
        ),
        (
            "_dport_text <> '' AND _dport IS NULL",
            "invalid_port",
            _quoted("invalid port", "_dport_text", "tcp_tcp_dstport", "udp_udp_dstport"),
        ),
        ("_len IS NULL", "invalid_length", _quoted("invalid frame_frame_len", "_len_text", "frame_frame_len")),
        (
            f"_ms NOT BETWEEN {MIN_MS} AND {MAX_MS} "
            + " ".join(f"OR {c} NOT BETWEEN {MIN_INT} AND {MAX_INT}" for c in ("_sport", "_dport", "_len")),
            "out_of_range",
            "'value does not fit its column'",
        ),
    ]
    cases = " ".join(
        f"WHEN {condition} THEN struct('{reason}' AS reason, {error} AS error)"
        for condition, reason, error in checks
    )
    return f"CASE {cases} END"


def good_packets(shaped: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return shaped.filter(F.col("reason").isNull()).select(*keep, *PACKET_COLUMNS)


def dead_letters(shaped: DataFrame, now, line: str = "payload") -> DataFrame:
    """Bad lines as ``error, raw_ek_line, ts``; ``now`` is a timestamp column or literal."""
    return shaped.filter(F.col("reason").isNotNull()).select(
        "error", F.col(line).alias("raw_ek_line"), F.unix_timestamp(now).alias("ts")
    )


def dead_letter_json(letters: DataFrame) -> DataFrame:
    """The message form of a dead letter, keys in alphabetical order."""
    return letters.select(F.to_json(F.struct("error", "raw_ek_line", "ts")).alias("value"))


def shape_packets(lines: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    return good_packets(shape_lines(lines, column), keep)


def ingest_counters(shaped: DataFrame, batch: Column) -> DataFrame:
    """Per batch: lines consumed, rows inserted, dead letters and flushes (0 if nothing to write)."""
    good = F.col("reason").isNull()
    return shaped.groupBy(batch.alias("batch")).agg(
        F.count_if(good).alias("consumed"),
        F.count_if(good).alias("inserted"),
        F.count_if(~good).alias("dead_letters"),
        F.max(F.when(good, 1).otherwise(0)).alias("flushes"),
    )
