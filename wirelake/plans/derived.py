"""Packet lines, metric lines and poll counts made from the given ``events`` table.

The SQL text of the packet line is shared by Spark and the checking engine, so both start from
the same bytes; everything after that is worked out independently on either side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F



def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


# One line per event. Remainders of the id spread the cases of the input format over the
# table; every event gives a line:
#   97 ARP frame without addresses      89 cut-off line           101 address with leading zero
#  103 port that is a word             107 time with a fraction   109 text after the document
#  113 port beyond the column's range  127 layer of a wrong type  131 no frame layer
#  137 empty ip layer beside ipv6      139 null ip beside ipv6    149 empty port
_TIME = """CASE WHEN event_id % 107 = 0 THEN concat(CAST($MS AS STRING), '.0')
      ELSE concat('"', CAST($MS AS STRING), '"') END"""
_FRAME = """CASE WHEN event_id % 131 = 0 THEN '' ELSE concat(
      '"frame":{"frame_frame_protocols":"eth:ethertype:',
      CASE WHEN event_id % 7 = 0 THEN 'ipv6' ELSE 'ip' END, ':',
      CASE WHEN event_id % 11 = 0 THEN 'icmp' WHEN event_id % 3 = 0 THEN 'udp:dns' ELSE 'tcp:http' END,
      '","frame_frame_len":"', CAST(60 + (event_id * 37) % 1441 AS STRING), '"},') END"""
_IPV6 = """concat('"ipv6":{"ipv6_ipv6_src":"2001:DB8:0:0::', CAST(user_id % 10 AS STRING),
      '","ipv6_ipv6_dst":"2001:db8::', CAST(1 + event_id % 5 AS STRING), '"}')"""
_NETWORK = """CASE WHEN event_id % 127 = 0 THEN '"ip":"none"'
      WHEN event_id % 137 = 0 THEN concat('"ip":{},', $IPV6)
      WHEN event_id % 139 = 0 THEN concat('"ip":null,', $IPV6)
      WHEN event_id % 7 = 0 THEN $IPV6
      ELSE concat('"ip":{"ip_ip_src":"', CASE WHEN event_id % 101 = 0 THEN '010' ELSE '10' END,
      '.0.0.', CAST(user_id % 256 AS STRING),
      '","ip_ip_dst":"192.168.1.', CAST(1 + event_id % 20 AS STRING), '"}') END"""
_SRC_PORT = """CASE WHEN event_id % 103 = 0 THEN '"http"' WHEN event_id % 149 = 0 THEN '""'
      ELSE CAST(1024 + user_id % 60000 AS STRING) END"""
_TRANSPORT = """CASE WHEN event_id % 11 = 0 THEN ''
      WHEN event_id % 3 = 0 THEN concat(',"udp":{"udp_udp_srcport":', $SRC_PORT,
      ',"udp_udp_dstport":"53"},"dns":{"dns_dns_qry_name":"', event_type, '.example"}')
      ELSE concat(',"tcp":{"tcp_tcp_srcport":', $SRC_PORT, ',"tcp_tcp_dstport":',
      CASE WHEN event_id % 113 = 0 THEN '4294967296' ELSE '443' END,
      '},"http":{"http_http_host":"www.', event_type, '.example"}') END"""
_LINE = """CASE
    WHEN event_id % 97 = 0 THEN concat('{"timestamp":', $TIME,
      ',"layers":{"frame":{"frame_frame_protocols":"eth:arp","frame_frame_len":"42"}}}')
    WHEN event_id % 89 = 0 THEN concat('{"timestamp":"', CAST($MS AS STRING))
    ELSE concat('{"timestamp":', $TIME, ',"layers":{', $FRAME, $NETWORK, $TRANSPORT, '}}',
      CASE WHEN event_id % 109 = 0 THEN ' x' ELSE '' END) END"""


def line_sql(ms: str) -> str:
    """SQL for an event's packet line; ``ms`` is the engine's text for epoch milliseconds."""
    text = _LINE
    for name, part in (
        ("$NETWORK", _NETWORK), ("$TRANSPORT", _TRANSPORT), ("$FRAME", _FRAME), ("$IPV6", _IPV6),
        ("$SRC_PORT", _SRC_PORT), ("$TIME", _TIME), ("$MS", ms),
    ):
        text = text.replace(name, part)
    return text


SPARK_MS = "unix_millis(CAST(ts AS TIMESTAMP))"

# Index line before each packet line, and blank lines, as the dissector writes them.
INDEX_LINE = '{"index":{"_index":"packets","_type":"doc"}}'


def ek_lines(rows: DataFrame) -> DataFrame:
    """``events`` rows with their packet line in ``value``."""
    return rows.select(
        "event_id", F.col("ts").alias("event_ts"), "user_id", "event_type",
        F.expr(line_sql(SPARK_MS)).alias("value"),
    )


def raw_lines(rows: DataFrame) -> DataFrame:
    """The lines as the dissector prints them: index line, padded packet line, blank line."""
    parts = F.array(
        F.lit(INDEX_LINE), F.concat(F.lit("  "), F.col("value"), F.lit("\t\r")), F.lit(" \t")
    )
    return ek_lines(rows).select("event_id", F.posexplode(parts).alias("line_no", "value"))


# Each event is one scrape of one worker (its event type). The line formats.
# ``signup`` has no buffer gauge; counters restart now and then.
METRIC_LINES_SQL = [
    "'# HELP worker_rows_inserted_total Total rows inserted'",
    "'# TYPE worker_rows_inserted_total counter'",
    "concat('worker_msgs_consumed_total{service=\"', event_type, '\"} ', CAST(event_id % 500 AS STRING))",
    "concat('worker_rows_inserted_total{service=\"', event_type, '\",shard=\"a\"} ', CAST(event_id % 500 AS STRING), '.0')",
    "concat('worker_rows_inserted_total{service=\"', event_type, '\",shard=\"b\"} ', CAST(event_id % 300 AS STRING))",
    "concat('worker_batch_flush_total{service=\"', event_type, '\"} ', CAST(event_id % 7 AS STRING), 'e+01')",
    "concat('worker_deadletter_total{service=\"', event_type, '\"} ', CASE WHEN event_type = 'error' THEN CAST(event_id % 5 AS STRING) ELSE '0.0' END)",
    "concat('worker_db_errors_total{service=\"', event_type, '\"} 0')",
    "CASE WHEN event_type = 'signup' THEN '' ELSE concat('worker_buffer_size{service=\"', event_type, '\"} ', CAST(event_id % 50 * 1000 AS STRING)) END",
    "concat('process_memory_bytes{service=\"', event_type, '\"} ', CAST(10 + user_id % 15 AS STRING), 'e+06')",
    "'no_value'",
    "concat('bad_value{service=\"', event_type, '\"} 1x')",
    "'too_large 1e999'",
    "concat('repeated{service=\"x\",service=\"', event_type, '\"} 3')",
]


def metric_lines(rows: DataFrame) -> DataFrame:
    """``service, scrape_ts, line``: lines of exposition text, as many for each event."""
    lines = F.array(*[F.expr(sql) for sql in METRIC_LINES_SQL])
    return rows.select(
        F.col("event_type").alias("service"),
        F.col("ts").cast("timestamp").alias("scrape_ts"),
        F.explode(lines).alias("line"),
    )


# Row counts of one table per event type, polled at each event: one stays empty, one settles,
# one grows in steps, two grow all the time.
COUNT_SQL = (
    "CASE event_type WHEN 'signup' THEN 0 WHEN 'click' THEN least(event_id, 50) "
    "WHEN 'view' THEN event_id - event_id % 400 ELSE event_id END"
)


def poll_counts(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("event_type").alias("table_name"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.expr(COUNT_SQL).cast("bigint").alias("n"),
    )


def arrivals(rows: DataFrame) -> DataFrame:
    """Rows arriving per event type, ``event_id`` in order of arrival."""
    return rows.select(
        F.col("event_type").alias("key"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("arrival"),
    )
