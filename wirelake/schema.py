"""Schemas of the library's tables and of the JSON lines it reads."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the dissector's JSON output. Every leaf is read as text;
# a number becomes its text, so "443" and 443 are the same port.
EK_DDL = (
    "timestamp STRING, layers STRUCT<"
    "frame: STRUCT<frame_frame_protocols: STRING, frame_frame_len: STRING>, "
    "ip: STRUCT<ip_ip_src: STRING, ip_ip_dst: STRING>, "
    "ipv6: STRUCT<ipv6_ipv6_src: STRING, ipv6_ipv6_dst: STRING>, "
    "tcp: STRUCT<tcp_tcp_srcport: STRING, tcp_tcp_dstport: STRING>, "
    "udp: STRUCT<udp_udp_srcport: STRING, udp_udp_dstport: STRING>>"
)

PACKETS = T.StructType(
    [
        T.StructField("ts", T.TimestampType(), False),
        T.StructField("src_ip", T.StringType(), False),
        T.StructField("dst_ip", T.StringType(), False),
        T.StructField("src_port", T.IntegerType(), True),
        T.StructField("dst_port", T.IntegerType(), True),
        T.StructField("proto", T.StringType(), False),
        T.StructField("length", T.IntegerType(), False),
        T.StructField("payload", T.StringType(), False),
    ]
)
PACKET_COLUMNS = PACKETS.fieldNames()

# The columns compared between two packet tables; payload is compared by its own digest.
SHAPED_COLUMNS = [c for c in PACKET_COLUMNS if c != "payload"]

STORED_PACKETS = T.StructType([*PACKETS.fields, T.StructField("chunk", T.TimestampType(), False)])
