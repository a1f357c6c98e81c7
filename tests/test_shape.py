"""One line in, one packet or one error out."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from wirelake.operators.shape import (
    dead_letter_json, dead_letters, good_packets, ingest_counters, shape_lines, shape_packets,
)

BASE = {
    "timestamp": "1755123456321",
    "layers": {
        "frame": {"frame_frame_protocols": "eth:ethertype:ip:tcp:tls", "frame_frame_len": "902"},
        "ip": {"ip_ip_src": "172.20.5.9", "ip_ip_dst": "172.20.7.31"},
        "tcp": {"tcp_tcp_srcport": "8443", "tcp_tcp_dstport": "40112"},
    },
}


def doc(**layers):
    """The base document with layers replaced; a layer given as ``...`` is taken out."""
    d = copy.deepcopy(BASE)
    top = layers.pop("timestamp", None)
    if top is ...:
        del d["timestamp"]
    elif top is not None:
        d["timestamp"] = top
    for name, value in layers.items():
        if value is ...:
            d["layers"].pop(name, None)
        else:
            d["layers"][name] = value
    return json.dumps(d)


def ports(src, dst=1):
    return {"tcp_tcp_srcport": src, "tcp_tcp_dstport": dst}


def ip(src, dst="10.0.0.1"):
    return {"ip_ip_src": src, "ip_ip_dst": dst}


V6 = {"ipv6_ipv6_src": "2001:db8::1", "ipv6_ipv6_dst": "2001:db8::2"}

GOOD = {
    "basic": (doc(), ("172.20.5.9", "172.20.7.31", 8443, 40112, "eth:ethertype:ip:tcp:tls", 902)),
    "udp": (doc(tcp=..., udp={"udp_udp_srcport": "53", "udp_udp_dstport": "5353"}), (None, None, 53, 5353, None, None)),
    "ipv6": (doc(ip=..., ipv6=V6), ("2001:db8::1", "2001:db8::2", None, None, None, None)),
    "icmp": (doc(tcp=...), ("172.20.5.9", None, "null", "null", None, None)),
    "numbers": (
        doc(timestamp=1755123456321, frame={"frame_frame_len": 902}, tcp=ports(443, 80)),
        (None, None, 443, 80, "", 902),
    ),
    "null ip layer": (doc(ip=None, ipv6=V6), ("2001:db8::1", "2001:db8::2", None, None, None, None)),
    "no frame": (doc(frame=...), (None, None, None, None, "", 0)),
    "null frame": (doc(frame=None), (None, None, None, None, "", 0)),
    "empty port": (doc(tcp=ports("")), (None, None, "null", 1, None, None)),
    "null port": (doc(tcp=ports(None)), (None, None, "null", 1, None, None)),
    "signed port": (doc(tcp=ports("+443", "-1")), (None, None, 443, -1, None, None)),
    "leading zero": (doc(tcp=ports("0443")), (None, None, 443, 1, None, None)),
    "tcp over udp": (doc(udp={"udp_udp_srcport": "53"}), (None, None, 8443, 40112, None, None)),
    "empty tcp over udp": (
        doc(tcp={}, udp={"udp_udp_srcport": "53"}), (None, None, "null", "null", None, None)
    ),
    "short ipv6": (
        doc(ip=..., ipv6={**V6, "ipv6_ipv6_src": "2001:DB8:0:0::1"}),
        ("2001:db8::1", None, None, None, None, None),
    ),
    "unknown layers": (doc(http={"a": [1, {"b": 2}]}), (None, None, 8443, None, None, None)),
    "int32 bounds": (doc(tcp=ports("2147483647", "-2147483648")), (None, None, 2147483647, -2147483648, None, None)),
    "protocol of other kind": (
        doc(frame={"frame_frame_protocols": 7, "frame_frame_len": ""}), (None, None, None, None, "7", 0)
    ),
}

BAD = {
    "cut off": ('{"timestamp":"1"', "malformed_json", "unmarshal ek"),
    "text after": (doc() + " x", "malformed_json", None),
    "two documents": (doc() + doc(), "malformed_json", None),
    "two documents, comma": (doc() + "," + doc(), "malformed_json", None),
    "array closed early": (doc() + "] x", "malformed_json", None),
    "array opened again": (doc() + "],[" + doc(), "malformed_json", None),
    "comment after": (doc() + "//x", "malformed_json", None),
    "array": ("[" + doc() + "]", "malformed_json", None),
    "number": ("5", "malformed_json", None),
    "text": ('"x"', "malformed_json", None),
    "single quotes": ("{'timestamp':1}", "malformed_json", None),
    "blank": ("", "malformed_json", None),
    "nan": ('{"timestamp":NaN}', "malformed_json", None),
    "layer as text": (doc(ip="x"), "malformed_json", None),
    "layer as array": (doc(tcp=[1]), "malformed_json", None),
    "layers as text": ('{"timestamp":"1","layers":"x"}', "malformed_json", None),
    "null": ("null", "bad_timestamp", 'parse timestamp ""'),
    "no timestamp": (doc(timestamp=...), "bad_timestamp", 'parse timestamp ""'),
    "empty timestamp": (doc(timestamp=""), "bad_timestamp", 'parse timestamp ""'),
    "fraction": (doc(timestamp="1755123456321.0"), "bad_timestamp", 'parse timestamp "1755123456321.0"'),
    "fraction as number": (doc(timestamp=1755123456321.0), "bad_timestamp", 'parse timestamp "1755123456321.0"'),
    "padded": (doc(timestamp=" 1"), "bad_timestamp", 'parse timestamp " 1"'),
    "beyond int64": (doc(timestamp="9223372036854775808"), "bad_timestamp", None),
    "no ip": (doc(ip=...), "missing_ip", "missing IP addresses: src=, dst="),
    "empty ip beside ipv6": (doc(ip={}, ipv6=V6), "missing_ip", None),
    "one address": (doc(ip={"ip_ip_src": "1.2.3.4"}), "missing_ip", "missing IP addresses: src=1.2.3.4, dst="),
    "no layers": ('{"timestamp":"1"}', "missing_ip", None),
    "bad source": (doc(ip=ip("invalid")), "invalid_src_ip", 'invalid src IP "invalid"'),
    "bad destination": (doc(ip=ip("1.2.3.4", "1.2.3")), "invalid_dst_ip", 'invalid dst IP "1.2.3"'),
    "address list": (doc(ip=ip(["1.2.3.4", "1.2.3.5"])), "invalid_src_ip", None),
    "leading zero": (doc(ip=ip("01.2.3.4")), "invalid_src_ip", None),
    "zone": (doc(ip=..., ipv6={**V6, "ipv6_ipv6_src": "fe80::1%eth0"}), "invalid_src_ip", None),
    "word port": (doc(tcp=ports("http")), "invalid_port", 'invalid port "http"'),
    "padded port": (doc(tcp=ports(" 443 ")), "invalid_port", None),
    "fraction port": (doc(tcp=ports(443.50)), "invalid_port", 'invalid port "443.5"'),
    "line feed port": (doc(tcp=ports("443\n")), "invalid_port", None),
    "second port": (doc(tcp=ports(1, "x")), "invalid_port", 'invalid port "x"'),
    "word length": (doc(frame={"frame_frame_len": "x"}), "invalid_length", 'invalid frame_frame_len "x"'),
    "big port": (doc(tcp=ports("2147483648")), "out_of_range", None),
    "big length": (doc(frame={"frame_frame_len": 4294967296}), "out_of_range", None),
    "far future": (doc(timestamp="9223372036854775807"), "out_of_range", None),
}


@pytest.fixture(scope="module")
def shaped(spark):
    rows = [(f"good {k}", v[0]) for k, v in GOOD.items()] + [(f"bad {k}", v[0]) for k, v in BAD.items()]
    df = shape_lines(spark.createDataFrame(rows, "name STRING, value STRING"))
    return {r["name"]: r for r in df.collect()}


@pytest.mark.parametrize("case", GOOD)
def test_good_line(shaped, case):
    row = shaped[f"good {case}"]
    assert row["reason"] is None and row["error"] is None
    assert row["payload"] == GOOD[case][0]
    names = ("src_ip", "dst_ip", "src_port", "dst_port", "proto", "length")
    for name, wanted in zip(names, GOOD[case][1]):
        if wanted is not None:
            assert row[name] == (None if wanted == "null" else wanted), name


@pytest.mark.parametrize("case", BAD)
def test_bad_line(shaped, case):
    line, reason, error = BAD[case]
    row = shaped[f"bad {case}"]
    assert row["reason"] == reason
    assert row["payload"] == line
    if error is not None:
        assert row["error"] == error


def test_times(spark):
    lines = [(doc(),), (doc(timestamp="0"),), (doc(timestamp="-1"),)]
    rows = shape_packets(spark.createDataFrame(lines, "value STRING")).select(F.unix_millis("ts")).collect()
    assert sorted(r[0] for r in rows) == [-1, 0, 1755123456321]


def test_one_bad_line_does_not_stop_the_rest(spark):
    lines = spark.createDataFrame([(doc(),), ("{",), (doc(),)], "value STRING")
    shaped = shape_lines(lines)
    assert good_packets(shaped).count() == 2
    letters = dead_letters(shaped, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert [tuple(r) for r in letters.collect()] == [("unmarshal ek", "{", 1704067200)]
    message = dead_letter_json(letters).first()[0]
    assert message == '{"error":"unmarshal ek","raw_ek_line":"{","ts":1704067200}'
    counted = ingest_counters(shaped, F.lit(0)).first()
    assert (counted.consumed, counted.inserted, counted.dead_letters, counted.flushes) == (2, 2, 1, 1)


def test_lines_are_parsed_once(spark):
    """A filter on the result must not bring the parse back into the plan."""
    lines = spark.createDataFrame([(doc(),)], "value STRING")
    plan = good_packets(shape_lines(lines))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(timestamp") == 1
    assert plan.count("from_json(ArrayType") == 1
    assert "Python" not in plan
