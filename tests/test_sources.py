import random
import re

from wirelake.plans.queries import queries
from wirelake.sources.ek import clean_lines, ek_scan, ek_stream
from wirelake.sources.exposition import metrics_parse
from wirelake.sources.replay import replay_expand

TEXT = '{"index":{"_index":"p"}}\n  {"timestamp":"1"}\t\r\n\n \t \n{"index":{}}\n{"timestamp":"2"}\n'


def test_scan_drops_blank_and_index_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(TEXT)
    assert sorted(r[0] for r in ek_scan(spark, str(tmp_path)).collect()) == [
        '{"timestamp":"1"}', '{"timestamp":"2"}',
    ]


def test_scan_strips_all_white_space(spark):
    lines = spark.createDataFrame([("\x1c \xa0 x y \x85\x0b",), ("　",)], "value STRING")
    assert [r[0] for r in clean_lines(lines).collect()] == ["x y"]


def test_stream_reads_what_scan_reads(spark, tmp_path):
    source, sink = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for i in range(3):
        (source / f"{i}.json").write_text(TEXT.replace('"1"', f'"{i}1"'))
    stream = ek_stream(spark, str(source), max_files_per_trigger=1)
    stream.writeStream.format("text").option("path", str(sink)).option(
        "checkpointLocation", str(tmp_path / "cp")
    ).trigger(availableNow=True).start().awaitTermination()
    got = sorted(r[0] for r in spark.read.text(str(sink)).collect())
    assert got == sorted(r[0] for r in ek_scan(spark, str(source)).collect())
    assert len(got) == 6


def test_replay(spark):
    lines = spark.createDataFrame([(7, "a"), (9, "b"), (70000, "c")], "id BIGINT, value STRING")
    out = replay_expand(lines, "id", 3).orderBy("emit_idx").collect()
    assert [r.value for r in out] == list("abcabcabc")
    assert [r.emit_idx for r in out] == list(range(9))
    assert [r.value for r in replay_expand(lines, "id", 1).orderBy("emit_idx").collect()] == list("abc")
    assert replay_expand(lines, "id", 0).count() == 0
    assert replay_expand(lines.limit(0), "id", 5).count() == 0


EXPOSITION = """# HELP worker_msgs_consumed_total What the worker took in
# TYPE worker_msgs_consumed_total counter
worker_msgs_consumed_total{service="w"} 77.25
process_memory_bytes{service="w"} 9.5e+06
plain 3
odd{a="x y",b="q\\"{}=,",c=""} +Inf
not_a_number NaN
{only="labels"} 1
  spaced{x="1"}   5

nospace
bad 1x
bad 1d
bad 0x10f
bad 1_000
huge 1e999
small -1e999
twice{a="1",b="2",a="3"} 3
"""


def test_exposition(spark):
    lines = spark.createDataFrame([(line,) for line in EXPOSITION.split("\n")], "line STRING")
    rows = {r["series"]: r for r in metrics_parse(lines).collect()}
    assert len(rows) == 8
    assert rows['worker_msgs_consumed_total{service="w"}'].value == 77.25
    assert rows['process_memory_bytes{service="w"}'].value == 9500000.0
    assert rows['process_memory_bytes{service="w"}'].name == "process_memory_bytes"
    assert rows["plain"].name == "plain" and rows["plain"].labels == {}
    odd = [r for r in rows.values() if r.name == "odd"][0]
    assert odd.labels == {"a": "x y", "b": 'q\\"{}=,', "c": ""} and odd.value == float("inf")
    assert rows["not_a_number"].value != rows["not_a_number"].value
    assert rows['twice{a="1",b="2",a="3"}'].labels == {"a": "3", "b": "2"}
    assert rows['spaced{x="1"}  '].value == 5.0


def test_random_label_sets(spark):
    rng, pattern = random.Random(4), re.compile(r'([A-Za-z_][A-Za-z0-9_]*)="([^"\\]*(?:\\.[^"\\]*)*)"')
    pieces = ["a", "b", "le", "=", '"', '="', '",', ",", "{", "}", " ", "\\", '\\"', "é", "1", '="x"', '=""', "_9"]
    made = {"".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(3000)}
    made |= {f'm{{{",".join(f"{k}=" + chr(34) + str(i) + chr(34) for i, k in enumerate(rng.choices("abcd", k=6)))}}}' for _ in range(300)}
    space = ["", " ", "\t", "\xa0", "　\r"]
    lines = [(s, rng.choice(space) + s + " 1.5" + rng.choice(space)) for s in made if s == s.strip() and not s.startswith("#")]
    got = {r["made"]: r for r in metrics_parse(spark.createDataFrame(lines, "made STRING, line STRING")).collect()}
    assert len(got) == len(lines)
    for series, row in got.items():
        found = pattern.findall(series[series.index("{") :]) if "{" in series else []
        name = series if series.startswith("{") else series.split("{")[0]
        assert (row["series"], row["name"], row["labels"], row["value"]) == (series, name, dict(found), 1.5)


def test_a_line_is_stripped_once(spark):
    lines = spark.createDataFrame([(line,) for line in EXPOSITION.split("\n")], "line STRING")
    for names in ((), ("plain", "odd")):
        plan = metrics_parse(lines, names=names)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("trim(") == 1


def test_events_are_dealt_out_before_they_become_lines(spark, sf_dir):
    plan = queries()["metrics_parse"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("RebalancePartitions") < plan.index("parquet")
