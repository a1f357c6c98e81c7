from pyspark.sql import functions as F

from wirelake.__main__ import main
from wirelake.operators import storage
from wirelake.operators.counters import REQUIRED_METRICS
from wirelake.session import run_folder
from tests.conftest import seconds
from tests.test_reconcile import A, B, packets
from tests.test_shape import doc


def table(spark, *rows):
    path = run_folder(spark, "t")
    storage.append_packets(packets(spark, *rows), path)
    return path


def test_ingest_and_questions(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(doc() + "\n" + doc() + "\nx\n")
    out = str(tmp_path / "out")
    assert main(["ingest", "--lines", str(tmp_path / "in"), "--out", out, "--once"], spark) == 0
    for command in ("count", "latest", "talkers"):
        assert main([command, "--packets", f"{out}/packets"], spark) == 0
    shown = capsys.readouterr().out
    assert "|2  |" in shown and "172.20.5.9" in shown


def test_verify(spark, capsys):
    a, b = table(spark, A, B), table(spark, A)
    assert main(["verify", "-a", a, "-b", a], spark) == 0
    assert main(["verify", "-a", a, "-b", b], spark) == 1
    shown = capsys.readouterr().out
    assert "tables agree: 2 rows" in shown and "rows differ: 2 and 1" in shown and "10.0.0.3" in shown


def _lines(spark, tmp_path, name, rows):
    path = str(tmp_path / name)
    df = seconds(spark, rows, "scrape_ts DOUBLE, line STRING", "scrape_ts")
    df.write.parquet(path)
    return path


def test_soak_and_metrics(spark, tmp_path, capsys):
    good = _lines(spark, tmp_path, "good", [(float(t), f"{n} {t}") for t in (0, 5) for n in REQUIRED_METRICS if "dead" not in n and "buffer" not in n]
                  + [(float(t), f"{n} 0") for t in (0, 5) for n in REQUIRED_METRICS if "dead" in n or "buffer" in n])
    assert main(["soak", "--samples", good], spark) == 0
    assert main(["metrics", "--samples", good], spark) == 0
    shown = capsys.readouterr().out
    assert shown.startswith("passed after 2 scrapes in 5 seconds") and "metric contract satisfied" in shown
    assert main(["soak", "--samples", good, "--duration", "1800"], spark) == 1
    assert "broken: run_too_short" in capsys.readouterr().out
    bad = _lines(spark, tmp_path, "bad", [(0.0, "worker_buffer_size 1")])
    assert main(["soak", "--samples", bad], spark) == 1
    assert main(["metrics", "--samples", bad], spark) == 1
    shown = capsys.readouterr().out
    assert "broken: no_new_rows" in shown and "never seen: process_memory_bytes" in shown and "MISSING process_memory_bytes" in shown
    empty = _lines(spark, tmp_path, "empty", [(0.0, "# nothing")])
    assert main(["soak", "--samples", empty], spark) == 1
    assert main(["metrics", "--samples", empty], spark) == 1


def test_drain(spark, tmp_path):
    rows = spark.range(30).select(F.timestamp_seconds("id").alias("ts"), F.least("id", F.lit(5)).alias("n"))
    rows.write.parquet(str(tmp_path / "n"))
    assert main(["drain", "--counts", str(tmp_path / "n")], spark) == 0
    assert main(["drain", "--counts", str(tmp_path / "n"), "--stable", "100"], spark) == 1
    rows.withColumn("n", F.lit(0).cast("bigint")).write.parquet(str(tmp_path / "z"))
    assert main(["drain", "--counts", str(tmp_path / "z")], spark) == 1
    rows.limit(0).write.parquet(str(tmp_path / "e"))
    assert main(["drain", "--counts", str(tmp_path / "e")], spark) == 1
