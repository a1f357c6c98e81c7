"""Command line: ingest lines, ask for traffic, compare tables, judge metrics.

    python -m wirelake ingest --lines DIR --out DIR [--once]
    python -m wirelake count|latest|talkers --packets DIR
    python -m wirelake verify -a DIR -b DIR [--diff N]
    python -m wirelake soak|metrics --samples FILES
    python -m wirelake drain --counts FILES [--stable SECONDS]

``--samples`` are Parquet files of ``scrape_ts, line``; ``--counts`` of ``ts, n``. Checks end
with exit code 1 if they fail, also on empty input.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from wirelake.operators import counters, reconcile, traffic
from wirelake.reports import soak_report
from wirelake.session import build_session
from wirelake.sources.ek import ek_stream
from wirelake.sources.exposition import metrics_parse
from wirelake.sources.tables import packets_path
from wirelake.streaming.ingest import ingest_stream


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(arguments)
    return args.run(spark or build_session(), args)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="wirelake")
    commands = parser.add_subparsers(required=True)

    def command(name, run, *options):
        sub = commands.add_parser(name)
        for flags, settings in options:
            sub.add_argument(*flags, **settings)
        sub.set_defaults(run=run)

    must = {"required": True}
    packets = (("--packets",), must)
    samples = (("--samples",), must)
    command(
        "ingest", _ingest, (("--lines",), must), (("--out",), must),
        (("--once",), {"action": "store_true"}), (("--max-files",), {"type": int}),
    )
    command("count", _shown(traffic.row_count), packets)
    command("latest", _shown(traffic.latest_packets), packets)
    command("talkers", _shown(traffic.top_talkers), packets)
    command("verify", _verify, (("-a",), must), (("-b",), must), (("--diff",), {"type": int, "default": 5}))
    command("soak", _soak, samples, (("--max-rss-mib",), {"type": float, "default": 20.0}), (("--duration",), {"type": float, "default": 0.0}))
    command("metrics", _metrics, samples)
    command("drain", _drain, (("--counts",), must), (("--stable",), {"type": float, "default": 10.0}))
    return parser


def _ingest(spark, args) -> int:
    trigger = {"availableNow": True} if args.once else None
    lines = ek_stream(spark, args.lines, args.max_files)
    ingest_stream(lines, args.out, f"{args.out}/checkpoint", trigger=trigger).awaitTermination()
    return 0


def _shown(question):
    def run(spark, args) -> int:
        question(packets_path(spark, args.packets)).show(truncate=False)
        return 0

    return run


def _verify(spark, args) -> int:
    a, b = packets_path(spark, args.a), packets_path(spark, args.b)
    report = reconcile.verify_tables(a, b).first()
    for side, path in (("a", args.a), ("b", args.b)):
        print(f"{path} rows={report[f'rows_{side}']} digest={report[f'digest_{side}']} payload={report[f'payloads_{side}']}")
    if report.passed:
        print(f"tables agree: {report.rows_a} rows")
        return 0
    for problem in report.problems:
        print(f"  - {problem}")
    if report.rows_a and report.rows_b:
        print(f"  rows in {args.a} missing from {args.b}:")
        reconcile.diff_rows(a, b, args.diff).show(args.diff, truncate=False)
    return 1


def _samples(spark, args) -> DataFrame:
    return metrics_parse(spark.read.schema("scrape_ts TIMESTAMP, line STRING").parquet(args.samples))


def _soak(spark, args) -> int:
    gate = counters.soak_gate(_samples(spark, args), max_rss_bytes=args.max_rss_mib * 1024 * 1024, min_elapsed_s=args.duration)
    row = soak_report(gate).first()
    print(row.report or "no samples")
    return 0 if row.passed and row.report else 1


def _metrics(spark, args) -> int:
    samples = _samples(spark, args)
    missing = [r.missing for r in counters.metric_contract(samples).collect()]
    print("\n".join(f"MISSING {name}" for name in missing) or "metric contract satisfied")
    return 1 if missing else 0


def _drain(spark, args) -> int:
    counts = spark.read.schema("ts TIMESTAMP, n BIGINT").parquet(args.counts)
    rows = counters.settled_at(counts, (), int(args.stable * 1_000_000)).collect()
    status, n = (rows[0].status, rows[0].n) if rows else ("empty", 0)
    print(f"{status}: {n} rows")
    return 0 if status == "settled" else 1


if __name__ == "__main__":
    sys.exit(main())
