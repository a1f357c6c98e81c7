"""Questions asked of a packet table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wirelake.functions.ip import canonical_address
from wirelake.functions.text import leaf_protocol, message_id, proto_parts
from wirelake.schema import PACKET_COLUMNS


def chunk_width() -> Column:
    return F.expr("INTERVAL 1 HOUR")


def row_count(packets: DataFrame) -> DataFrame:
    return packets.agg(F.count("*").alias("n"))


def latest_packets(packets: DataFrame, n: int = 10) -> DataFrame:
    """The last ``n`` packets; equal times are ordered by the other columns."""
    order = [F.col("ts").desc()] + [F.col(c) for c in ("src_ip", "dst_ip", "proto")]
    return packets.select("ts", "src_ip", "dst_ip", "proto").orderBy(*order).limit(n)


def top_talkers(packets: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` address pairs with the most packets."""
    return (
        packets.groupBy("src_ip", "dst_ip")
        .agg(F.count("*").alias("cnt"))
        .orderBy(F.col("cnt").desc(), "src_ip", "dst_ip")
        .limit(n)
    )


def time_range(packets: DataFrame, low: Column, high: Column) -> DataFrame:
    """``low <= ts < high``; on a chunked table the chunks are pruned by the same range."""
    ranged = packets.filter((F.col("ts") >= low) & (F.col("ts") < high))
    if "chunk" in packets.columns:
        ranged = ranged.filter((F.col("chunk") > low - chunk_width()) & (F.col("chunk") < high))
    return ranged


def talker_lookback(packets: DataFrame, src_ip: str, dst_ip: str, low: Column, high: Column) -> DataFrame:
    """Packets of one address pair in a time range."""
    return time_range(
        packets.filter((F.col("src_ip") == src_ip) & (F.col("dst_ip") == dst_ip)), low, high
    )


def traffic_filter(
    proto: str | None = None,
    port: int | None = None,
    host: str | None = None,
    negate: bool = False,
) -> Column:
    """A predicate on packets: protocol in the path, either port, either address.

    ``traffic_filter("tcp", 443)`` is "tcp port 443"; ``traffic_filter(port=22, negate=True)``
    is "not port 22" and keeps packets without ports.
    """
    wanted = F.lit(True)
    if proto is not None:
        wanted = wanted & F.array_contains(proto_parts(F.col("proto")), proto)
    if port is not None:
        wanted = wanted & F.coalesce(
            (F.col("src_port") == port) | (F.col("dst_port") == port), F.lit(False)
        )
    if host is not None:
        # Addresses are stored in their canonical form; a host in another form means the same.
        address = F.lit(canonical_address(host))
        wanted = wanted & ((F.col("src_ip") == address) | (F.col("dst_ip") == address))
    # A packet without ports compares to NULL, which a negation must not lose.
    wanted = F.coalesce(wanted, F.lit(False))
    return ~wanted if negate else wanted


def protocol_counts(packets: DataFrame) -> DataFrame:
    """Packets and bytes per last protocol of the path."""
    return packets.groupBy(
        leaf_protocol(F.col("proto")).alias("leaf"), F.size(proto_parts(F.col("proto"))).alias("depth")
    ).agg(F.count("*").alias("packets"), F.sum("length").alias("bytes"))


def per_minute(packets: DataFrame) -> DataFrame:
    """Packets, bytes and packets per second for each minute."""
    return (
        packets.groupBy(F.window("ts", "1 minute").alias("w"))
        .agg(F.count("*").alias("packets"), F.sum("length").alias("bytes"))
        .select(
            F.col("w.start").alias("minute"), "packets", "bytes", (F.col("packets") / 60.0).alias("pps")
        )
    )


def talkers_per_minute(packets: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` busiest address pairs of each minute.

    Pairs are counted before they are ranked; Spark also limits each task to ``k`` pairs per
    minute before the shuffle, so a minute with most of the traffic stays small.
    """
    rank = Window.partitionBy("minute").orderBy(F.col("packets").desc(), "src_ip", "dst_ip")
    return (
        packets.groupBy(F.window("ts", "1 minute")["start"].alias("minute"), "src_ip", "dst_ip")
        .agg(F.count("*").alias("packets"))
        .withColumn("rank", F.row_number().over(rank))
        .filter(F.col("rank") <= k)
    )


# The columns that make two packets copies of one another: time, addresses, ports, protocols.
IDENTITY = ("ts", "src_ip", "dst_ip", "src_port", "dst_port", "proto")


def packet_id() -> Column:
    """Message id: hash of the identity columns."""
    return message_id(F.unix_micros("ts"), *[F.col(c) for c in IDENTITY[1:]])


def dedup_packets(packets: DataFrame) -> DataFrame:
    """One packet per message id: of several copies, the smallest length and payload.

    Copies are reduced in each task before the shuffle, so a packet copied without end costs
    one row per task.
    """
    return (
        packets.groupBy(*IDENTITY)
        .agg(F.min(F.struct("length", "payload")).alias("_rest"), F.count("*").alias("copies"))
        .withColumn("length", F.col("_rest.length"))
        .withColumn("payload", F.col("_rest.payload"))
        .select(packet_id().alias("msg_id"), *PACKET_COLUMNS, "copies")
    )


def ingest_latency(
    packets: DataFrame, landed: str, *groups: str, within_ms: int = 1000, accuracy: int | None = 100_000
) -> DataFrame:
    """Milliseconds from a packet's time to its landing: spread, and the share that is in time.

    The percentiles are approximate: their rank is off by one part in ``accuracy`` at most. With
    ``None`` they are exact; each task then counts the different delays of a group.
    """
    delay = F.unix_millis(F.col(landed)) - F.unix_millis("ts")

    def percentile(share: float) -> Column:
        if accuracy is None:
            return F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY _ms)").cast("bigint")
        return F.percentile_approx("_ms", F.lit(share), F.lit(accuracy))

    return (
        packets.withColumn("_ms", delay)
        .groupBy(*groups)
        .agg(
            F.count("*").alias("packets"),
            F.min("_ms").alias("min_ms"),
            F.max("_ms").alias("max_ms"),
            percentile(0.5).alias("p50_ms"),
            percentile(0.95).alias("p95_ms"),
            F.count_if(F.col("_ms") <= within_ms).alias("in_time"),
        )
    )


def reconcile_counts(shaped: DataFrame, packets: DataFrame, letters: DataFrame, *run: str) -> DataFrame:
    """What went in against what was stored, per run, packet by packet and bad line by bad line.

    ``shaped`` are the lines as ``shape_lines`` gives them. A packet is known by its identity
    columns, a dead letter by its line; one that is stored less often than it came in is lost, one
    stored more often is doubled, so losses are not hidden by copies. ``status`` is ``complete``,
    ``lost``, ``doubled``, ``lost_and_doubled``, or ``empty`` without lines. Identities are counted
    by grouping, which spreads over tasks, before the rows of a run meet.
    """
    good = F.col("reason").isNull()
    nothing = [F.lit(None).cast(packets.schema[c].dataType).alias(c) for c in IDENTITY]
    unknown = F.lit(None).cast("string").alias("_letter")

    def line_hash(line: str) -> Column:
        return F.md5(F.col(line).cast("binary")).alias("_letter")

    tagged = (
        shaped.select(
            *run, F.lit(1).alias("_in"), F.lit(0).alias("_out"), *[F.when(good, F.col(c)).alias(c) for c in IDENTITY],
            F.when(~good, line_hash("value")).alias("_letter"),
        )
        .unionByName(packets.select(*run, F.lit(0).alias("_in"), F.lit(1).alias("_out"), *IDENTITY, unknown))
        .unionByName(letters.select(*run, F.lit(0).alias("_in"), F.lit(1).alias("_out"), *nothing, line_hash("raw_ek_line")))
    )
    per_id = tagged.groupBy(*run, *IDENTITY, "_letter").agg(F.sum("_in").alias("_in"), F.sum("_out").alias("_out"))
    packet = F.col("_letter").isNull()

    def total(value: Column, where: Column | None = None) -> Column:
        return F.coalesce(F.sum(value if where is None else F.when(where, value)), F.lit(0))

    return (
        per_id.groupBy(*run)
        .agg(
            total(F.col("_in")).alias("lines_in"),
            total(F.col("_out"), packet).alias("packets"),
            total(F.col("_out"), ~packet).alias("dead_letters"),
            F.count_if(packet & (F.col("_out") > 0)).alias("distinct_ids"),
            total(F.greatest(F.col("_in") - F.col("_out"), F.lit(0))).alias("lost"),
            total(F.greatest(F.col("_out") - F.col("_in"), F.lit(0))).alias("doubled"),
        )
        .withColumn("duplicates", F.col("packets") - F.col("distinct_ids"))
        .withColumn(
            "status",
            F.when(F.col("lines_in") == 0, "empty")
            .when((F.col("lost") > 0) & (F.col("doubled") > 0), "lost_and_doubled")
            .when(F.col("lost") > 0, "lost")
            .when(F.col("doubled") > 0, "doubled")
            .otherwise("complete"),
        )
    )
