"""Differences of two packet tables from summaries, without shuffling either table.

Rows are numbered by a 64-bit hash and dealt into buckets of their hour. A bucket's digest is the
sum of its rows' numbers, an hour's digest that of its buckets; both can be stored beside a table.
Only hours, then buckets, whose digests differ are looked into: their rows are summed into the
cells of an invertible Bloom lookup table, the second table's with a minus, so equal rows cancel
in the aggregation. A cell that holds one row alone gives its number and how often more the
first table has it; taking it out of its other cells frees further ones. The rows themselves are
then picked by number where they lie. A bucket with more differences than its cells can tell
apart is compared row by row, it alone.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from wirelake.operators.scan import kept
from wirelake.operators.storage import with_chunk
from wirelake.schema import SHAPED_COLUMNS
from wirelake.session import send_code_with_tasks

#: Buckets of an hour, sub-tables of a bucket's lookup table, and cells of each of them.
BUCKETS, TABLES, CELLS = 256, 3, 32
#: Buckets of an hour whose tables are taken apart by one call.
PEELED_AT_ONCE = 256
#: Bytes of bucket and row numbers that may be sent to every task; beyond them rows are shuffled.
BROADCAST_BYTES = 16 << 20
_KEY_BYTES = 32
_SUM = "decimal(38,0)"


def row_number_of(columns: list[str] = SHAPED_COLUMNS) -> Column:
    """A 64-bit number of a row; nulls count by where they are."""
    return F.xxhash64(*columns, F.concat_ws("", *[F.col(c).isNull().cast("string") for c in columns]))


def numbered(packets: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The shaped columns with ``chunk``, ``_bucket`` and ``_id``."""
    rows = packets if "chunk" in packets.columns else with_chunk(packets)
    rows = rows.select(*SHAPED_COLUMNS, "chunk").withColumn("_id", row_number_of())
    return rows.withColumn("_bucket", F.pmod("_id", F.lit(buckets)).cast("int"))


def bucket_digests(packets: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``chunk, bucket, rows, digest``: what to store beside a table; a row per task moves at most."""
    return (
        numbered(packets, buckets).groupBy("chunk", F.col("_bucket").alias("bucket"))
        .agg(F.count("*").alias("rows"), F.sum(F.col("_id").cast(_SUM)).alias("digest"))
    )


def chunk_digests(digests: DataFrame) -> DataFrame:
    """``chunk, rows, digest``: the level above the buckets."""
    return digests.groupBy("chunk").agg(F.sum("rows").alias("rows"), F.sum("digest").alias("digest"))


def _unequal(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose rows or digest differ, or that one side lacks."""
    other = b.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("rows").alias("_rows"), F.col("digest").alias("_digest"))
    same_key = [F.col(k) == F.col(f"_{k}") for k in keys]
    both = a.join(other, same_key, "full")
    same = F.col("rows").eqNullSafe(F.col("_rows")) & F.col("digest").eqNullSafe(F.col("_digest"))
    return both.filter(~same).select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys])


def differing_buckets(digests_a: DataFrame, digests_b: DataFrame) -> DataFrame:
    """``chunk, bucket`` where the tables differ; buckets are compared in differing hours only."""
    chunks = _unequal(chunk_digests(digests_a), chunk_digests(digests_b), ["chunk"])
    a, b = (d.join(chunks, "chunk", "left_semi") for d in (digests_a, digests_b))
    return _unequal(a, b, ["chunk", "bucket"])


def _small(rows: DataFrame) -> DataFrame:
    """Keys marked for broadcast if they are as few as that asks."""
    return F.broadcast(rows) if rows.count() * _KEY_BYTES <= BROADCAST_BYTES else rows


def _within(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    keys = buckets.select("chunk", F.col("bucket").alias("_bucket"))
    return rows.join(keys, ["chunk", "_bucket"], "left_semi")


def _digits(hexed: Column, first: int, count: int) -> Column:
    return F.conv(F.substring(hexed, first, count), 16, 10).cast("bigint")


def lookup_cells(a: DataFrame, b: DataFrame, cells: int = CELLS) -> DataFrame:
    """The difference of two lookup tables: ``chunk, _bucket, cell, n, ids, checks``, cells that are not empty."""

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select("chunk", "_bucket", "_id", F.lit(sign).alias("_sign"))

    rows = signed(a, 1).unionByName(signed(b, -1)).withColumn("_hex", F.md5(F.col("_id").cast("string").cast("binary")))
    places = [F.lit(t * cells).cast("bigint") + _digits(F.col("_hex"), 13 + 6 * t, 6) % cells for t in range(TABLES)]
    spread = rows.select(
        "chunk", "_bucket", F.explode(F.array(*places)).alias("cell"), F.col("_sign").cast("bigint").alias("_n"),
        (F.col("_id").cast(_SUM) * F.col("_sign")).cast(_SUM).alias("_i"),
        (_digits(F.col("_hex"), 1, 12) * F.col("_sign")).cast(_SUM).alias("_c"),
    )
    summed = spread.groupBy("chunk", "_bucket", "cell").agg(
        F.sum("_n").alias("n"), F.sum("_i").cast(_SUM).alias("ids"), F.sum("_c").cast(_SUM).alias("checks")
    )
    return summed.filter("n <> 0 OR ids <> 0 OR checks <> 0")


def _places(number: int, cells: int) -> tuple[int, list[int]]:
    """A row number's check and cells, as ``lookup_cells`` works them out."""
    text = hashlib.md5(str(number).encode()).hexdigest()
    return int(text[:12], 16), [t * cells + int(text[12 + 6 * t : 18 + 6 * t], 16) % cells for t in range(TABLES)]


def peeled(cells: dict[int, list[int]], size: int) -> tuple[dict[int, int], bool]:
    """Row numbers with how often more the first table has them, and whether that is all.

    ``cells`` maps a cell to its sums of rows, numbers and checks; it is used up.
    """
    found: dict[int, int] = {}
    waiting = list(cells)
    while waiting:
        n, ids, checks = cells.get(waiting.pop(), (0, 0, 0))
        if not n or ids % n:
            continue
        number = ids // n
        if not -(1 << 63) <= number < 1 << 63:
            continue
        check, places = _places(number, size)
        if check * n != checks:
            continue
        found[number] = found.get(number, 0) + n
        for place in places:
            cell = cells.setdefault(place, [0, 0, 0])
            cell[0] -= n
            cell[1] -= n * number
            cell[2] -= n * check
            waiting.append(place)
    return {k: n for k, n in found.items() if n}, not any(any(c) for c in cells.values())


def _peel(size: int):
    def run(cells: pd.DataFrame) -> pd.DataFrame:
        held: dict[int, dict[int, list[int]]] = {}
        for bucket, *cell in zip(cells["_bucket"], cells["cell"], cells["n"], cells["ids"], cells["checks"]):
            held.setdefault(int(bucket), {})[int(cell[0])] = [int(x) for x in cell[1:]]
        rows: list[tuple[int, int | None, int]] = []
        for bucket, own in held.items():
            found, whole = peeled(own, size)
            rows += [(bucket, number, n) for number, n in found.items()] if whole else [(bucket, None, 0)]
        out = pd.DataFrame({"chunk": [cells["chunk"].iloc[0]] * len(rows), "_bucket": pd.array([r[0] for r in rows], dtype="int32")})
        out["_id"] = pd.array([r[1] for r in rows], dtype="Int64")
        out["n"] = pd.array([r[2] for r in rows], dtype="int64")
        return out

    return run


def differing_rows(a: DataFrame, b: DataFrame, cells: int = CELLS) -> DataFrame:
    """``chunk, _bucket, _id, n``: row numbers and how often more ``a`` has them than ``b``.

    A null number stands for a bucket with more differences than its cells can tell apart.
    """
    send_code_with_tasks(__name__)
    some = F.floor(F.col("_bucket") / PEELED_AT_ONCE)
    return lookup_cells(a, b, cells).groupBy("chunk", some).applyInPandas(
        _peel(cells), "chunk timestamp, _bucket int, _id bigint, n bigint"
    )


def diff_by_digest(
    a: DataFrame,
    b: DataFrame,
    digests_a: DataFrame | None = None,
    digests_b: DataFrame | None = None,
    *,
    buckets: int = BUCKETS,
    cells: int = CELLS,
) -> DataFrame:
    """Rows of ``a`` that ``b`` lacks, with multiplicity, on the shaped columns.

    The same rows as ``reconcile.diff_rows``. Digests that are stored beside the tables
    (``bucket_digests`` with as many ``buckets``) save a pass over equal hours. Rows are told
    apart by 64 bits of a hash.
    """
    first, second = numbered(a, buckets), numbered(b, buckets)
    digests = [
        bucket_digests(rows, buckets) if stored is None else stored for rows, stored in ((a, digests_a), (b, digests_b))
    ]
    unequal = kept(differing_buckets(*digests), "buckets")
    near = _small(unequal)
    first, second = _within(first, near), _within(second, near)
    found = kept(differing_rows(first, second, cells), "differences")
    picked = found.filter("n > 0").select("chunk", "_bucket", "_id", "n")
    told = (
        first.join(_small(picked), ["chunk", "_bucket", "_id"])
        .groupBy(*SHAPED_COLUMNS).agg(F.first("n").alias("n"))
        .select(*SHAPED_COLUMNS, F.explode(F.sequence(F.lit(1), F.col("n"))).alias("_copy")).drop("_copy")
    )
    full = _small(found.filter("_id IS NULL").select("chunk", F.col("_bucket").alias("bucket")))
    rest = _within(first, full).select(*SHAPED_COLUMNS).exceptAll(_within(second, full).select(*SHAPED_COLUMNS))
    return told.unionByName(rest)

