"""Find the rows of a micro-batch that a write fails on.

The batch is stored in parts by ranges of a row hash, small enough to be tried one by one, several
at a time. A part that succeeds is fine; in one that fails, halves are tried until a half is one
hash: that row (with its copies) is at fault. So each row is read about once, besides the parts with
faults, and k bad rows take about 20 * k small tries more, however long the batch is. If the store
fails on no rows at all, or on more than a share of them, it is the store that fails, not the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, functions as F

from wirelake.session import run_folder
from wirelake.sources import files

#: Hashes that may be refused of any micro-batch, and beyond that one of so many rows.
MOST_REFUSED, ROWS_PER_REFUSED = 100, 100
#: Rows of a part, and parts that are tried at the same time.
PART_ROWS, AT_ONCE = 1 << 14, 8
_HASH, _PART = "_hash", "_part"


class _Away(Exception):
    """It is the store that fails."""


def row_hash(rows: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])


def isolate(rows: DataFrame, attempt: Callable[[DataFrame], None], most: int | None = None) -> list[int]:
    """The hashes of the rows that ``attempt`` fails on; empty if it is not rows that make it fail.

    ``attempt`` writes rows somewhere without lasting effect; it is called from several threads.
    The driver sees the hashes of the parts at work and those at fault, at most ``most``
    (``MOST_REFUSED`` or a share of the rows by default).
    """
    spark = rows.sparkSession
    if _fails(rows.limit(0), attempt):
        return []  # fails without any row
    count = rows.count()
    most = max(MOST_REFUSED, count // ROWS_PER_REFUSED) if most is None else most
    bits = max(0, (count // PART_ROWS).bit_length())
    part = F.shiftright(_HASH, 64 - bits) if bits else F.lit(0).cast("bigint")
    path = run_folder(spark, "tried")
    hashed = rows.withColumn(_HASH, row_hash(rows)).withColumn(_PART, part)
    refused: list[int] = []

    def search(number: int) -> None:
        own = stored.filter(F.col(_PART) == number).drop(_PART)

        def fails(low: int, high: int) -> bool:
            if len(refused) > most:
                raise _Away
            return _fails(own.filter(F.col(_HASH).between(hashes[low], hashes[high - 1])).drop(_HASH), attempt)

        if len(refused) > most or not _fails(own.drop(_HASH), attempt):
            return
        hashes = sorted(r[0] for r in own.select(_HASH).distinct().collect())  # of one part
        waiting, found = [(0, len(hashes))], 0
        while waiting:  # ranges that fail
            low, high = waiting.pop()
            if high - low == 1:
                if fails(low, high):  # one may get here because others did not fail
                    refused.append(hashes[low])
                    found += 1
                    if found % MOST_REFUSED == 0 and _fails(own.drop(_HASH).limit(0), attempt):
                        raise _Away
                continue
            middle = (low + high) // 2
            left = fails(low, middle)
            if left:
                waiting.append((low, middle))
            if not left or fails(middle, high):
                waiting.append((middle, high))

    try:
        hashed.repartitionByRange(_HASH).sortWithinPartitions(_PART, _HASH).write.partitionBy(_PART).parquet(path)
        stored = spark.read.schema(hashed.schema).parquet(path)
        numbers = range(-(1 << bits - 1), 1 << bits - 1) if bits else range(1)
        with ThreadPoolExecutor(AT_ONCE) as pool:
            list(pool.map(inheritable_thread_target(spark)(search), numbers))
    except _Away:
        return []
    finally:
        files.remove_folder(spark, path)
    return refused if len(refused) <= most else []


def _fails(rows: DataFrame, attempt: Callable[[DataFrame], None]) -> bool:
    try:
        attempt(rows)
    except Exception:  # whatever the store says, the rows are split
        return True
    return False


def _hashes(rows: DataFrame, hashes: list[int]) -> DataFrame:
    return F.broadcast(rows.sparkSession.createDataFrame([(h,) for h in hashes], f"{_HASH} bigint"))


def without(rows: DataFrame, hashes: list[int]) -> DataFrame:
    return rows.withColumn(_HASH, row_hash(rows)).join(_hashes(rows, hashes), _HASH, "left_anti").select(*rows.columns)


def only(rows: DataFrame, hashes: list[int]) -> DataFrame:
    return rows.withColumn(_HASH, row_hash(rows)).join(_hashes(rows, hashes), _HASH, "left_semi").select(*rows.columns)
