"""Sharding along a Hilbert curve over metadata columns.

Each metadata column is quantised at its own quantiles, the cells are ordered along a Hilbert
curve, and the ordered rows are cut into runs of equal row counts. Neighbours on the curve have
similar values in every dimension, so a reader can prune shards on any of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F, types as T

from wirelake.llm import common

#: Bits per dimension: 2 ** BITS - 1 quantile bounds for each metadata column.
BITS = 6
DIMENSIONS = ("lang", "source", "n_chars")
SHARDS = 40


def curve_table(dims: int) -> tuple[list[int], int]:
    """The Hilbert curve as a state machine: ``table[state << dims | cell]``.

    An entry holds the cell's place on the curve, shifted by the second result, and the next
    state. A state is an entry corner and a direction.
    """
    mask = (1 << dims) - 1

    def left(x: int, by: int) -> int:
        by %= dims
        return (x << by | x >> (dims - by)) & mask

    def gray(x: int) -> int:
        return x ^ x >> 1

    place_of = {gray(i): i for i in range(1 << dims)}

    def trailing_ones(i: int) -> int:
        return (~i & (i + 1)).bit_length() - 1

    def entry(place: int) -> int:
        return 0 if place == 0 else gray(2 * ((place - 1) // 2))

    def turn(place: int) -> int:
        if place == 0:
            return 0
        return trailing_ones(place - 1 if place % 2 == 0 else place) % dims

    width = ((1 << dims) * dims - 1).bit_length()
    out = [0] * (1 << (width + dims))
    for corner in range(1 << dims):
        for direction in range(dims):
            state = corner * dims + direction
            for cell in range(1 << dims):
                place = place_of[left(cell ^ corner, -(direction + 1))]
                to_corner = corner ^ left(entry(place), direction + 1)
                to_direction = (direction + turn(place) + 1) % dims
                out[state << dims | cell] = place << width | (to_corner * dims + to_direction)
    return out, width


def hilbert_index(cells: Sequence[Column], bits: int) -> Column:
    """The place of a cell on the curve; each of ``cells`` is a number below ``2 ** bits``."""
    dims = len(cells)
    steps, width = curve_table(dims)
    lookup = F.array(*[F.lit(x) for x in steps])
    levels = F.array(*[F.lit(x) for x in range(bits - 1, -1, -1)])

    def step(inputs: Column):
        def move(acc: Column, level: Column) -> Column:
            cell = F.lit(0)
            for d in range(dims):
                bit = F.call_function("shiftright", inputs[d], level).bitwiseAND(1)
                cell = cell * 2 + bit
            state = acc.bitwiseAND((1 << width) - 1).cast("int")
            found = F.element_at(lookup, F.shiftleft(state, dims).bitwiseOR(cell) + 1)
            done = F.shiftleft(F.shiftright(acc, width), dims + width)
            return done + found

        return F.shiftright(F.aggregate(levels, F.lit(0).cast("bigint"), move), width)

    return common.once(F.array(*cells), step)


def sortable(name: str, kind: T.DataType) -> Column:
    """A column's values in their order; null comes first, as an empty text or as -1."""
    if isinstance(kind, T.StringType):
        return F.coalesce(F.col(name), F.lit(""))
    return F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(-1.0)), F.lit(-1.0))


def text_bounds(rows: DataFrame, value: Column, parts: int) -> list[str]:
    """The texts at which ``1 / parts``, ``2 / parts`` .. of all rows are reached, whole and exact.

    Equal texts are counted in each task first; distinct ones are ranged and numbered by range, so
    none needs to be the key of a task, and the driver gets at most ``parts`` of them.
    """
    counts = rows.groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    counts = common.written(counts, "values")  # else the ranging would count twice
    ranged = counts.repartitionByRange("value").sortWithinPartitions("value").withColumn("range", F.spark_partition_id())
    ranged = common.written(ranged, "values")
    starts, total = [], 0
    for r in ranged.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect():  # a row per range
        starts.append((r["range"], total))
        total += r["n"]
    if not total:
        return []
    offsets = rows.sparkSession.createDataFrame(starts, "range int, before bigint")
    upto = F.sum("n").over(W.partitionBy("range").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow))
    summed = ranged.withColumn("upto", upto).join(F.broadcast(offsets), "range")
    first = F.expr(f"(before + upto - n) * {parts} div {total}")
    last = F.expr(f"(before + upto) * {parts} div {total}")
    reached = summed.select("value", first.alias("first"), last.alias("last")).filter("last > first").orderBy("value").collect()
    return [r["value"] for r in reached for k in range(r["first"], r["last"]) if k + 1 < parts]


def cell_of(value: Column, bounds: Sequence[float | str]) -> Column:
    """How many of the sorted ``bounds`` lie below ``value``, as a balanced tree of comparisons."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value > F.lit(bounds[middle]), between(middle + 1, high)).otherwise(between(low, middle))

    return between(0, len(bounds))


def curve_order(rows: DataFrame, dims: Sequence[str], bits: int, accuracy: int = 10_000) -> Column:
    """The Hilbert index of each row by the quantiles of ``dims`` over all rows.

    Quantiles of numbers come from mergeable sketches of relative error ``1 / accuracy``, those of
    texts from exact counts of whole texts; a value that fills several quantiles leaves cells empty.
    """
    parts = 1 << bits
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    values = {d: sortable(d, kinds[d]) for d in dims}
    texts = [d for d in dims if isinstance(kinds[d], T.StringType)]
    numbers = [d for d in dims if d not in texts]
    bounds = {d: text_bounds(rows, values[d], parts) for d in texts}
    if numbers:
        shares = [(i + 1) / parts for i in range(parts - 1)]
        found = rows.agg(*[F.percentile_approx(values[d], shares, accuracy).alias(f"d{i}") for i, d in enumerate(numbers)]).first()
        bounds |= {d: found[f"d{i}"] or [] for i, d in enumerate(numbers)}
    return hilbert_index([cell_of(values[d], bounds[d]) for d in dims], bits)


def numbered(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """Rows with ``place``, their number from 0 in the given order, and how many there are.

    Rows are ranged and sorted; each range numbers its own rows, and only the counts of the
    ranges are added up. Rows equal in the whole order are numbered in any order.
    """
    if "place" in rows.columns:
        raise ValueError("rows already have a column place")
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.withColumn("_id", F.monotonically_increasing_id())
    kept = common.written(
        ranged.select(
            *rows.columns, F.shiftright("_id", 33).alias("_range"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_row")
        ),
        "ranged",
    )
    counts = sorted((r["_range"], r["n"]) for r in kept.groupBy("_range").agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for part, n in counts:
        starts.append((part, total))
        total += n
    offsets = kept.sparkSession.createDataFrame(starts, "_range bigint, _start bigint")
    placed = kept.join(F.broadcast(offsets), "_range")  # a row for each range
    return placed.select(*rows.columns, (F.col("_start") + F.col("_row")).alias("place")), total


def cut(rows: DataFrame, order: Sequence[str], shards: int) -> DataFrame:
    """Rows with ``shard`` and ``slot``: runs along the order whose counts are at most one apart."""
    placed, total = numbered(rows, order)
    shard = F.expr(f"place * {shards} div {max(total, 1)}")
    first = F.expr(f"(place * {shards} div {max(total, 1)} * {total} + {shards - 1}) div {shards}")
    return placed.select(*rows.columns, shard.cast("int").alias("shard"), (F.col("place") - first).alias("slot"))


def hilbert_shards(
    docs: DataFrame, dims: Sequence[str] = DIMENSIONS, shards: int = SHARDS, bits: int = BITS
) -> DataFrame:
    """Each document's place: doc_id, size, text_crc32, its ``dims`` and curve index, shard, slot.

    Texts stay where they are; only these columns are shuffled. A null text has no bytes and the
    checksum of the empty text; null metadata forms the lowest cell; repeated rows all get a
    slot; an empty table gives no rows; other columns are ignored.
    """
    keyed = docs.select(
        "doc_id",
        (common.utf8_bytes(F.col("text")) + 16).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
        *dims,
        curve_order(docs, dims, bits).alias("curve"),
    )
    keyed = common.written(keyed, "keyed")  # else the ranging would read every text twice
    return cut(keyed, ["curve", "text_crc32", "size", "doc_id"], shards)


def write_shards(docs: DataFrame, places: DataFrame, path: str) -> None:
    """Write whole rows to a folder per shard, in slot order; ``places`` has doc_id, shard, slot."""
    joined = docs.join(places.select("doc_id", "shard", "slot"), "doc_id")
    joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = hilbert_shards(common.table(spark, sf_dir, "documents"))
    return places.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
