"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Which rows of the matrix need to meet follows from a bound of their sizes: two sets of a and b
n-grams with a Jaccard similarity of t differ in at most ``(1 - t) / (1 + t) * (a + b)`` n-grams.
The n-grams are dealt into more column blocks than that, by hash, so some block of such a pair is
equal; rows are candidates of one another only where they share a whole block of two n-grams or
more. A block of one n-gram is shared by all texts with one common line, so only rows with few
larger blocks show theirs. Small sets, and the few with too many empty blocks, are found by
their n-grams of least hash instead: of those, similar sets share one among the first
``(1 - t) * a + 1``. Rows that are joined by candidates of
one size band form a cluster. Each cluster's product is computed in tasks of bounded size, column
block by column block; pairs whose overlap can no longer reach the bound are dropped on the way,
and of the pairs that reach it only a spanning forest leaves the task.

Texts with equal sets are one class and take part once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from wirelake.llm import blocks, common
from wirelake.llm.components import components

#: Bytes of text behind each bucket of block signatures; it bounds what a task gathers.
BUCKET_BYTES = 32 << 20
#: n-grams that one task multiplies; a cluster beyond it is split into pairs of row blocks.
TASK_GRAMS = 1 << 21
#: Signatures a task gathers before it sends them off.
FLUSH = 1 << 20
#: Bits that tell which documents are in a cluster: 4 MB, sent to every task.
MEMBER_BITS = 1 << 25
ROWS, COLUMNS = 256, 2048
#: Rows that are multiplied with the whole cluster before its blocks are.
PIVOTS = 8
_BAND = np.uint64(0x5BD1E9955BD1E995)
#: A node of the candidate graph is a class within a band: its low bits are the band, or this.
_NO_BAND = 4095
_KEY = np.uint64(0xD6E8FEB86659FD93)


def gram_sets(values: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, sorted within it, and where each text's begin.

    A text of fewer words than ``n`` has them all as its one n-gram; without words it has none.
    """
    data, starts = blocks.joined(values)
    data = blocks.LOWER[data]
    begin, end = blocks.spans(data, blocks.SPACE)
    words = blocks.range_hashes(blocks.prefix_sums(data), begin, end)
    first = np.searchsorted(begin, starts)
    out, sizes = [], []
    grams = words.copy()
    for k in range(1, n):
        grams = blocks.mix(grams[:-1] * blocks._BASE + words[k:]) if len(grams) else grams
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= n:
            found = np.unique(grams[a : b - n + 1])
        elif b > a:
            found = words[a : a + 1] * np.uint64(31)
            for w in words[a + 1 : b]:
                found = blocks.mix(found + w)
        else:
            found = words[:0]
        out.append(found)
        sizes.append(len(found))
    return (np.concatenate(out) if out else words[:0]), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


class Bounds:
    """What similarity ``percent`` asks of set sizes: bands of sizes and column blocks per band."""

    #: Sets below this size are found by their least hashes alone.
    SMALL = 64

    def __init__(self, percent: int):
        self.percent = percent
        self.ratio = 1 / (percent / 100 - 0.001)  # a little wide, so that rounding loses no pair
        #: Sets below this size are similar only if equal.
        self.least = next(n for n in range(1, 1 << 20) if 100 * n >= percent * (n + 1))
        self.most = np.array([int(min(self.ratio ** (k + 1) + 1e-6, 1 << 41)) for k in range(self._top + 2)], np.int64)
        self.parts = np.array([self._dealt(k) for k in range(self._top + 2)], np.int64)

    @property
    def _top(self) -> int:
        return int(np.log(1 << 40) / np.log(self.ratio))

    def _dealt(self, band: int) -> int:
        """Column blocks of a band.

        The blocks outnumber what a pair in this band or the one below can differ in by more than
        those of either row that tell nothing: the blocks with less than two n-grams, if there is
        a number of blocks that leaves enough others, or else the empty ones.
        """
        most = int(self.most[band])
        sizes = np.array([max(self.ratio ** (band - 1), self.SMALL), max(self.ratio**band, self.SMALL), max(most, self.SMALL)])
        differ, spare = int(self.differ(most, band)), 1
        tried = np.unique(differ + 2 + (max(differ, 20) * np.arange(41) / 20).astype(np.int64))[:, None]
        load = sizes / tried
        light = (1 + load) * np.exp(-load)
        left = tried - self.differ(sizes.astype(np.int64), band) - 1 - tried * light
        sure = (left / np.sqrt(tried * light * (1 - light))).min(1)  # deviations that the rows' light blocks stay below
        if sure.max() > 0:
            enough = np.flatnonzero(sure >= 2)
            return int(tried[enough[0] if len(enough) else sure.argmax(), 0])
        for _ in range(40):
            empty = (differ + 1 + spare) * np.exp(-sizes[0] / (differ + 1 + spare))
            spare = 1 + int(np.ceil(empty + 2 * np.sqrt(empty)))
        return differ + 1 + spare

    def differ(self, sizes: np.ndarray, band: np.ndarray) -> np.ndarray:
        """The n-grams in which a set can differ from one similar to it of up to this band."""
        other = np.minimum(100 * sizes // self.percent, self.most[band])
        return (100 - self.percent) * (sizes + other) // (100 + self.percent)

    def band(self, sizes: np.ndarray) -> np.ndarray:
        return np.floor(np.log(np.maximum(sizes, 1)) / np.log(self.ratio) + 1e-9).astype(np.int64)

    def prefix(self, sizes: np.ndarray) -> np.ndarray:
        """How many of the least hashes of similar sets must have one in common."""
        return sizes + (-sizes * self.percent // 100) + 1

    def similar(self, overlap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * overlap >= self.percent * (a + b - overlap)

    def needed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The least overlap that makes rows of these sizes similar."""
        total = self.percent * (a + b)
        return -(-total // (100 + self.percent))


def signatures(grams: np.ndarray, at: np.ndarray, bounds: Bounds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, signature, band) triples, of which any two similar rows have an equal signature."""
    sizes = np.diff(at)
    large = sizes >= bounds.SMALL
    out_rows, out, out_bands = [], [], []
    # similar to a small set, or a small set
    by_least = (sizes >= bounds.least) & (sizes <= bounds.SMALL * bounds.ratio)
    if large.any():
        of_row = np.repeat(np.arange(len(sizes)), sizes)
        wide = large[of_row]
        gram, of_row = grams[wide], of_row[wide]
        mixed = blocks.mix(gram ^ _KEY)
        band = bounds.band(sizes)
        for step in (0, 1):
            key = band + step
            parts = bounds.parts[key]
            part = ((gram >> np.uint64(32)) * parts[of_row].astype(np.uint64)) >> np.uint64(32)
            new = np.ones(len(gram), bool)
            new[1:] = (of_row[1:] != of_row[:-1]) | (part[1:] != part[:-1])
            first = np.flatnonzero(new)
            row = of_row[first]
            # more blocks are equal than tell nothing of either row, as long as those are so few
            few = parts - bounds.differ(sizes, key) - 1
            several = np.diff(np.append(first, len(gram))) > 1
            shown = several | (parts - np.bincount(row[several], minlength=len(sizes)) > few)[row]
            by_least |= large & (parts - np.bincount(row, minlength=len(sizes)) > few)
            where = part[first] * _KEY + key[row].astype(np.uint64) * _BAND
            out.append(blocks.mix(np.add.reduceat(mixed, first) ^ where)[shown])
            out_rows.append(row[shown])
            out_bands.append(key[row][shown])
    rows = np.flatnonzero(by_least)
    take = bounds.prefix(sizes[rows])
    place = np.repeat(at[rows] - np.cumsum(take) + take, take) + np.arange(take.sum())
    out.append(blocks.mix(grams[place] ^ _BAND))
    out_rows.append(np.repeat(rows, take))
    out_bands.append(np.full(len(place), _NO_BAND))
    return np.concatenate(out_rows), np.concatenate(out), np.concatenate(out_bands)


def _starred(sig: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry per signature with its least class, and edges from that to the others."""
    order = np.lexsort((cls, sig))
    sig, cls = sig[order], cls[order]
    new = np.ones(len(sig), bool)
    new[1:] = sig[1:] != sig[:-1]
    first = np.flatnonzero(new)
    least = np.repeat(cls[first], np.diff(np.append(first, len(sig))))
    other = cls != least
    edges = np.unique(np.stack([cls[other], least[other]], 1), axis=0) if other.any() else np.zeros((0, 2), np.int64)
    return sig[first], cls[first], edges


def _pack(sig: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Signatures by class, six bytes each: equal ones that are not the same only cost time."""
    order = np.argsort(cls, kind="stable")
    value, count = np.unique(cls, return_counts=True)
    short = np.ascontiguousarray(sig[order]).view(np.uint8).reshape(-1, 8)[:, :6]
    return np.concatenate([np.array([len(value)]).view(np.uint8), value.view(np.uint8), count.astype(np.int32).view(np.uint8), short.reshape(-1)])


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    value, count = np.frombuffer(data, np.int64, n, 8), np.frombuffer(data, np.int32, n, 8 + 8 * n)
    short = np.frombuffer(data, np.uint8, offset=8 + 12 * n).reshape(-1, 6)
    sig = np.zeros((len(short), 8), np.uint8)
    sig[:, :6] = short
    return sig.view(np.uint64).reshape(-1), np.repeat(value, count)


_MAPPED = "bucket int, kind int, data binary"
_DOCS, _EDGES, _SIGNS = 0, 1, 2


def _row(bucket: int, kind: int, data: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([bucket], pa.int32()), pa.array([kind], pa.int32()), pa.array([data.tobytes()], pa.binary())],
        ["bucket", "kind", "data"],
    )


def _map(batches: Iterator[pa.RecordBatch], n: int, percent: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Documents with class and size, local edges, and signatures by bucket."""
    bounds = Bounds(percent)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    count = turn = 0
    task = TaskContext.get()
    part = task.partitionId() if task else 0

    def passing(kind: int) -> int:
        """A bucket for rows that only pass through, by task and step: no text brings them together."""
        return int(blocks.mix(np.array([part << 32 | turn << 1 | (kind == _EDGES)], np.uint64))[0] % np.uint64(buckets))

    def flushed():
        sig, cls, edges = _starred(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
        if len(edges):
            yield _row(passing(_EDGES), _EDGES, edges)
        bucket = ((sig >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))  # sorted as the signatures are
        for b in np.flatnonzero(np.diff(cuts)):
            yield _row(int(b), _SIGNS, _pack(sig[cuts[b] : cuts[b + 1]], cls[cuts[b] : cuts[b + 1]]))

    for batch in batches:
        ids = batch.column(0).to_pylist()
        values = blocks.texts(batch.column(1))
        for a, b in blocks.steps(values):
            grams, at = gram_sets(values[a:b], n)
            cls = np.zeros(b - a, np.int64)
            for i in range(b - a):
                digest = hashlib.blake2b(grams[at[i] : at[i + 1]].tobytes(), digest_size=8).digest()
                cls[i] = int.from_bytes(digest, "little", signed=True)
            known = np.array([x is not None for x in ids[a:b]])
            doc = np.array([x or 0 for x in ids[a:b]], np.int64)
            turn += 1
            yield _row(passing(_DOCS), _DOCS, np.stack([doc, np.diff(at), cls, known.astype(np.int64)], 1))
            row, sig, band = signatures(grams, at, bounds)
            keep = known[row]
            held.append((sig[keep], cls[row[keep]] & ~_NO_BAND | band[keep]))
            count += len(sig)
            if count >= FLUSH:
                yield from flushed()
                held, count = [], 0
    if count:
        yield from flushed()


_REDUCED = "kind int, a bigint, b bigint, c bigint"


def _reduce(group: pd.DataFrame) -> pd.DataFrame:
    """Documents and edges pass through; signatures become edges."""
    out = []
    for kind, data in zip(group["kind"], group["data"]):
        if kind == _DOCS:
            d = np.frombuffer(data, np.int64).reshape(-1, 4)
            out.append(pd.DataFrame({"kind": np.where(d[:, 3] == 1, 0, 2), "a": d[:, 0], "b": d[:, 1], "c": d[:, 2]}))
        elif kind == _EDGES:
            e = np.frombuffer(data, np.int64).reshape(-1, 2)
            out.append(pd.DataFrame({"kind": 1, "a": e[:, 0], "b": e[:, 1], "c": 0}))
    signs = [_unpack(d) for k, d in zip(group["kind"], group["data"]) if k == _SIGNS]
    if signs:
        _, _, edges = _starred(*[np.concatenate(part) for part in zip(*signs)])
        out.append(pd.DataFrame({"kind": 1, "a": edges[:, 0], "b": edges[:, 1], "c": 0}))
    return pd.concat(out).astype({"kind": "int32"})


def forest(sets: list[np.ndarray], bounds: Bounds) -> list[tuple[int, int]]:
    """Pairs of row numbers that link all rows similar to one another, as few as connect them."""
    m, percent = len(sets), bounds.percent
    parent = np.arange(m)
    links: list[tuple[int, int]] = []

    def join(left: np.ndarray, right: np.ndarray) -> None:
        """Take in similar pairs; those that connect something new become links."""
        nonlocal parent
        for x, y in zip(left.tolist(), right.tolist()):
            a, b = x, y
            while parent[a] != a:
                a = parent[a]
            while parent[b] != b:
                b = parent[b]
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((x, y))
        while (parent != (up := parent[parent])).any():
            parent = up

    sizes = np.array([len(s) for s in sets], np.int64)
    of_row = np.repeat(np.arange(m), sizes)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[column] > 1  # only these columns add to an overlap
    of_row, column = of_row[shared], column[shared]
    number = np.cumsum(counts > 1) - 1
    column = number[column]
    width = int((counts > 1).sum())
    at = np.searchsorted(of_row, np.arange(m + 1))

    def against(pivot: int) -> None:
        """One row of the product, for the case that most rows are like the pivot."""
        mine = np.zeros(width, bool)
        mine[column[at[pivot] : at[pivot + 1]]] = True
        overlap = np.bincount(of_row[mine[column]], minlength=m)
        found = np.flatnonzero(bounds.similar(overlap, sizes[pivot], sizes))
        join(np.full(len(found), pivot), found)

    for _ in range(PIVOTS if m > 2 else 0):
        alone = np.flatnonzero(np.bincount(parent, minlength=m)[parent] == 1)
        if len(alone) < 2:
            break
        against(int(alone[0]))
    order = np.lexsort((sizes, parent))
    by_column = np.argsort(column, kind="stable")
    holders = np.empty(m, np.int64)
    holders[order] = np.arange(m)
    holders = holders[of_row[by_column]]  # of each column, the rows that have it, as places in the order
    column_at = np.searchsorted(column[by_column], np.arange(width + 1))
    for i in range(0, m, ROWS):
        left, right = order[i : i + ROWS], order[i:]
        a, b = sizes[left][:, None], sizes[right][None, :]
        alive = (parent[left][:, None] != parent[right][None, :]) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
        if not alive.any():
            continue
        mine = np.concatenate([column[at[r] : at[r + 1]] for r in left])
        found = np.diff(column_at)[mine]
        if found.sum() * 100 < width * alive.size:
            overlap = _counted(left, i, m, column, at, holders, column_at)
            x, y = np.nonzero(alive & bounds.similar(overlap, a, b))
            join(left[x], right[y])
            continue
        for j in range(0, len(right), ROWS):  # dense: blocks of rows by blocks of rows
            part, b = right[j : j + ROWS], sizes[right[j : j + ROWS]][None, :]
            lives = alive[:, j : j + ROWS] & (parent[left][:, None] != parent[part][None, :])
            needed, overlap = bounds.needed(a, b), np.zeros(lives.shape, np.int64)
            rest_l, rest_r = np.diff(at)[left][:, None], np.diff(at)[part][None, :]
            for c in range(0, width, COLUMNS):
                if not lives.any():
                    break
                part_l, part_r = (_dense(side, column, at, c) for side in (left, part))
                overlap += (part_l @ part_r.T).astype(np.int64)
                rest_l = rest_l - part_l.sum(1, dtype=np.int64)[:, None]
                rest_r = rest_r - part_r.sum(1, dtype=np.int64)[None, :]
                lives &= overlap + np.minimum(rest_l, rest_r) >= needed
            x, y = np.nonzero(lives & bounds.similar(overlap, a, b))
            join(left[x], part[y])
    return links


def _counted(
    left: np.ndarray, i: int, m: int, column: np.ndarray, at: np.ndarray, holders: np.ndarray, column_at: np.ndarray
) -> np.ndarray:
    """Overlaps of the rows ``left`` with those from place ``i`` on, counted from the columns' rows."""
    out = np.zeros((len(left), m - i), np.int64)
    for k, r in enumerate(left):
        mine = column[at[r] : at[r + 1]]
        start, count = column_at[mine], column_at[mine + 1] - column_at[mine]
        place = holders[np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())]
        out[k] = np.bincount(place, minlength=m)[i:]
    return out


def _dense(rows: np.ndarray, column: np.ndarray, at: np.ndarray, start: int) -> np.ndarray:
    out = np.zeros((len(rows), COLUMNS), np.float32)
    for k, r in enumerate(rows):
        mine = column[at[r] : at[r + 1]]  # sorted, as the sets are
        a, b = np.searchsorted(mine, [start, start + COLUMNS])
        out[k, mine[a:b] - start] = 1
    return out


def _multiply(group: pd.DataFrame, n: int, percent: int) -> pd.DataFrame:
    """Links within each cluster, or pair of row blocks, of one task."""
    bounds = Bounds(percent)
    values = [b"" if t is None else t.encode() for t in group["text"]]
    sets: list[np.ndarray] = []
    for a, b in blocks.steps(values):
        grams, at = gram_sets(values[a:b], n)
        sets += [grams[at[i] : at[i + 1]] for i in range(b - a)]
    nodes, out = group["node"].to_numpy(), []
    for rows in group.reset_index(drop=True).groupby(["cluster", "left", "right"]).indices.values():
        rows = rows[np.argsort(nodes[rows])]
        out += [(nodes[rows[x]], nodes[rows[y]]) for x, y in forest([sets[r] for r in rows], bounds)]
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def jaccard_join(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """Every row's doc_id, n_shingles and component_id, linked at ``percent`` or more.

    Words are lower-cased (A-Z) and split at white space; a text of fewer than ``n`` words has one
    n-gram, without words none, and then links with nothing and is its own component. Null texts
    count as empty. Rows without a doc_id link with nothing and have no component. Rows that
    repeat a doc_id are one document, linked by any of its texts. An empty table gives no rows; other
    columns are ignored. n-grams and sets are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    buckets = int(max(16, (given.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET_BYTES))
    mapped = given.mapInArrow(partial(_map, n=n, percent=percent, buckets=buckets), _MAPPED)
    reduced = common.written(mapped.groupBy("bucket").applyInPandas(_reduce, _REDUCED), "sets")
    rows = reduced.filter("kind <> 1").select(
        F.when(F.col("kind") == 0, F.col("a")).alias("doc_id"), F.col("b").alias("n_shingles"), F.col("c").alias("cls")
    )
    classes = (
        rows.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("cls")
        .agg(F.min("doc_id").alias("node"), F.max("n_shingles").alias("n"))
    )
    clusters = components(reduced.filter("kind = 1").select("a", "b"))
    # a class is in the graph once for each band that it has candidates in; one band more on
    # either side, so that rounding here and in the tasks need not agree
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(Bounds(percent).ratio)))
    bands = F.explode(F.array(*[band + k for k in range(-1, 3)], F.lit(_NO_BAND).cast("bigint")))
    nodes = classes.withColumn("_band", bands).select(
        F.col("cls").bitwiseAND(F.lit(~_NO_BAND).cast("bigint")).bitwiseOR(F.col("_band")).alias("_in_band"), F.col("node").alias("_doc"), "n"
    )
    members = common.written(
        clusters.join(nodes, F.col("node") == F.col("_in_band")).select(F.col("_doc").alias("node"), "component", "n"), "members"
    )
    links = _links(given, members, n, percent)
    linked = components(links).select(F.col("node").alias("_least"), F.col("component").alias("_component"))
    least = classes.select("cls", F.col("node").alias("_least"))
    named = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL").join(least, "cls").join(linked, "_least", "left")
    alone = rows.filter("n_shingles = 0 OR doc_id IS NULL")
    return named.select("doc_id", "n_shingles", F.coalesce("_component", "_least").alias("component_id")).unionByName(
        alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    )


def _links(given: DataFrame, members: DataFrame, n: int, percent: int) -> DataFrame:
    """(a, b) links between the least documents of the classes, from the product of each cluster."""

    def multiply(group: pd.DataFrame) -> pd.DataFrame:
        return _multiply(group, n, percent)

    weights = members.groupBy("component").agg(F.sum("n").alias("_weight"))
    total = members.agg(F.sum("n")).first()[0] or 0
    tasks = int(max(1, total // TASK_GRAMS))
    split = F.ceil(F.col("_weight") / TASK_GRAMS).cast("int")  # row blocks of a cluster
    block = F.pmod(F.xxhash64("node"), split).cast("int")
    placed = (
        members.join(weights, "component")
        .withColumn("_block", F.when(split > 1, block).otherwise(0))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), split - 1)))
        .select(
            "node", F.col("component").alias("cluster"),
            F.least("_block", "_other").alias("left"), F.greatest("_block", "_other").alias("right"), split.alias("_split"),
        )
        # small clusters share tasks, pairs of row blocks have one each
        .withColumn("task", F.when(F.col("_split") > 1, F.xxhash64("cluster", "left", "right")).otherwise(F.pmod(F.xxhash64("cluster"), F.lit(tasks))))
    )
    texts = _perhaps_in(given.filter("doc_id IS NOT NULL"), members)
    # merged at every size: a plan that broadcasts small inputs says nothing about large ones
    chosen = placed.hint("merge").join(texts, placed["node"] == texts["doc_id"]).select("task", "cluster", "left", "right", "node", "text")
    return chosen.groupBy("task").applyInPandas(multiply, "a bigint, b bigint")


def _perhaps_in(texts: DataFrame, members: DataFrame) -> DataFrame:
    """The texts whose doc_id is a member's, and few others, found without a shuffle of texts."""
    place = lambda key: F.pmod(F.xxhash64(key), F.lit(MEMBER_BITS))
    bits = members.groupBy(F.bitmap_bucket_number(place("node")).alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place("node"))).alias("_bits")
    )
    bit = F.bitmap_bit_position(place("doc_id"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(1) == 1
    near = texts.withColumn("_part", F.bitmap_bucket_number(place("doc_id"))).join(F.broadcast(bits), "_part")
    return near.filter(hit).select("doc_id", "text")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(common.table(spark, sf_dir, "documents"))


def op4_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
    ), grams AS (
      SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS gram
      FROM words
    ), sizes AS (
      SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
    ), links AS (
      SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b USING (gram)
      JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
      WHERE a.doc_id <> b.doc_id AND 10 * least(x.n, y.n) >= 9 * greatest(x.n, y.n)
      GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
    ), reach AS (
      SELECT doc_id AS a, doc_id AS c FROM documents
      UNION SELECT l.b, r.c FROM reach r JOIN links l ON l.a = r.a
    )
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
    FROM documents d LEFT JOIN sizes s USING (doc_id)
    JOIN (SELECT a AS doc_id, min(c) AS component_id FROM reach GROUP BY a) r USING (doc_id)"""
