"""Benchmark decontamination with suffix arrays over the training text.

Every step of training text (a few megabytes) gets a word suffix array; every suffix of the test
items is binary-searched in it, to the depth of a window. All occurrences are found with their
places, checked word by word, and chained into the longest verbatim matches; documents are then
cut from or removed by what was hit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from wirelake.llm import blocks, common

#: Bytes of test text searched for in one pass over the training text; more text, more passes.
PASS_BYTES = 8 << 20
WINDOW = 10
#: ASCII letters and digits and everything beyond ASCII make words.
APART = blocks.separators(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


@dataclass
class Suffixes:
    """The windows of the test items, one per test suffix, with words as numbers from 1."""

    hashes: np.ndarray  # of the known words, sorted
    words: list[bytes]  # the words behind them
    windows: np.ndarray  # one row of word numbers for each distinct window, 0 beyond its end
    lengths: np.ndarray
    item: np.ndarray  # (window, item number) pairs by window
    item_at: np.ndarray
    item_ids: list[int]
    need: np.ndarray  # by word number: the shortest window that begins with it


def suffixes_of(items: list[tuple[int, bytes]], window: int) -> Suffixes:
    """All windows of all items; an item of fewer words, but not none, is one window."""
    data, starts = blocks.joined([t for _, t in items])
    data = blocks.LOWER[data]
    begin, end = blocks.spans(data, APART)
    raw = data.tobytes()
    hashed = blocks.range_hashes(blocks.prefix_sums(data), begin, end)
    hashes, where, number = np.unique(hashed, return_index=True, return_inverse=True)
    words = [raw[begin[i] : end[i]] for i in where]
    first = np.searchsorted(begin, starts)
    rows, lengths, of_item = [], [], []
    for k, (a, b) in enumerate(zip(first[:-1], first[1:])):
        for i in range(a, max(b - window, a) + 1) if b > a else ():
            n = min(window, b - i)
            rows.append(np.append(number[i : i + n] + 1, np.zeros(window - n, np.int64)))
            lengths.append(n)
            of_item.append(k)
    if not rows:
        empty = np.zeros(0, np.int64)
        return Suffixes(hashes, words, np.zeros((0, window), ">u4"), empty, empty, np.zeros(1, np.int64), [i for i, _ in items], empty)
    windows, number = np.unique(np.array(rows), axis=0, return_inverse=True)
    number = number.reshape(-1)
    pairs = np.unique(np.stack([number, np.array(of_item)], 1), axis=0)
    length = np.zeros(len(windows), np.int64)
    length[number] = lengths
    need = np.full(len(hashes) + 1, 1 << 40)
    np.minimum.at(need, windows[:, 0], length)
    return Suffixes(
        hashes, words, windows.astype(">u4"), length, pairs[:, 1],
        np.searchsorted(pairs[:, 0], np.arange(len(windows) + 1)), [i for i, _ in items], need,
    )


def _packed(rows: np.ndarray) -> np.ndarray:
    """Rows of big-endian numbers as byte strings, which sort as the rows do."""
    return np.ascontiguousarray(rows).view(f"S{rows.shape[1] * 4}").reshape(-1)


def matches(data: np.ndarray, begin: np.ndarray, end: np.ndarray, first: np.ndarray, test: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(place, window) of every occurrence of a test window; ``first`` is each text's first word.

    The suffix array holds the places from which a window can match at all: those followed by as
    many known words of the same text as the shortest window of their first word has.
    """
    none = np.zeros(0, np.int64)
    if not len(begin) or not len(test.windows):
        return none, none
    hashed = blocks.range_hashes(blocks.prefix_sums(data), begin, end)
    near = np.minimum(np.searchsorted(test.hashes, hashed), len(test.hashes) - 1)
    number = np.where(test.hashes[near] == hashed, near + 1, 0)
    # known words from each place to the next unknown one or the end of its text
    stop = np.zeros(len(begin) + 1, bool)
    stop[:-1] = number == 0
    stop[first] = stop[-1] = True
    places = np.arange(len(begin))
    breaks = np.flatnonzero(stop)
    run = breaks[np.searchsorted(breaks, places, side="right")] - places
    run[number == 0] = 0
    suffix = places[run >= np.where(number > 0, test.need[number], 1 << 40)]
    if not len(suffix):
        return none, none
    depth = test.windows.shape[1]
    padded = np.append(number, np.zeros(depth, number.dtype)).astype(">u4")
    table = padded[suffix[:, None] + np.arange(depth)]
    table[np.arange(depth) >= run[suffix][:, None]] = 0
    keys = _packed(table)
    order = np.argsort(keys, kind="stable")
    keys, suffix = keys[order], suffix[order]
    low = np.searchsorted(keys, _packed(test.windows), side="left")
    top = test.windows.copy()
    top[np.arange(depth) >= test.lengths[:, None]] = 0xFFFFFFFF
    high = np.searchsorted(keys, _packed(top), side="right")
    counts = np.maximum(high - low, 0)
    window = np.repeat(np.arange(len(counts)), counts)
    place = suffix[np.repeat(low - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]
    raw = data.tobytes()
    same = [
        all(raw[begin[p + k] : end[p + k]] == test.words[test.windows[w, k] - 1] for k in range(test.lengths[w]))
        for p, w in zip(place.tolist(), window.tolist())
    ]
    return place[same], window[same]


_FOUND = (
    "doc_id bigint, row bigint, item_id bigint, start bigint, words bigint, from_byte bigint, to_byte bigint, n_words bigint"
)


def _search(test: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Longest matches of each text with each item, and one row without an item for each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = test.value
        for batch in batches:
            rows, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            values = blocks.texts(batch.column(2))
            for a, b in blocks.steps(values):
                data, starts = blocks.joined(values[a:b])
                data = blocks.LOWER[data]
                begin, end = blocks.spans(data, APART)
                first = np.searchsorted(begin, starts)
                place, window = matches(data, begin, end, first[:-1][np.diff(first) > 0], known)
                out = [(ids[a + i], rows[a + i], None, None, None, None, None, int(n)) for i, n in enumerate(np.diff(first))]
                if len(place):
                    counts = np.diff(known.item_at)[window]
                    item = known.item[np.repeat(known.item_at[window] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())]
                    place, length = np.repeat(place, counts), np.repeat(known.lengths[window], counts)
                    doc = np.searchsorted(first, place, side="right") - 1
                    order = np.lexsort((place, item, doc))
                    doc, item, place, length = doc[order], item[order], place[order], length[order]
                    new = np.ones(len(doc), bool)  # a match goes on while windows touch
                    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (place[1:] > place[:-1] + length[:-1])
                    at = np.flatnonzero(new)
                    until = np.maximum.reduceat(place + length, at)
                    for d, i, p, q in zip(doc[at].tolist(), item[at].tolist(), place[at].tolist(), until.tolist()):
                        out.append(
                            (ids[a + d], rows[a + d], known.item_ids[i], p - int(first[d]), q - p,
                             int(begin[p] - starts[d]), int(end[q - 1] - starts[d]), None)
                        )
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [c.split()[0] for c in _FOUND.split(", ")])

    return run


def test_passes(benchmark: DataFrame, window: int) -> Iterator[Broadcast]:
    """The windows of the test items, broadcast in passes of about ``PASS_BYTES`` of text."""
    spark = benchmark.sparkSession
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = int(size // PASS_BYTES) + 1
    chosen = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))
    for k in range(passes):
        found = [(r["item_id"], r["text"].encode()) for r in items.filter(chosen == k).collect()]
        if found or not k:
            yield spark.sparkContext.broadcast(suffixes_of(sorted(set(found)), window))


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Matches of ``window`` words or more: doc_id, row, item_id, start and words, bytes from and to.

    ``row`` tells repeated doc_ids apart. Each row of ``docs`` also gives a row without an item,
    which holds its number of words.
    """
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = None
    for test in test_passes(benchmark, window):
        found = keyed.mapInArrow(_search(test), _FOUND)
        out = found if out is None else out.unionByName(found.filter("item_id IS NOT NULL"))
    return out


def decontamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """What of each document occurs in the benchmark.

    doc_id, row, n_words, n_hit (words inside any occurrence), n_items, item_ids (sorted as
    strings) and contaminated. Null and empty texts have no words; benchmark rows without an id,
    text or words are no items; repeated items and documents count each; an empty benchmark hits
    nothing.
    """
    found = longest_matches(docs, benchmark, window)
    by_start = W.partitionBy("doc_id", "row").orderBy(F.col("start").asc_nulls_first(), "words")
    reach = F.max(F.col("start") + F.col("words")).over(by_start.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.col("start") + F.col("words") - F.greatest(F.col("start"), F.coalesce("_reach", F.lit(0)))
    counted = found.withColumn("_reach", reach).withColumn("_fresh", F.greatest(fresh, F.lit(0)))
    return counted.groupBy("doc_id", "row").agg(
        F.max("n_words").alias("n_words"),
        F.coalesce(F.sum("_fresh"), F.lit(0)).alias("n_hit"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
    ).select("doc_id", "row", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"), "item_ids", (F.col("n_hit") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows in which any window of the benchmark occurs; nothing is shuffled."""
    for test in test_passes(benchmark, window):
        docs = docs.mapInArrow(_without_hits(test, docs.columns.index("text")), docs.schema)
    return docs


def _without_hits(test: Broadcast, column: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = blocks.texts(batch.column(column))
            for a, b in blocks.steps(values):
                data, starts = blocks.joined(values[a:b])
                data = blocks.LOWER[data]
                begin, end = blocks.spans(data, APART)
                first = np.searchsorted(begin, starts)
                place, _ = matches(data, begin, end, first[:-1][np.diff(first) > 0], test.value)
                clean = np.ones(b - a, bool)
                clean[np.searchsorted(first, place, side="right") - 1] = False
                yield batch.slice(a, b - a).filter(pa.array(clean))

    return run


def op7_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = (
        f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), "
        "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    )
    return f"""
    WITH docs AS (SELECT doc_id, {words} AS w FROM documents),
    items AS (SELECT item_id, {words} AS w FROM benchmark),
    tests AS (
      SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, unnest(list_transform(
        range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1), lambda i: array_to_string(w[i:i + {WINDOW - 1}], ' '))) AS gram
      FROM items WHERE len(w) > 0
    ), sizes AS (SELECT DISTINCT n FROM tests),
    places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM docs, sizes),
    grams AS (SELECT doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS gram FROM places),
    hits AS (SELECT doc_id, item_id, pos, n FROM grams JOIN tests USING (n, gram)),
    hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hits) GROUP BY doc_id),
    hit_items AS (
      SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)"""


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = decontamination(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
    return done.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )
