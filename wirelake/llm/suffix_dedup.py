"""Repeated byte strings across documents, by blockwise suffix sorting.

The suffixes worth sorting are those that begin a string of ``span`` bytes found in two
documents. They are dealt into suffix buckets: the least hash among the ``GRAM``-byte pieces of a
suffix's first ``span`` bytes is its anchor, and equal strings have equal anchors at equal
distances, so suffixes need only be compared within a bucket of (anchor, distance). Anchors seen
in one document alone are dropped before any text moves. For the others a task gets the bytes
around each occurrence, once per group of documents, and sorts one bucket at a time: first by the
bytes up to the next cover position, then, where those tie, by the precomputed rank of the text
that begins there. Cover positions lie every ``PERIOD`` bytes around the anchor; suffixes of one
bucket have the same phase, so a single residue is a difference cover for them. Neighbours in
this order that agree in ``span`` bytes are the repeats.

Documents are shuffled once, into groups by doc_id; anchors, texts around them and answers travel
between groups and bucket tasks in packed arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wirelake.llm import blocks, common

SPAN, GRAM, PERIOD = 50, 20, 16
#: Bytes of text per group of documents and per bucket task.
GROUP_BYTES = 4 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Anchors:
    """The anchors of some texts: where, and for which starts of strings they are the anchor."""

    key: np.ndarray  # hash of the anchor's bytes
    doc: np.ndarray  # number of the text
    low: np.ndarray  # least and greatest distance from the start of a string to the anchor
    high: np.ndarray
    around: np.ndarray  # bytes that strings with this anchor cover, zero elsewhere
    place: np.ndarray  # byte of the anchor within its text


def _reach(span: int) -> tuple[int, int]:
    return span - GRAM, 2 * span - GRAM  # greatest distance, width of the bytes around


def anchors(texts: list[bytes], span: int, wanted: np.ndarray | None, around: bool) -> Anchors:
    """The anchors of all ``span``-byte strings of the texts; of sorted ``wanted`` keys, if given."""
    far, width = _reach(span)
    parts: list[tuple[np.ndarray, ...]] = []
    texts, whose, offset = blocks.pieces(texts, span - 1, blocks.STEP_BYTES)  # a string belongs to the piece that it starts in
    for a, b in blocks.steps(texts, blocks.STEP_BYTES + span):
        data, starts = blocks.joined(texts[a:b])
        n = len(data)
        if n <= span:
            continue
        sums = blocks.prefix_sums(data)
        _, down = blocks.powers(n + 1)
        raw = (sums[GRAM:] - sums[:-GRAM]) * down[: n + 1 - GRAM]
        least = ((raw * _ODD) >> np.uint64(32) << np.uint64(32)) | np.arange(len(raw), dtype=np.uint64)
        count, step = far + 1, 1  # pieces in a string; doubling takes the least of 2, 4, ... of them
        while step * 2 <= count:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < count:
            least = np.minimum(least[: len(least) - (count - step)], least[count - step :])
        size = np.diff(starts) - 1
        valid = np.zeros(n + 1, np.int32)  # starts of strings that end within their text
        long = size >= span
        valid[starts[:-1][long]] = 1
        valid[(starts[:-1] + size - span + 1)[long]] -= 1
        at = np.flatnonzero(np.cumsum(valid)[: len(least)])
        if not len(at):
            continue
        anchor = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        where = anchor[first]
        key = blocks.mix(raw[where])
        low, high = where - at[last], where - at[first]
        if wanted is not None:
            near = np.minimum(np.searchsorted(wanted, key), max(len(wanted) - 1, 0))
            keep = wanted[near] == key if len(wanted) else np.zeros(len(key), bool)
            key, where, low, high = key[keep], where[keep], low[keep], high[keep]
        doc = np.searchsorted(starts, where, side="right") - 1
        if around:
            padded = np.concatenate([np.zeros(far, np.uint8), data, np.zeros(span, np.uint8)])
            text = np.lib.stride_tricks.sliding_window_view(padded, width)[where]
            column = np.arange(width)
            for rows in _slices(len(text)):
                text[rows][(column < (far - high[rows])[:, None]) | (column >= (width - low[rows])[:, None])] = 0
        else:
            text = np.zeros((len(key), 0), np.uint8)
        parts.append((key, whose[doc + a], low, high, text, where - starts[doc] + offset[doc + a]))
    if not parts:
        none = np.zeros(0, np.int64)
        return Anchors(none.astype(np.uint64), none, none, none, np.zeros((0, width if around else 0), np.uint8), none)
    return Anchors(*[np.concatenate(p) for p in zip(*parts)])


def _slices(n: int, size: int = 1 << 15) -> list[slice]:
    """Rows in slices, for steps that need many times the rows' memory."""
    return [slice(i, i + size) for i in range(0, n, size)]


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


@dataclass
class Group:
    """One group's documents, and what the side input says about them."""

    texts: list[bytes]
    ids: np.ndarray
    first: np.ndarray  # the first document with its text, and long enough to hold a string

    @classmethod
    def of(cls, docs: pa.Table, side: pa.Table, span: int) -> Group:
        texts, ids = docs["text"].to_pylist(), docs["doc_id"].to_numpy()
        known = _kind(side, 0)
        firsts = set(zip(known["a"].to_pylist(), known["data"].to_pylist()))
        first = [len(t) >= span and (i, hashlib.md5(t).digest()) in firsts for i, t in zip(ids.tolist(), texts)]
        return cls(texts, ids, np.array(first, bool))

    def anchors(self, span: int, wanted: np.ndarray | None, around: bool) -> Anchors:
        where = np.flatnonzero(self.first)
        found = anchors([self.texts[i] for i in where], span, wanted, around)
        found.doc = where[found.doc] if len(found.doc) else found.doc
        return found


def _distinct(found: Anchors, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences with equal bytes around: their order, the first of each, and its least doc_id."""
    weights = blocks.powers(found.around.shape[1])[0][: found.around.shape[1]]
    sums = np.zeros(len(found.key), np.uint64)
    for rows in _slices(len(sums)):
        sums[rows] = found.around[rows].astype(np.uint64) @ weights
    tag = blocks.mix(sums + (found.low * 64 + found.high).astype(np.uint64) * _ODD)
    order = np.lexsort((tag, found.key))
    key, reach = found.key[order], (found.low * 64 + found.high)[order]
    new = np.ones(len(order), bool)
    new[1:] = (key[1:] != key[:-1]) | (reach[1:] != reach[:-1])
    for rows in _slices(len(order) - 1):
        text = found.around[order[rows.start : rows.stop + 1]]
        new[1:][rows] |= (text[1:] != text[:-1]).any(1)
    first = np.flatnonzero(new)
    least = np.minimum.reduceat(ids[found.doc[order]], first) if len(first) else np.zeros(0, np.int64)
    return order, first, least


_SIDE = "g bigint, kind int, a bigint, data binary"
_OUT = "bucket bigint, g bigint, data binary, more binary"
_DONE = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, text string"
_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}


def _table(rows: list[tuple], columns: str) -> pa.Table:
    """Rows as a table with the columns of a Spark schema."""
    fields = [c.split() for c in columns.split(", ")]
    values = zip(*rows) if rows else [()] * len(fields)
    return pa.table({name: pa.array(v, _ARROW[kind]) for (name, kind), v in zip(fields, values)})


def _kind(side: pa.Table, kind: int) -> pa.Table:
    return side.filter(pc.equal(side["kind"], kind))


def _cut_up(bucket: np.ndarray, buckets: int):
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        yield int(b), slice(cuts[b], cuts[b + 1])


def _send_keys(docs: pa.Table, side: pa.Table, span: int, buckets: int) -> pa.Table:
    """Each anchor hash of the group, once, by bucket; apart, those of two of its documents."""
    out = []
    if len(docs):
        g = docs["g"][0].as_py()
        found = Group.of(docs, side, span).anchors(span, None, False)
        order = np.lexsort((found.doc, found.key))
        key, doc = found.key[order], found.doc[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(key)) - 1
        twice = doc[first] != doc[last] if len(first) else np.zeros(0, bool)
        key = key[first]
        for b, part in _cut_up(_bucket(key, buckets), buckets):
            out.append((b, g, key[part][~twice[part]].tobytes(), key[part][twice[part]].tobytes()))
    return _table(out, _OUT)


def _shared_keys(rows: pa.Table) -> pa.Table:
    """To each group, its keys of this bucket that two documents have."""
    once = [np.frombuffer(d, np.uint64) for d in rows["data"].to_pylist()]
    twice = [np.frombuffer(d, np.uint64) for d in rows["more"].to_pylist()]
    value, count = np.unique(np.concatenate(once + twice + twice), return_counts=True)
    shared = value[count > 1]
    out = []
    for g, a, b in zip(rows["g"].to_pylist(), once, twice):
        mine = np.concatenate([a[np.isin(a, shared, assume_unique=True)], b])
        if len(mine):
            out.append((g, 1, 0, np.sort(mine).tobytes()))
    return _table(out, _SIDE)


def _wanted(side: pa.Table) -> np.ndarray:
    found = [np.frombuffer(d, np.uint64) for d in _kind(side, 1)["data"].to_pylist()]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _send_texts(docs: pa.Table, side: pa.Table, span: int, buckets: int) -> pa.Table:
    """The bytes around the group's shared anchors, equal ones once with the least doc_id."""
    out = []
    if len(docs):
        g = docs["g"][0].as_py()
        group = Group.of(docs, side, span)
        found = group.anchors(span, _wanted(side), True)
        order, first, least = _distinct(found, group.ids)
        pick = order[first]
        key = found.key[pick]
        head = np.stack([key.view(np.int64), least, found.low[pick], found.high[pick]], 1)
        for b, part in _cut_up(_bucket(key, buckets), buckets):
            out.append((b, g, head[part].tobytes(), found.around[pick[part]].tobytes()))
    return _table(out, _OUT)


def cover_ranks(text: np.ndarray) -> np.ndarray:
    """For each row of bytes and each cover position, the rank of the row's rest from there.

    Computed from the last position to the first, each from its ``PERIOD`` bytes and the rank of
    what follows them.
    """
    n, width = text.shape
    places = range(0, width, PERIOD)
    out = np.zeros((len(places), n), np.int64)
    after = np.zeros(n, np.int64)
    for k in reversed(range(len(places))):
        piece = np.zeros((n, PERIOD), np.uint8)
        rest = text[:, places[k] : places[k] + PERIOD]
        piece[:, : rest.shape[1]] = rest
        words = piece.view(">u8").astype(np.uint64)
        order = np.lexsort((after, words[:, 1], words[:, 0]))
        new = np.zeros(n, np.int64)
        new[1:] = (words[order[1:]] != words[order[:-1]]).any(1) | (after[order[1:]] != after[order[:-1]])
        after = np.empty(n, np.int64)
        after[order] = np.cumsum(new)
        out[k] = after
    return out


def sort_buckets(key: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray, text: np.ndarray, span: int) -> np.ndarray:
    """For each row, a bit per distance: an equal string with this anchor has a smaller doc_id."""
    far, _ = _reach(span)
    bits = np.zeros(len(key), np.uint64)
    _, number, count = np.unique(key, return_inverse=True, return_counts=True)
    several = np.flatnonzero(count[number] > 1)
    if not len(several):
        return bits
    number, doc, low, high, text = number[several], doc[several], low[several], high[several], text[several]
    ranks = cover_ranks(text)
    found = np.zeros(len(several), np.uint64)
    for distance in range(far + 1):  # one suffix bucket of each anchor at a time
        rows = np.flatnonzero((low <= distance) & (distance <= high))
        if len(rows) < 2:
            continue
        start = far - distance
        cover = -(-start // PERIOD)  # the next cover position at or behind the start
        lead = np.zeros((len(rows), PERIOD), np.uint8)
        head = cover * PERIOD - start
        lead[:, PERIOD - head :] = text[rows, start : start + head]
        words = lead.view(">u8").astype(np.uint64)
        keys = [ranks[cover][rows], words[:, 1], words[:, 0], number[rows]] if head > 8 else [ranks[cover][rows], words[:, 1], number[rows]]
        order = rows[np.lexsort(keys)]
        string = text[order, start : start + span]
        new = np.ones(len(order), bool)
        new[1:] = (number[order[1:]] != number[order[:-1]]) | (string[1:] != string[:-1]).any(1)
        first = np.flatnonzero(new)
        least = np.repeat(np.minimum.reduceat(doc[order], first), np.diff(np.append(first, len(order))))
        found[order[doc[order] > least]] |= np.uint64(1) << np.uint64(distance)
    bits[several] = found
    return bits


def _answer_texts(rows: pa.Table, span: int) -> pa.Table:
    """To each group, the keys it sent to this bucket and which strings occur earlier."""
    _, width = _reach(span)
    heads = rows["data"].to_pylist()
    head = np.concatenate([np.frombuffer(d, np.int64).reshape(-1, 4) for d in heads])
    text = np.concatenate([np.frombuffer(d, np.uint8).reshape(-1, width) for d in rows["more"].to_pylist()])
    key = np.ascontiguousarray(head[:, 0]).view(np.uint64)
    bits = sort_buckets(key, head[:, 1], head[:, 2], head[:, 3], text, span)
    cuts = np.cumsum([0, *(len(d) // 32 for d in heads)])
    out = [
        (g, 2, b, np.concatenate([key[i:j], bits[i:j]]).tobytes())
        for g, b, i, j in zip(rows["g"].to_pylist(), rows["bucket"].to_pylist(), cuts[:-1], cuts[1:])
    ]
    return _table(out, _SIDE)


def _whole_characters(text: bytes, gone: np.ndarray) -> str:
    """What is left of a text; a character that is covered in part stays."""
    data = np.frombuffer(text, np.uint8)
    lead = np.flatnonzero(data & 0xC0 != 0x80)
    if len(lead) < len(data):
        whole = np.logical_and.reduceat(gone, lead)
        gone = np.repeat(whole, np.diff(np.append(lead, len(data))))
    return data[~gone].tobytes().decode("utf-8", "replace")


def _remove(docs: pa.Table, side: pa.Table, span: int, extra: Sequence[str]) -> pa.Table:
    """The group's documents without what occurs in an earlier one, and the ``extra`` columns."""
    if not len(docs):
        done = _table([], _DONE)
        for name in extra:
            done = done.append_column(name, docs[name])
        return done
    group = Group.of(docs, side, span)
    answers = _kind(side, 2).sort_by("a")
    pairs = [np.frombuffer(d, np.uint64) for d in answers["data"].to_pylist()]
    key = np.concatenate([p[: len(p) // 2] for p in pairs]) if pairs else np.zeros(0, np.uint64)
    bits = np.concatenate([p[len(p) // 2 :] for p in pairs]) if pairs else np.zeros(0, np.uint64)
    found = group.anchors(span, np.unique(key), True)
    order, first, least = _distinct(found, group.ids)
    if len(first) != len(key) or (found.key[order[first]] != key).any():
        raise RuntimeError("a group's answers do not fit its documents")
    again = np.diff(np.append(first, len(order)))
    # of equal bytes around, all but the least document's repeat that one
    every = (np.uint64(1) << (found.high[order] + 1).astype(np.uint64)) - (np.uint64(1) << found.low[order].astype(np.uint64))
    hit = np.where(group.ids[found.doc[order]] > np.repeat(least, again), every, np.repeat(bits, again))
    sizes = np.array([len(t) for t in group.texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    place = starts[found.doc[order]] + found.place[order]
    found = None
    edges = np.zeros(int(starts[-1]) + 1, np.int32)
    far, _ = _reach(span)
    for distance in range(far + 1):
        at = place[(hit >> np.uint64(distance) & np.uint64(1)).astype(bool)] - distance
        np.add.at(edges, at, 1)
        np.add.at(edges, at + span, -1)
    covered = np.cumsum(edges, out=edges)[:-1] > 0
    out = []
    for i, text in enumerate(group.texts):
        gone = covered[starts[i] : starts[i] + sizes[i]]
        if not group.first[i] and len(text) >= span:
            removed, runs, kept, left = len(text), 1, b"", ""
        elif gone.any():
            removed, runs = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            kept, left = np.frombuffer(text, np.uint8)[~gone].tobytes(), _whole_characters(text, gone)
        else:
            removed, runs, kept, left = 0, 0, text, text.decode("utf-8", "replace")
        out.append((int(group.ids[i]), len(text), removed, runs, hashlib.sha256(kept).hexdigest(), left))
    done = _table(out, _DONE)
    for name in extra:
        done = done.append_column(name, docs[name])
    return done


def _freed(run: Callable[..., pa.Table], *args: object) -> pa.Table:
    """What a group function gives; the memory that it no longer needs goes back to the machine."""
    try:
        return run(*args)
    finally:
        blocks.release()


def _deduplicated(docs: DataFrame, span: int, carried: Sequence[str]) -> DataFrame:
    """The operator's columns, then those of ``carried`` as x0, x1 .., whatever their names and types."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(max(1, size // GROUP_BYTES))
    group = F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(parts)).alias("g")
    extra = [f"x{i}" for i in range(len(carried))]
    more = [F.col(f"`{c}`").alias(x) for c, x in zip(carried, extra)]
    given = docs.filter(F.col("doc_id").isNotNull()).select(group, F.col("doc_id").cast("bigint").alias("doc_id"), raw.alias("text"), *more)
    firsts = (
        docs.filter(F.col("doc_id").isNotNull()).filter(F.octet_length("text") >= span)
        .select(F.unhex(F.md5(raw)).alias("data"), F.col("doc_id").cast("bigint").alias("doc_id"))
        .groupBy("data").agg(F.min("doc_id").alias("doc_id"))
        .select(group, F.lit(0).alias("kind"), F.col("doc_id").alias("a"), "data")
    )

    def send_keys(d: pa.Table, s: pa.Table) -> pa.Table:
        return _freed(_send_keys, d, s, span, parts)

    def send_texts(d: pa.Table, s: pa.Table) -> pa.Table:
        return _freed(_send_texts, d, s, span, parts)

    def share(rows: pa.Table) -> pa.Table:
        return _freed(_shared_keys, rows)

    def answer(rows: pa.Table) -> pa.Table:
        return _freed(_answer_texts, rows, span)

    def remove(d: pa.Table, s: pa.Table) -> pa.Table:
        return _freed(_remove, d, s, span, extra)

    def with_docs(side: DataFrame, run, schema: str | T.StructType) -> DataFrame:
        # the same shuffle of the documents serves all three steps
        return given.groupBy("g").cogroup(side.groupBy("g")).applyInArrow(run, schema)

    shared = with_docs(firsts, send_keys, _OUT).groupBy("bucket").applyInArrow(share, _SIDE)
    texts = with_docs(firsts.unionByName(shared), send_texts, _OUT)
    answers = texts.groupBy("bucket").applyInArrow(answer, _SIDE)
    untouched = docs.filter(F.col("doc_id").isNull()).select(
        F.lit(None).cast("bigint").alias("doc_id"), F.octet_length(raw).cast("bigint").alias("n_bytes"),
        F.lit(0).cast("bigint").alias("n_removed"), F.lit(0).cast("bigint").alias("n_spans"),
        F.sha2(raw, 256).alias("kept_sha256"), F.coalesce("text", F.lit("")).alias("text"), *more,
    )
    schema = T.StructType([*T.StructType.fromDDL(_DONE).fields, *given.select(*extra).schema.fields])
    return with_docs(firsts.unionByName(answers), remove, schema).unionByName(untouched)


def suffix_dedup(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """Each document without the bytes of strings that also start in one with a smaller doc_id.

    doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of the remaining
    bytes) and text (what is left; a character that is covered in part stays whole). Null texts
    are empty. Rows without a doc_id are left as they are and no reason to remove anything; rows
    that repeat a doc_id do not remove from one another; doc_id is a whole number. Long texts are
    searched in pieces. Other columns are ignored; an empty table gives no rows.
    """
    return _deduplicated(docs, span, ())


def without_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """``docs`` with the texts of ``suffix_dedup``; null texts become empty, all other columns stay."""
    others = [c for c in docs.columns if c != "text"]
    done = _deduplicated(docs, span, others)
    place = {c: f"x{i}" for i, c in enumerate(others)}
    return done.select(*[F.col("text") if c == "text" else F.col(place[c]).alias(c) for c in docs.columns])


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op8_sql() -> str:
    """By plain slices of the bytes: every one of ``SPAN`` bytes with its first document."""
    return f"""
    WITH docs AS (SELECT doc_id, encode(coalesce(text, '')) AS b, hex(encode(coalesce(text, ''))) AS h FROM documents),
    starts AS (SELECT doc_id, b, unnest(range(0, length(h) // 2 - {SPAN} + 1)) AS p FROM docs),
    strings AS (SELECT doc_id, p, array_slice(b, p + 1, p + {SPAN}) AS s FROM starts),
    firsts AS (SELECT s, min(doc_id) AS first FROM strings GROUP BY s),
    hits AS (SELECT doc_id, p FROM strings JOIN firsts USING (s) WHERE first < doc_id),
    marked AS (
      SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + {SPAN}, true) AS fresh FROM hits),
    numbered AS (
      SELECT doc_id, p, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS k
      FROM marked),
    spans AS (SELECT doc_id, k, min(p) AS low, max(p) + {SPAN} AS high FROM numbered GROUP BY doc_id, k),
    around AS (
      SELECT doc_id, k, low, high, lag(high, 1, 0) OVER w AS before FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
    cut AS (
      SELECT doc_id, CAST(sum(high - low) AS BIGINT) AS n_removed, count(*) AS n_spans,
        string_agg(substr(h, 2 * before + 1, 2 * (low - before)), '' ORDER BY k)
          || substr(any_value(h), 2 * max(high) + 1) AS kept
      FROM around JOIN docs USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
      sha256(unhex(coalesce(kept, h))) AS kept_sha256
    FROM docs LEFT JOIN cut USING (doc_id)"""
