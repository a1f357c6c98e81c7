"""Byte-level BPE with a hierarchical-bitmap rank queue.

The pairs of a pre-token wait in buckets by merge rank; a bitmap of three levels of 64-bit words
tells the least rank that has a bucket by three find-first-set steps, whatever the length of the
pre-token. Buckets hold positions of a linked list of tokens; an entry whose position has been
merged away, or now starts another pair, is stale and skipped.

A long pre-token has a queue of its own. Short ones that have not been met before share one queue:
they lie in one linked list with bounds between them, and a bucket's leftmost position of each is
merged in one array step.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Iterator
from itertools import chain, islice
from typing import Generic, TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from wirelake.llm import blocks, common

#: Pieces of text whose ids a task remembers; of more, the half met most often; longer pieces are not kept.
REMEMBERED, REMEMBERED_CHARS = 300_000, 64
#: Bytes of text that are encoded together, of the longest pre-token that shares a queue, and of those in one queue.
STEP_BYTES, SHARED_BYTES, QUEUE_BYTES = 4 << 20, 256, 1 << 20
#: Ids that are looked up, hashed or returned at once, and pieces whose ids are.
SOME_IDS, SOME_PIECES = 1 << 19, 1 << 17
#: Texts are cut before white space that follows another character, where no match can go on ...
_CHUNKS = re.compile("[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
#: ... unless they hold white space beyond ASCII, or controls that libraries class differently.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000]")


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


B = TypeVar("B")


def _before(sizes: np.ndarray) -> np.ndarray:
    """The sum of all sizes before each place, and of all."""
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    return out


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, "<i4").tobytes()


class RankQueue(Generic[B]):
    """Buckets by merge rank; three levels of bits tell the least rank that has one."""

    def __init__(self, ranks: int):
        self.size = ranks
        self.low = [0] * ((ranks >> 6) + 1)
        self.mid = [0] * ((ranks >> 12) + 1)
        self.top = 0  # 0 if nothing waits
        self.buckets: dict[int, B] = {}

    def bucket(self, rank: int, new: Callable[[], B]) -> B:
        """The bucket of a rank, made if there is none."""
        found = self.buckets.get(rank)
        if found is None:
            found = self.buckets[rank] = new()
            self.low[rank >> 6] |= 1 << (rank & 63)
            self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
            self.top |= 1 << (rank >> 12)
        return found

    def least(self) -> int:
        a = (self.top & -self.top).bit_length() - 1
        word = self.mid[a]
        b = a << 6 | (word & -word).bit_length() - 1
        word = self.low[b]
        return b << 6 | (word & -word).bit_length() - 1

    def take(self, rank: int) -> B:
        """The bucket of a rank, which is gone then."""
        b = rank >> 6
        self.low[b] ^= 1 << (rank & 63)
        if not self.low[b]:
            self.mid[b >> 6] ^= 1 << (b & 63)
            if not self.mid[b >> 6]:
                self.top ^= 1 << (b >> 6)
        return self.buckets.pop(rank)


def _hashed(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every token, sorted, and its rank."""
    tokens = list(ranks)
    ends = np.cumsum([len(t) for t in tokens])
    sums = blocks.prefix_sums(np.frombuffer(b"".join(tokens), np.uint8))
    found = blocks.range_hashes(sums, np.concatenate([[0], ends[:-1]]), ends)
    order = np.argsort(found)
    if (np.diff(found[order]) == 0).any():
        raise ValueError("two tokens have one hash")
    return found[order], np.array([ranks[t] for t in tokens], np.int64)[order]


class Remembered(dict[str, int]):
    """Pieces of text by number, in the order they are met; the ids of all pieces lie in one array."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.fresh: list[str] = []  # pieces that have a number, but no ids yet
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.met = np.zeros(0, "<i4"), np.zeros(0, np.int64)

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self.sizes) + len(self.fresh)
        self.fresh.append(piece)
        return number

    def numbers(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, pieces), np.int32, len(pieces))

    def learn(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """The ids of all fresh pieces in a row, and how many each has."""
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
        self.fresh = []

    def ids_of(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of these pieces in a row."""
        out = [np.zeros(0, "<i4")]
        for a in range(0, len(numbers), SOME_PIECES):
            some = numbers[a : a + SOME_PIECES]
            sizes = self.sizes[some]
            ends = np.cumsum(sizes)
            out.append(self.ids[np.repeat(self.starts[some] - ends + sizes, sizes) + np.arange(ends[-1])])
        return np.concatenate(out)

    def settle(self, numbers: np.ndarray) -> None:
        """Count what was met, leave out what is not worth keeping, give new numbers if it is too much."""
        for piece in [p for p in islice(reversed(self), len(self.sizes) - len(self.met)) if len(p) > REMEMBERED_CHARS]:
            del self[piece]
        met = np.bincount(numbers, minlength=len(self.sizes))
        met[: len(self.met)] += self.met
        self.met = met
        if len(self) <= REMEMBERED and len(self.ids) <= 16 * REMEMBERED:
            return
        pieces, old = list(self), np.fromiter(self.values(), np.int64, len(self))
        best = np.sort(np.argsort(-met[old], kind="stable")[: REMEMBERED // 2])
        old, pieces = old[best], list(map(pieces.__getitem__, best.tolist()))
        ids, sizes = self.ids_of(old), self.sizes[old]
        self.forget()
        self.update(zip(pieces, range(len(pieces))))
        self.learn(ids, sizes)
        self.met = met[old] // 2  # what was met lately counts more


class Encoder:
    """Encodes and decodes by a rank table, as the ranks' own library would without special tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.bytes = pa.array(self.tokens, pa.large_binary())
        self.names = pa.array([b"%d " % rank for rank in range(len(self.tokens))], pa.large_binary())
        self.pattern = regex.compile(pattern)
        self.queue = RankQueue(len(self.tokens))  # empty again after each use
        self.hashes, self.hashed_ranks = _hashed(ranks)
        self.pieces, self.chunks = Remembered(), Remembered()

    def merge(self, token: bytes) -> list[int]:
        """The ids of one pre-token."""
        ranks = self.ranks
        if token in ranks:
            return [ranks[token]]
        n = len(token)
        queue, after, before = self.queue, list(range(1, n + 1)), list(range(-1, n))
        waits: list[int | None] = [None] * n  # the rank of the pair that starts here

        def look(at: int) -> None:
            mid = after[at]
            rank = ranks.get(token[at : after[mid]]) if mid < n else None
            waits[at] = rank
            if rank is not None:
                heapq.heappush(queue.bucket(rank, list), at)

        for i in range(n - 1):  # as look() does, for single bytes
            rank = waits[i] = ranks.get(token[i : i + 2])
            if rank is not None:
                queue.bucket(rank, list).append(i)
        while queue.top:
            rank = queue.least()
            bucket = queue.buckets[rank]
            at = heapq.heappop(bucket)
            if not bucket:
                queue.take(rank)
            if waits[at] != rank:
                continue  # stale
            gone = after[at]
            after[at] = after[gone]
            before[after[at]] = at
            waits[gone] = None
            look(at)
            if before[at] >= 0:
                look(before[at])
        out, at = [], 0
        while at < n:
            out.append(ranks[token[at : after[at]]])
            at = after[at]
        return out

    def merge_all(self, tokens: list[bytes]) -> list[bytes]:
        """The packed ids of many short pre-tokens, by one queue."""
        text = b"".join(tokens)
        n, data = len(text), np.frombuffer(text, np.uint8)
        if not n:
            return [b"" for _ in tokens]
        starts = np.cumsum([0, *map(len, tokens)])
        sums = blocks.prefix_sums(data)
        bound = np.zeros(n + 1, bool)  # where a pre-token starts
        bound[starts] = True
        owner = np.repeat(np.arange(len(tokens)), np.diff(starts))
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[n] = n
        alive = np.ones(n, bool)
        waits = np.full(n + 1, -1, np.int64)  # the rank of the pair that starts here
        queue: RankQueue[list[np.ndarray]] = RankQueue(self.queue.size)

        def look(at: np.ndarray) -> None:
            at = at[~bound[after[at]]]
            if not len(at):
                return
            rank = self._ranks_of(sums, at, after[after[at]])
            waits[at] = rank
            known = rank >= 0
            rank, at = rank[known], at[known]
            order = np.argsort(rank, kind="stable")
            rank, at = rank[order], at[order]
            cuts = np.flatnonzero(np.diff(rank, prepend=-1)).tolist()
            for i, j in zip(cuts, [*cuts[1:], len(rank)]):
                queue.bucket(int(rank[i]), list).append(at[i:j])

        look(np.arange(n))
        while queue.top:
            rank = queue.least()
            at = queue.take(rank)
            at = np.unique(np.concatenate(at)) if len(at) > 1 else np.sort(at[0])
            at = at[waits[at] == rank]  # the others are stale
            if not len(at):
                continue
            first = np.ones(len(at), bool)
            first[1:] = owner[at[1:]] != owner[at[:-1]]
            if not first.all():
                queue.bucket(rank, list).append(at[~first])
                at = at[first]
            gone = after[at]
            end = after[gone]
            after[at], before[end] = end, at
            alive[gone], waits[gone], waits[at] = False, -1, -1
            left = before[at[~bound[at]]]
            waits[left] = -1
            look(np.concatenate([at, left]))
        where = np.flatnonzero(alive)
        ids = self._ranks_of(sums, where, after[where]).astype("<i4")
        if (ids < 0).any() or self.decode(ids) != text:  # two strings with one hash
            return [_packed(self.merge(t)) for t in tokens]
        raw, cuts = ids.tobytes(), (4 * np.searchsorted(where, starts)).tolist()
        return [raw[i:j] for i, j in zip(cuts, cuts[1:])]

    def _ranks_of(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The rank of each byte range, -1 if it is no token."""
        found = blocks.range_hashes(sums, starts, ends)
        near = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        return np.where(self.hashes[near] == found, self.hashed_ranks[near], -1)

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of matches of the pattern in a row, and how many each has."""
        found: list[bytes] = [b""] * len(pieces)
        short, where = [], []
        for i, token in enumerate(map(str.encode, pieces)):
            rank = self.ranks.get(token)
            if rank is not None:
                found[i] = rank.to_bytes(4, "little")
            elif len(token) > SHARED_BYTES:
                found[i] = _packed(self.merge(token))
            else:
                short.append(token)
                where.append(i)
        for a, b in blocks.steps(short, QUEUE_BYTES):
            for i, packed in zip(where[a:b], self.merge_all(short[a:b])):
                found[i] = packed
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        return np.frombuffer(b"".join(found), "<i4"), sizes

    def forget(self) -> None:
        """Give back what was remembered; a worker process outlives its task."""
        self.chunks.forget()
        self.pieces.forget()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; each match of the pattern is merged by itself."""
        chunks, pieces = self.chunks, self.pieces
        if chunks.fresh or pieces.fresh:  # the call before this one has failed
            self.forget()
        # odd texts are one chunk; the others are cut where no match can go on
        parts = [chunks.numbers([t] if _ODD_SPACE.search(t) else _CHUNKS.findall(t)) for t in texts]
        found = list(map(self.pattern.findall, chunks.fresh))
        matches = pieces.numbers(list(chain.from_iterable(found)))
        pieces.learn(*self._learn(pieces.fresh))
        ends = np.cumsum([0, *map(len, found)])
        chunks.learn(pieces.ids_of(matches), np.diff(_before(pieces.sizes[matches])[ends]))
        numbers = np.concatenate([np.zeros(0, np.int32), *parts])
        ends = np.cumsum([0, *map(len, parts)])
        cuts = _before(chunks.sizes[numbers])[ends].tolist()
        ids = chunks.ids_of(numbers)
        pieces.settle(matches)
        chunks.settle(numbers)
        return [ids[i:j] for i, j in zip(cuts, cuts[1:])]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids: list[int] | np.ndarray) -> bytes:
        return b"".join(_joined(self.bytes, np.array(ids, np.int32), [0, len(ids)]))


def _joined(words: pa.Array, ids: np.ndarray, cuts: list[int]) -> Iterator[pa.Buffer]:
    """The words with these numbers, one after the other, of each range of ``ids`` between two cuts."""
    _, ends, data = words.take(pa.array(ids)).buffers()
    data = pa.py_buffer(b"") if data is None else data
    at = np.frombuffer(ends, np.int64)[cuts].tolist()
    return (data[i:j] for i, j in zip(at, at[1:]))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per worker process and file."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(load_ranks(path), pattern)
    return _ENCODERS[path, pattern]


_FIELDS = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def _row_values(own: Encoder, keys: pa.Array, packed: list[np.ndarray]) -> list[pa.Array]:
    """``keys`` with the counts of ids, and the digests of their numbers as text and of what they decode to."""
    cuts = np.cumsum([0, *map(len, packed)])
    together, cuts = np.concatenate(packed), cuts.tolist()
    names = [hashlib.sha256(text[:-1]).hexdigest() for text in _joined(own.names, together, cuts)]
    decoded = [hashlib.sha256(text).hexdigest() for text in _joined(own.bytes, together, cuts)]
    return [keys, pa.array([len(p) for p in packed], pa.int64()), pa.array(names), pa.array(decoded)]


def encode_column(docs: DataFrame, path: str, pattern: str, ids: bool = True) -> DataFrame:
    """``docs``' doc_id with n_tokens, ids_sha256, decoded_sha256 and, if asked for, the ids.

    Null and empty texts have no tokens; an empty table gives no rows; repeated rows are encoded
    alike. The rank file has to be on every worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks.release()  # what earlier steps of this worker have left
        own = encoder(path, pattern)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for a, b in blocks.steps(list(map(range, sizes)), STEP_BYTES):  # texts become objects a step at a time
                packed = own.encode_all([t or "" for t in batch.column(1).slice(a, b - a).to_pylist()])
                for i, j in blocks.steps(packed, SOME_IDS):
                    columns, fields = _row_values(own, batch.column(0).slice(a + i, j - i), packed[i:j]), _FIELDS
                    if ids:
                        at = np.concatenate([[0], np.cumsum(columns[1])]).astype(np.int32)
                        columns.append(pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(packed[i:j]))))
                        fields = [*_FIELDS, "ids"]
                    yield pa.RecordBatch.from_arrays(columns, fields)
        own.forget()
        blocks.release()

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_column(common.table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, ids=False)
