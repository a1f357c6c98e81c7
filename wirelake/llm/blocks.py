"""Words and hashes of many texts at once, in numpy, for the operators that work inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence, Sized

import numpy as np
import pyarrow as pa

#: Bytes of text that one step of array work takes; a longer text is a step of its own.
STEP_BYTES = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def separators(chars: bytes) -> np.ndarray:
    """True for the byte values that are no part of a word."""
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


SPACE = separators(b" \t\n\x0b\x0c\r")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def texts(column: pa.Array) -> list[bytes]:
    """The column's values as bytes; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def release() -> None:
    """Give memory that is free within this process back to the machine; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries give it back by themselves
    if trim is not None:
        trim(0)


def pieces(values: list[bytes], overlap: int, limit: int = STEP_BYTES) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Texts cut every ``limit`` bytes, each piece with ``overlap`` bytes of the next; whose and from where.

    A string of up to ``overlap + 1`` bytes lies whole in the piece that it starts in.
    """
    out, whose, offset = [], [], []
    for i, value in enumerate(values):
        for start in range(0, max(len(value) - overlap, 1), limit):
            out.append(value if len(value) <= limit + overlap else value[start : start + limit + overlap])
            whose.append(i)
            offset.append(start)
            if len(value) <= limit + overlap:
                break
    return out, np.array(whose, np.int64), np.array(offset, np.int64)


def steps(values: Sequence[Sized], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts that together have up to ``limit`` bytes, or one text."""
    start = size = 0
    for i, value in enumerate(values):
        if i > start and size + len(value) > limit:
            yield start, i
            start, size = i, 0
        size += len(value)
    if start < len(values):
        yield start, len(values)


def joined(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in a row, each text followed by a line feed, and where each text starts."""
    data = np.frombuffer(b"\n".join([*values, b""]), np.uint8)
    starts = np.zeros(len(values) + 1, np.int64)
    np.cumsum([len(v) + 1 for v in values], out=starts[1:])
    return data, starts


def spans(data: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data``; ``data`` ends with a separator, as joined() makes it."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = ~apart[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, kept between calls up to a step's size."""
    if len(_powers[0]) < n:
        size_kept = STEP_BYTES + (1 << 16)
        size = max(n, size_kept)
        made = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        if n > size_kept:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0], _powers[1]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of byte times power before each place: any range's hash is a difference of two."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The 64-bit hash of each byte range, wherever it lies."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
