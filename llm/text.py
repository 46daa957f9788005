"""Vectorised text primitives for tasks: Arrow strings in, numpy arrays out.

A batch is cut into chunks of a few MB of whole documents, so that the numpy temporaries of a task stay
small; a single document larger than that is a chunk of its own.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
WINDOW = 5

_RNG = np.random.Generator(np.random.PCG64(20240601))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_MULT = _RNG.integers(1, 1 << 63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_RNG.integers(1, 1 << 62)) * 2 + 1
_SHORT = np.uint64(_RNG.integers(1, 1 << 63))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept from call to call."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        made = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if n > 4 * CHUNK_BYTES:  # a giant document's tables are not kept
            return made
        _powers = made
    return _powers


def release() -> None:
    """Hand freed memory back at the end of a task: workers that wait for their next task then hold little."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


#: What the tasks of an operator keep in a worker for its next task, by operator.
_kept: dict[str, dict] = {}


def kept(owner: str) -> dict:
    """A dictionary that stays in the worker until a task of another operator begins there."""
    return _kept.setdefault(owner, {})


def alone(owner: str | None = None) -> None:
    """At the start of a task: what other operators have kept goes, as a worker is used by one after the other (words of packing: 300 MB)."""
    others = [d for name, d in _kept.items() if name != owner and d]
    for d in others:
        d.clear()
    if others:
        gc.collect()
        release()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow string or binary column, and where each begins and ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buf = column.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of up to limit bytes together."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, space_table: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of each document's first word (one more at the end).

    space_table says of each byte whether it separates words.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    space = space_table[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = edge[:n].copy()
    before[0] = True
    before[1:] |= space[:-1]
    after = edge[1:].copy()
    after[-1] = True
    after[:-1] |= space[1:]
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(after & ~space) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for every pair: differences of one polynomial prefix sum."""
    up, down = powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _SHORT)


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the 5-word windows of each document in order, and where each document's begin.

    A document of one to four words has one shingle, its whole sequence; one without words has none.
    """
    starts, ends, first = words(data, offsets)
    n = len(starts)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    h = spans_hash(data, starts, ends)
    total = np.zeros(n, np.uint64)
    for t in range(WINDOW):
        if n > t:
            total[: n - t] += h[t:] * _MULT[t]
    size = np.diff(first)
    short = np.flatnonzero((size > 0) & (size < WINDOW))
    at = first[short]
    own = size[short].astype(np.uint64) * _SHORT
    for t in range(WINDOW - 1):
        has = size[short] > t
        own[has] += h[at[has] + t] * _MULT[t]
    total[at] = own
    keep = np.ones(n, bool)
    for t in range(1, WINDOW):
        keep[first[1:][size >= t] - t] = False
    keep[at] = True
    counts = np.where(size >= WINDOW, size - WINDOW + 1, np.minimum(size, 1))
    return mix(total[keep]), np.concatenate(([0], np.cumsum(counts)))


def distinct(values: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of each document sorted and without repeats, and where each document's begin."""
    if not len(values):
        return values, np.zeros(len(ptr), np.int64)
    doc = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    order = np.lexsort((values, doc))
    v, d = values[order], doc[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    v, d = v[keep], d[keep]
    return v, np.searchsorted(d, np.arange(len(ptr)))
