"""Suffix order and common prefixes of one shard by external induced sorting.

Priority queues that spill sorted runs to disk carry suffix tuples (first symbol, rank of what induced it, position);
common-prefix values are carried along the order. LMS substrings are sorted and named, equal names recurse on the string of
names, and its order induces all L-type and then all S-type suffixes.

This is the method named for operator 7. It orders a single shard, so it can't stand on the operator's path (README: figures);
tests compare the operator with it. Memory is bounded by the queues' limit and the shard's symbols.
"""

from __future__ import annotations

import heapq
import struct
import tempfile
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence

_ROW = struct.Struct("<qqq")


class DiskQueue:
    """A priority queue of integer triples; beyond `limit` in memory they go to disk as sorted runs."""

    def __init__(self, limit: int = 1 << 20, folder: str | None = None) -> None:
        self.limit, self.folder = limit, folder
        self.heap: list[tuple[int, int, int]] = []
        self.heads: list[tuple[tuple[int, int, int], int]] = []
        self.runs: list[Iterator[tuple[int, int, int]]] = []

    def push(self, item: tuple[int, int, int]) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self.heap.sort()
            self._spill(self.heap)
            self.heap = []

    def _spill(self, rows: Iterable[tuple[int, int, int]]) -> None:
        run = _written(rows, self.folder)
        self.runs.append(run)
        head = next(run, None)
        if head is not None:
            heapq.heappush(self.heads, (head, len(self.runs) - 1))

    def peek(self) -> tuple[int, int, int] | None:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple[int, int, int]:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            item, k = heapq.heappop(self.heads)
            head = next(self.runs[k], None)
            if head is not None:
                heapq.heappush(self.heads, (head, k))
            return item
        return heapq.heappop(self.heap)


def _written(rows: Iterable[tuple[int, int, int]], folder: str | None) -> Iterator[tuple[int, int, int]]:
    """Rows through an unlinked temporary file: it is gone when the last reader is."""
    f = tempfile.TemporaryFile(dir=folder)  # noqa: SIM115
    for r in rows:
        f.write(_ROW.pack(*r))
    f.seek(0)

    def read() -> Iterator[tuple[int, int, int]]:
        with f:
            while block := f.read(_ROW.size << 12):
                yield from _ROW.iter_unpack(block)

    return read()


class _Minima:
    """Minimum of the values put since a mark, by a stack of suffix minima."""

    def __init__(self) -> None:
        self.at: list[int] = []
        self.value: list[int] = []
        self.n = 0

    def put(self, v: int) -> None:
        while self.value and self.value[-1] >= v:
            self.value.pop()
            self.at.pop()
        self.value.append(v)
        self.at.append(self.n)
        self.n += 1

    def since(self, mark: int) -> int:
        return self.value[bisect_left(self.at, mark)]


def suffixes(text: Sequence[int], limit: int = 1 << 20, folder: str | None = None) -> tuple[list[int], list[int]]:
    """(order, lcp): all suffixes in order, and each one's common prefix with the one before. Symbols are non-negative."""
    n = len(text)
    if n < 2:
        return list(range(n)), [0] * n
    small = [False] * n  # S-type; past the end is a symbol less than all, so the last suffix is L-type
    for i in range(n - 2, -1, -1):
        small[i] = text[i] < text[i + 1] or (text[i] == text[i + 1] and small[i + 1])
    lms = [i for i in range(1, n) if small[i] and not small[i - 1]]

    def common(a: int, b: int, known: int = 0) -> int:
        while a + known < n and b + known < n and text[a + known] == text[b + known]:
            known += 1
        return known

    # order of the LMS suffixes: sort and name their substrings, recurse on the names
    ends = [*lms[1:], n - 1]
    # of equal symbols an L-type one is less; past the end comes what is less than all
    piece = lambda k: (*[2 * text[i] + small[i] for i in range(lms[k], ends[k] + 1)], *[-1] * (k == len(lms) - 1))
    by_piece = sorted(range(len(lms)), key=piece)
    names, last, name = [0] * len(lms), None, -1
    for k in by_piece:
        p = piece(k)
        name += p != last
        last, names[k] = p, name
    if name + 1 == len(lms):
        order, shared = by_piece, [0] * len(lms)
    else:
        order, shared = suffixes(names, limit, folder)
    seeds, seed_lcp = [lms[k] for k in order], []
    for r, k in enumerate(order):
        if not r:
            seed_lcp.append(0)
            continue
        j, same = order[r - 1], shared[r]
        known = (lms[k + same] if k + same < len(lms) else n) - lms[k]
        other = (lms[j + same] if j + same < len(lms) else n) - lms[j]
        seed_lcp.append(common(lms[k], lms[j], min(known, other)))

    def induce(up: bool, given: list[int], given_lcp: list[int]) -> tuple[list[int], list[int]]:
        """Suffixes of the other type, in (reverse) order, and their common prefixes with the one induced before them."""
        queue, out, out_lcp = DiskQueue(limit, folder), [], []
        minima, mark, rank = _Minima(), {}, 0
        sign = 1 if up else -1
        step, before, chain = 0, None, {}

        def take(i: int, lcp: int) -> None:
            nonlocal rank, step
            minima.put(lcp)
            step += 1
            if i and small[i - 1] != up:
                queue.push((sign * text[i - 1], rank, i - 1))
                # common prefix with the suffix induced into this symbol's bucket before it
                chain[i - 1] = 1 + minima.since(mark[text[i - 1]]) if text[i - 1] in mark else 0
                mark[text[i - 1]] = step
            rank += 1

        if up:  # the empty suffix, before all others, induces the last one
            queue.push((text[n - 1], -1, n - 1))
            chain[n - 1], mark[text[n - 1]] = 0, 0
        g, prev_given = 0, None
        while True:
            top = queue.peek()
            if g < len(given) and (top is None or sign * text[given[g]] < top[0]):
                i = given[g]
                lcp = 0 if before is None else given_lcp[g] if prev_given == before else common(before, i)
                prev_given = i
                g += 1
            elif top is not None:
                i = queue.pop()[2]
                lcp = chain.pop(i) if out and text[out[-1]] == text[i] else 0
                out.append(i)
                out_lcp.append(lcp)
                if before is not None and before != (out[-2] if len(out) > 1 else None):
                    lcp = common(before, i)
            else:
                return out, out_lcp
            take(i, lcp)
            before = i

    large, large_lcp = induce(True, seeds, seed_lcp)
    back = large[::-1]
    back_lcp = [0, *large_lcp[:0:-1]]
    low, low_lcp = induce(False, back, back_lcp)
    low_up, low_lcp_up = low[::-1], [0, *low_lcp[:0:-1]]
    sa, lcp, a, b = [], [], 0, 0
    while a < len(large) or b < len(low_up):
        if b == len(low_up) or (a < len(large) and text[large[a]] <= text[low_up[b]]):
            i, same, follows = large[a], large_lcp[a], a and sa[-1] == large[a - 1]
            a += 1
        else:
            i, same, follows = low_up[b], low_lcp_up[b], b and sa[-1] == low_up[b - 1]
            b += 1
        lcp.append(same if follows else common(sa[-1], i) if sa else 0)
        sa.append(i)
    return sa, lcp


def repeated_bytes(texts: Sequence[bytes], length: int, limit: int = 1 << 20, folder: str | None = None) -> list[list[tuple[int, int]]]:
    """Of each text the maximal runs of bytes that lie in a string of `length` bytes which also starts elsewhere."""
    symbols: list[int] = []
    begin = []
    for k, t in enumerate(texts):
        begin.append(len(symbols))
        symbols += [c + len(texts) for c in t]
        symbols.append(k)  # a separator of its own: no match goes over it
    sa, lcp = suffixes(symbols, limit, folder)
    hit = sorted({i for r, i in enumerate(sa) if lcp[r] >= length or (r + 1 < len(sa) and lcp[r + 1] >= length)})
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    k = 0
    for i in hit:
        while k + 1 < len(begin) and begin[k + 1] <= i:
            k += 1
        x, y = i - begin[k], i - begin[k] + length
        if out[k] and out[k][-1][1] >= x:
            out[k][-1] = (out[k][-1][0], y)
        else:
            out[k].append((x, y))
    return out
