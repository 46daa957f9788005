"""Operator 8: packing documents into fixed windows, in order, by dynamic programming.

Each input partition is read in order, as runs of RUN tokens or a little more, ended by the end of a document. Cuts may fall after a document
(free), after a sentence (a small penalty) or inside a sentence (a larger one, at every STEP tokens). The windows of a run have the least padding
plus penalties of all ways to cut it there. With token positions t,
best[j] = penalty[j] + size - t[j] + min(best[i] + t[i]) over i with t[j] - t[i] <= size: the minimum over a moving window,
kept in a monotone queue, so time is linear in the number of possible cuts.

So a window may be left short in the middle of a run where that saves more in penalties than the padding costs, and the last one of a run is
short. As filling windows up costs less than STEP tokens of padding and INSIDE of penalty a window, padding stays under (STEP + INSIDE) / size,
3.2 %, and one window a run (2048 windows and more, or a partition's end); on prose it is about 0.5 %. The sum counts every short window, also
one whose length is a power of two. A task holds one run, of whose optimum no part is certain before its end.

Partitions are packed apart, without a shuffle, so a table that is split otherwise is packed otherwise: hold the splits (or sort and
repartition, as the pipeline does) where the same windows are wanted again.

Defined cases: a null text is empty and gives only the end token; repeated rows are documents of their own; documents longer
than a window or than a run, however long, are encoded whole and cut as often as needed; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import gc
import os
import re
from collections import deque
from collections.abc import Iterator, Sequence
from itertools import batched, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import text as T
from llm.common import small_batches

WINDOW, END = 4096, 2
SENTENCE, INSIDE, STEP = 4, 64, 64
RUN = 1 << 23
MEMO, PARTS = 900_000, 900_000
#: A word of letters and trailing ASCII marks: the vocabulary splits it there, and lowers the letters one by one.
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_LETTERS = re.compile(r"[^\W\d_]+")


class WordTokens:
    """Token ids of texts, word by word: this vocabulary's words never merge across white space.

    The ids of up to MEMO different words and of PARTS of words are kept; when there are more the memory starts anew.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts: dict[bytes, bytes] = {b"": b""}
        self.clear()

    def clear(self) -> None:
        self.at: dict[bytes, int] = {b" ": 0}  # a space is no word: it stands for the end of a document
        self.flat, self.used = np.array([END], np.uint32), 1
        self.first, self.size, self.stop = np.zeros(1, np.int64), np.ones(1, np.int64), np.ones(1, bool)

    def _encode_parts(self, parts: list[bytes]) -> None:
        """Ids of new parts: many are encoded as one text, and tokens go to parts by their offsets."""
        if len(self.parts) + len(parts) > PARTS:
            self.parts = {b"": b""}
        special = [p for p in parts if b"<|" in p]
        plain = [p for p in parts if b"<|" not in p] if special else parts
        for p in special:
            self.parts[p] = np.array(self.tokenizer.encode(p.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4").tobytes()
        groups = [plain[i : i + 256] for i in range(0, len(plain), 256)]
        texts = [b" ".join(g).decode("utf-8", "replace") for g in groups]
        for group, text, e in zip(groups, texts, self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, "<u4").tobytes()
            begin = np.cumsum([0, *[len(p) + 1 for p in text.split(" ")]])  # in characters
            cut = (4 * np.searchsorted(np.array([o[0] for o in e.offsets], np.int64), begin)).tolist()
            for p, x, y in zip(group, cut, cut[1:], strict=False):
                self.parts[p] = ids[x:y]

    def learn(self, words: list[bytes]) -> None:
        split = []
        for w in words:
            core = w.rstrip(_MARKS)
            if core.isalpha():
                split.append((core.lower(), w[len(core) :]))
            elif core.isascii():
                split.append((w, b""))
            else:
                t = core.decode("utf-8", "replace")
                plain = _LETTERS.fullmatch(t) and "\u03a3" not in t
                split.append((t.lower().encode(), w[len(core) :]) if plain else (w, b""))
        new = {p for pair in split for p in pair if p not in self.parts}
        if new:
            self._encode_parts(list(new))
            missing = [p for pair in split for p in pair if p not in self.parts]
            if missing:  # the memory was begun anew
                self._encode_parts(list(set(missing)))
        of = self.parts
        ids = [of[a] + of[b] for a, b in split]
        n = len(self.size)
        self.at.update(zip(words, range(n, n + len(words)), strict=True))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        if self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate((self.flat[: self.used], np.empty(self.used + len(flat), np.uint32)))
        self.flat[self.used : self.used + len(flat)] = flat
        self.first = np.concatenate((self.first, self.used + np.cumsum(sizes) - sizes))
        self.used += len(flat)
        self.size = np.concatenate((self.size, sizes))
        self.stop = np.concatenate((self.stop, np.fromiter((w[-1] in b".!?" for w in words), bool, len(words))))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, each with END; the end of each text; the ends of their sentences."""
        words: list[bytes] = []
        ends = []
        for t in texts:
            words += t.split()
            words.append(b" ")
            ends.append(len(words))
        at = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(at < 0)
        missed = [words[i] for i in unknown.tolist()]
        new = list(set(missed))
        if len(self.at) + len(new) > MEMO:
            self.clear()
            unknown, missed = np.arange(len(words)), words
            new = [w for w in set(words) if w != b" "]
        if new:
            self.learn(new)
            at[unknown] = np.fromiter(map(self.at.__getitem__, missed), np.int64, len(missed))
        size = self.size[at]
        total = np.concatenate(([0], np.cumsum(size)))
        ids = self.flat[np.repeat(self.first[at] - total[:-1], size) + np.arange(total[-1])]
        return ids, total[ends], total[1:][self.stop[at]]


_made: dict[str, WordTokens] = T.kept("packing")


def word_tokens(path: str) -> WordTokens:
    if path not in _made:
        _made[path] = WordTokens(path)
    return _made[path]


def best_cuts(t: list[int], penalty: list[int], size: int) -> list[int]:
    """Indices of the cuts of least cost; t[0] = 0 is the start, the last index always a cut."""
    back = [0] * len(t)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (best + t, index), increasing: the first is the least in reach
    for j in range(1, len(t)):
        while t[j] - t[queue[0][1]] > size:
            queue.popleft()
        least, back[j] = queue[0]
        value = least + penalty[j] + size  # best[j] + t[j]
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j))
    cuts, j = [], len(t) - 1
    while j > 0:
        cuts.append(j)
        j = back[j]
    return cuts[::-1]


def candidates(length: int, doc_ends: np.ndarray, sentence_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a run of tokens may be cut, with their penalties; none is more than STEP after the one before."""
    cost = {0: 0, length: 0}
    points = np.unique(np.concatenate(([0, length], doc_ends, sentence_ends)))
    gaps = np.diff(points)
    more = [np.arange(points[i] + STEP, points[i + 1], STEP) for i in np.flatnonzero(gaps > STEP)]
    t = np.unique(np.concatenate([points, *more])).astype(np.int64)
    penalty = np.full(len(t), INSIDE, np.int64)
    penalty[np.searchsorted(t, sentence_ends)] = SENTENCE
    penalty[np.searchsorted(t, doc_ends)] = 0
    for p, c in cost.items():
        penalty[np.searchsorted(t, p)] = c
    return t, penalty


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, run_tokens: int = RUN) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids (binary, little-endian uint32), doc_tokens, sequence_id, offset."""
    small_batches(docs.sparkSession)
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def solved(docs: list, held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], number: int) -> Iterator[tuple]:
        """Pieces of a run's windows, the first of them with the given number; held: ids, ends of documents and of sentences."""
        begin = np.cumsum([0, *[len(ids) for ids, _, _ in held]])
        ids = np.concatenate([h[0] for h in held])
        ends = np.concatenate([h[1] + b for h, b in zip(held, begin, strict=False)])
        stops = np.concatenate([h[2] + b for h, b in zip(held, begin, strict=False)])
        t, penalty = candidates(len(ids), ends, stops)
        cuts = t[best_cuts(t.tolist(), penalty.tolist(), window)]
        begins, ends, lo, k = np.concatenate(([0], ends[:-1])).tolist(), ends.tolist(), 0, 0
        for cut in cuts.tolist():
            at = lo
            while at < cut:
                hi = min(cut, ends[k])
                yield docs[k], at - begins[k], hi - at, ids[at:hi].astype("<u4").tobytes(), ends[k] - begins[k], number, at - lo
                at = hi
                k += hi == ends[k]
            lo, number = cut, number + 1

    def batch(pieces: Sequence[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*pieces, strict=True), kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.alone("packing")
        tokens = word_tokens(tokenizer_path)
        was = gc.isenabled()
        gc.disable()  # nothing here makes cycles, and the memory of words is large
        try:
            number, size = TaskContext.get().partitionId() << 32, 0
            docs_, held = [], []

            def out() -> Iterator[pa.RecordBatch]:
                nonlocal number
                for pieces in batched(solved(docs_, held, number), 1000):
                    number = pieces[-1][5] + 1
                    yield batch(pieces)

            for b in batches:
                data, offsets = T.utf8(b.column(1))
                for lo, hi in T.chunks(offsets):
                    names_, (ids, ends, stops) = b.column(0).slice(lo, hi - lo).to_pylist(), tokens.encode([data[offsets[i] : offsets[i + 1]].tobytes() for i in range(lo, hi)])
                    while len(ends) and size + ends[-1] >= run_tokens:  # the run ends with the first document that fills it
                        k = int(np.searchsorted(ends, run_tokens - size))
                        cut, n = int(ends[k]), int(np.searchsorted(stops, ends[k], "right"))
                        held.append((ids[:cut], ends[: k + 1], stops[:n]))
                        docs_ += names_[: k + 1]
                        yield from out()
                        docs_, held, size = [], [], 0
                        names_, ids, ends, stops = names_[k + 1 :], ids[cut:], ends[k + 1 :] - cut, stops[n:] - cut
                    if len(ends):
                        held.append((ids, ends, stops))
                        docs_ += names_
                        size += len(ids)
            if held:
                yield from out()
        finally:  # the worker is used again
            if was:
                gc.enable()
            docs_, held = [], []
            T.release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
