"""Operator 11: alignment of two tokenizers, and how often each pair of their tokens is linked in the whole corpus.

A is a byte-level vocabulary over a space and the text, B a merge-type one over the text, before which it puts that space
itself. Where a token of A and one of B end at the same byte, the text is cut into groups, and the two tokens are linked.

Both vocabularies cut a text before white space that follows a word, so words (with the white space before them) are aligned
once and remembered, joined to texts again for the libraries. A document is then a list of numbers of words. Counting and lookup:

1. Every task adds up its links as packed int64 keys (B's id above A's) with np.unique, a row for each pair of a group of
   documents. A group is what a task met with one memory of words, at most GROUP_BYTES of texts and one text more.
2. The rows are range-partitioned and sorted by key over the whole corpus, and runs of a key are summed: the count shards.
   The highest count of each B id is a table of at most one row for each id of the vocabulary.
3. The groups' keys meet the shards, range-partitioned once more: a task writes its part of the shards to a file of sorted int64
   pairs, maps it into memory and finds the groups' keys by binary search. A file is unlinked before it is filled, so nothing stays.
4. Documents, with the words of their group and the counts of its keys, are sorted by group and read in that order.

No row of the shuffles holds more than a piece of a group, and a pair that every document has is one row for each group.

Defined cases: null and empty texts, and texts whose tokens don't give back the space and the text (those that have U+2581
themselves), have no tokens: zeros and ''. Repeated rows are rows of their own and count each time; a null doc_id is kept; texts of
any length are aligned whole; strings of special tokens are plain text; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import text as T
from llm.common import materialize, partitions, small_batches
from llm.pieces import SPACE, Pieces

#: Different words a worker remembers before it begins anew; words of one joined text; texts' bytes after which a group ends.
MEMO, JOINED, GROUP_BYTES = 600_000, 256, 1 << 26
#: Words of a group in one row, keys of a row's batch.
ROWS = 20_000
_B = np.int64(32)


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes with: printable ones stand for themselves, others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Tokens, groups and links of words, with the words met so far."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.pieces = Pieces(path_b)
        of, names = byte_alphabet(), self.a.get_vocab()
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        bytes_a = {i: t.encode() if t in special else bytes(of[c] for c in t) for t, i in names.items()}
        self.bytes_a = [bytes_a.get(i, b"") for i in range(max(bytes_a) + 1)]
        self.size_a, self.size_b = np.array([len(t) for t in self.bytes_a], np.int64), self.pieces.lengths
        self.guard = len(self.a.encode(" x", add_special_tokens=False).ids), len(self.pieces.library.encode("x"))
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.counts = np.empty((0, 4), np.int64)  # tokens of A, tokens of B, groups, 1 where the bytes aren't the word's
        self.keys, self.first, self.used = np.empty(0, np.int64), np.zeros(1, np.int64), 0

    def _tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both vocabularies for texts that begin with white space, by way of a word before them."""
        a = self.a.encode_batch([" x" + t for t in texts], add_special_tokens=False)
        b = self.pieces.library.encode(["x" + t for t in texts], num_threads=1)
        (n, m) = self.guard
        return [(np.array(x.ids[n:], np.int64), np.array(y[m:], np.int64)) for x, y in zip(a, b, strict=True)]

    def learn(self, words: list[str]) -> None:
        units = list(map(self.pieces.unit, words))
        joined: list[list[int]] = [[]]
        for k, u in enumerate(units):  # what ends in white space is the last of its text
            joined[-1].append(k)
            if len(joined[-1]) == JOINED or u[-1].isspace():
                joined.append([])
        joined = [j for j in joined if j]
        texts = ["".join(map(units.__getitem__, j)) for j in joined]
        found: list[tuple] = []
        for own, text, (a, b) in zip(joined, texts, self._tokens(texts), strict=True):
            if self._same(text, a, b):
                found += self._aligned([units[k] for k in own], a, b)
            else:  # some word doesn't come back: each by itself
                for k in own:
                    (a, b), u = self._tokens([units[k]])[0], units[k]
                    found += self._aligned([u], a, b) if self._same(u, a, b) else [(0, 0, 0, 1, b"", np.empty(0, np.int64))]
        n = len(self.groups)
        self.at.update(zip(words, range(n, n + len(words)), strict=True))
        self.groups += [f[4] for f in found]
        self.counts = np.concatenate((self.counts, np.array([f[:4] for f in found], np.int64)))
        fresh = np.concatenate([f[5] for f in found])
        if self.used + len(fresh) > len(self.keys):
            self.keys = np.concatenate((self.keys[: self.used], np.empty(self.used + len(fresh), np.int64)))
        self.keys[self.used : self.used + len(fresh)] = fresh
        self.first = np.concatenate((self.first, self.used + np.cumsum([f[2] for f in found])))
        self.used += len(fresh)

    def _same(self, text: str, a: np.ndarray, b: np.ndarray) -> bool:
        raw, of = text.encode(), self.pieces.surface
        return b"".join([self.bytes_a[i] for i in a.tolist()]) == raw and SPACE not in text and b"".join([of[i] for i in b.tolist()]) == raw

    def _aligned(self, units: list[str], a: np.ndarray, b: np.ndarray) -> list[tuple]:
        """n_a, n_b, n_groups, 0, groups' text and link keys of each unit of a joined text."""
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        last_a, last_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        keys = (b[last_b] << _B) | a[last_a]
        name = self.pieces.decimal
        in_a, in_b = a.tolist(), b.tolist()
        said, x, y = [], 0, 0
        for p, q in zip((last_a + 1).tolist(), (last_b + 1).tolist(), strict=True):
            said.append(",".join(map(str, in_a[x:p])).encode() + b"|" + b",".join([name[i] for i in in_b[y:q]]))
            x, y = p, q
        cut = np.searchsorted(ends, np.cumsum([len(u.encode()) for u in units])) + 1
        n_a, n_b = (np.diff(last[cut - 1] + 1, prepend=0).tolist() for last in (last_a, last_b))
        begin = [0, *cut.tolist()]
        return [(n_a[k], n_b[k], hi - lo, 0, b";".join(said[lo:hi]), keys[lo:hi]) for k, (lo, hi) in enumerate(zip(begin, begin[1:], strict=False))]

    def words(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Words of all texts, and where each text's end; texts that can't come back whole have none."""
        words: list[str] = []
        ends = []
        for t in texts:
            if t and SPACE not in t:
                words += self.pieces.units(t)
            ends.append(len(words))
        return words, np.array(ends, np.int64)

    def places(self, words: list[str]) -> np.ndarray | None:
        """Numbers of the words; None if the memory has no room for those that are new."""
        at = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(at < 0)
        missed = [words[i] for i in unknown.tolist()]
        new = list(dict.fromkeys(missed))
        if self.at and len(self.at) + len(new) > MEMO:
            return None
        if new:
            self.learn(new)
            at[unknown] = np.fromiter(map(self.at.__getitem__, missed), np.int64, len(missed))
        return at


_made: dict[tuple[str, str], Aligner] = T.kept("alignment")


def aligner(path_a: str, path_b: str) -> Aligner:
    key = (path_a, path_b)
    if key not in _made:
        _made[key] = Aligner(*key)
    return _made[key]


_DOC = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
_NAMES = ["kind", "group", *_DOC, "key", "n", "words"]
_SCHEMA = "kind int, group long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, key long, n long, words binary"
#: Kinds of rows: the count of a key, the words of a group (n the number of the first, as (links, key number...) lists), a document.
KEY, WORDS, DOC = 0, 1, 2


def _rows(kind: int, group: int, size: int, **columns: pa.Array) -> pa.RecordBatch:
    kinds = {"groups_sha256": pa.string(), "words": pa.binary()}
    every = {"kind": pa.array(np.full(size, kind, np.int32)), "group": pa.array(np.full(size, group, np.int64)), **columns}
    return pa.RecordBatch.from_arrays([every[c] if c in every else pa.nulls(size, kinds.get(c, pa.int64())) for c in _NAMES], _NAMES)


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of three kinds: documents with their words' numbers, each group's words, and each group's counts of link keys."""
    small_batches(docs.sparkSession)

    def closed(group: int, made: Aligner, seen: np.ndarray) -> Iterator[pa.RecordBatch]:
        """What a group leaves beside its documents; seen: how often each word came."""
        used = np.flatnonzero(seen)
        links = made.counts[used, 2]
        begin = np.cumsum(links) - links
        at = np.arange(links.sum()) - np.repeat(begin, links) + np.repeat(made.first[used], links)
        key, number = np.unique(made.keys[at], return_inverse=True)
        count = np.zeros(len(key), np.int64)
        np.add.at(count, number, np.repeat(seen[used], links))
        for lo in range(0, len(key), ROWS):
            yield _rows(KEY, group, len(key[lo : lo + ROWS]), key=pa.array(key[lo : lo + ROWS]), n=pa.array(count[lo : lo + ROWS]))
        for lo in range(0, len(used), ROWS):
            hi = min(lo + ROWS, len(used))
            own = number[begin[lo] : begin[hi - 1] + links[hi - 1]]
            packed = np.concatenate(([hi - lo], used[lo:hi], links[lo:hi], own)).astype("<u4").tobytes()
            yield _rows(WORDS, group, 1, words=pa.array([packed], pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.alone("alignment")
        made = aligner(path_a, path_b)
        group, held = TaskContext.get().partitionId() << 24, 0
        seen = np.zeros(0, np.int64)
        for b in batches:
            offsets = T.utf8(b.column(1))[1]
            for lo, hi in T.chunks(offsets):
                words, ends = made.words(b.column(1).slice(lo, hi - lo).to_pylist())
                at = made.places(words)
                full = at is None
                if full or held > GROUP_BYTES:
                    yield from closed(group, made, seen)
                    group, held, seen = group + 1, 0, np.zeros(0, np.int64)
                if full:
                    made.clear()
                    at = made.places(words)
                held += int(offsets[hi] - offsets[lo])
                begin = np.concatenate(([0], ends[:-1]))
                total = np.concatenate((np.zeros((1, 4), np.int64), np.cumsum(made.counts[at], axis=0)))
                sums = total[ends] - total[begin]
                good = (sums[:, 3] == 0) & (ends > begin)
                sums[~good] = 0
                own = [at[x:y] if ok else at[:0] for x, y, ok in zip(begin.tolist(), ends.tolist(), good.tolist(), strict=True)]
                n = np.bincount(np.concatenate(own), minlength=len(made.groups))
                n[: len(seen)] += seen
                seen = n
                said = made.groups.__getitem__
                sha = [hashlib.sha256(b";".join(map(said, w.tolist()))).hexdigest() if len(w) else "" for w in own]
                yield _rows(
                    DOC, group, hi - lo, doc_id=b.column(0).slice(lo, hi - lo), n_a=pa.array(sums[:, 0]), n_b=pa.array(sums[:, 1]), n_groups=pa.array(sums[:, 2]),
                    groups_sha256=pa.array(sha, pa.string()), words=pa.array([w.astype("<u4").tobytes() for w in own], pa.binary()),
                )
        yield from closed(group, made, seen)
        T.release()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _SCHEMA)


def summed(rows: DataFrame) -> DataFrame:
    """key, n of sorted partitions in which equal keys are neighbours: one row for each run, n its sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0
        for b in batches:
            if not len(b):
                continue
            key, n = b.column("key").to_numpy(), b.column("n").to_numpy()
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            runs, sums = key[first], np.add.reduceat(n, first)
            if last is not None:
                if runs[0] == last:
                    sums[0] += total
                else:
                    runs, sums = np.concatenate(([last], runs)), np.concatenate(([total], sums))
            last, total = runs[-1], sums[-1]
            yield pa.RecordBatch.from_arrays([pa.array(runs[:-1]), pa.array(sums[:-1])], ["key", "n"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([total], pa.int64())], ["key", "n"])

    return rows.select("key", "n").mapInArrow(run, "key long, n long")


def looked_up(asked: DataFrame, shards: DataFrame) -> DataFrame:
    """group, key, n of the shards (0 for others) for every row (group, key) of asked; shards: distinct key and n."""
    none = F.lit(None).cast("long")
    both = shards.select(none.alias("group"), "key", "n").unionByName(asked.select("group", "key", none.alias("n")))
    both = both.repartitionByRange(partitions(asked.sparkSession), "key").sortWithinPartitions(F.col("group").isNotNull(), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryFile() as file:  # has no name, so nothing is left of it
            pairs = None
            for b in batches:
                shard = b.filter(b.column("group").is_null())
                if len(shard):
                    file.write(np.stack((shard.column("key").to_numpy(), shard.column("n").to_numpy()), 1).tobytes())
                b = b.filter(b.column("group").is_valid())
                if not len(b):
                    continue
                if pairs is None:  # the shard's rows come before all others
                    file.flush()
                    pairs = np.memmap(file, np.int64, "r").reshape(-1, 2) if file.tell() else np.empty((0, 2), np.int64)
                key = b.column("key").to_numpy()
                at = np.searchsorted(pairs[:, 0], key)
                here = np.minimum(at, len(pairs) - 1) if len(pairs) else at
                n = np.where(pairs[here, 0] == key, pairs[here, 1], 0) if len(pairs) else np.zeros(len(key), np.int64)
                yield pa.RecordBatch.from_arrays([b.column("group"), b.column("key"), pa.array(n)], ["group", "key", "n"])

    return both.mapInArrow(run, "group long, key long, n long")


def finished(made: DataFrame, counts: DataFrame, highest: DataFrame) -> DataFrame:
    """The documents of `aligned` with n_best and count_sum; counts: group, key, n; highest: b and its highest count, a row for each id of B."""
    best = F.broadcast(highest)  # no more rows than the vocabulary has
    keys = counts.withColumn("b", F.shiftright("key", 32)).join(best, "b").select(F.lit(KEY).alias("kind"), "group", "key", F.col("n"), (F.col("n") == F.col("highest")).cast("long").alias("best"))
    rest = made.where(F.col("kind") != KEY).select("kind", "group", *_DOC, "words")
    both = rest.unionByName(keys, allowMissingColumns=True)
    both = both.repartitionByRange(partitions(made.sparkSession), "group").sortWithinPartitions("group", "kind", "key")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, n, best, sums = None, [], [], np.zeros((0, 2), np.int64)
        for whole in batches:
            groups = whole.column("group").to_numpy()
            kinds = whole.column("kind").to_numpy()
            edge = np.flatnonzero(np.concatenate(([True], (groups[1:] != groups[:-1]) | (kinds[1:] != kinds[:-1])))) if len(groups) else []
            for lo, hi in zip(edge, [*edge[1:], len(groups)], strict=True):
                b = whole.slice(lo, hi - lo)
                if groups[lo] != group:
                    group, n, best, sums = groups[lo], [], [], np.zeros((0, 2), np.int64)
                if kinds[lo] == KEY:
                    n.append(b.column("n").to_numpy())
                    best.append(b.column("best").to_numpy())
                elif kinds[lo] == WORDS:
                    if len(n) > 1:
                        n, best = [np.concatenate(n)], [np.concatenate(best)]
                    for packed in b.column("words"):
                        sums = _with_words(sums, np.frombuffer(packed.as_py(), "<u4").astype(np.int64), n[0], best[0])
                else:
                    own = [np.frombuffer(w.as_py(), "<u4") for w in b.column("words")]
                    found = np.array([sums[w].sum(0) for w in own], np.int64).reshape(-1, 2)
                    columns = [b.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_groups")]  # each group ends in one link
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(found[:, 0]), pa.array(found[:, 1]), b.column("groups_sha256")], names)

    return both.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _with_words(sums: np.ndarray, packed: np.ndarray, n: np.ndarray, best: np.ndarray) -> np.ndarray:
    """sums (best links, counts) by number of a word, with the words of one row added."""
    size = packed[0]
    numbers, links, keys = packed[1 : 1 + size], packed[1 + size : 1 + 2 * size], packed[1 + 2 * size :]
    if size and numbers.max() >= len(sums):
        sums = np.concatenate((sums, np.zeros((numbers.max() + 1 - len(sums), 2), np.int64)))
    word = np.repeat(numbers, links)
    np.add.at(sums, (word, 0), best[keys])
    np.add.at(sums, (word, 1), n[keys])
    return sums


def alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    made = materialize(aligned(docs, path_a, path_b), "aligned")
    asked = made.where(F.col("kind") == KEY)
    ranged = asked.select("key", "n").repartitionByRange(partitions(docs.sparkSession), "key").sortWithinPartitions("key")
    shards = materialize(summed(ranged), "pair-counts")
    highest = shards.groupBy(F.shiftright("key", 32).alias("b")).agg(F.max("n").alias("highest"))
    return finished(made, looked_up(asked, shards), highest)


def pair_counts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """a_id, b_id, n: how many links of the corpus hold the pair, in order of b_id and a_id."""
    made = materialize(aligned(docs, path_a, path_b), "aligned").where(F.col("kind") == KEY).select("key", "n")
    ranged = made.repartitionByRange(partitions(docs.sparkSession), "key").sortWithinPartitions("key")
    return summed(ranged).select((F.col("key").bitwiseAND(0xFFFFFFFF)).alias("a_id"), F.shiftright("key", 32).alias("b_id"), "n")
