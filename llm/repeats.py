"""Operator 7: removal of repeated byte strings of a given length (400 bytes) and more, exact over the whole table.

Every window of that length is tied to an anchor that its own content fixes: the leftmost least of the hashes of the
16-byte strings that start in all but its last 80 bytes. Windows with one anchor are neighbours and form a segment, so
equal windows have equal anchors at equal distance, and the 80 bytes from the anchor on are part of both. Segments, then
blocks of 16 windows, then single windows are settled in turn; at each level

1. units whose core (the bytes that all their windows share) is nowhere else hold no repeated window;
2. units whose whole text is found twice hold repeated windows only;
3. the rest, the edges of matches, go to the next level, one unit standing for all that have its text.

Work and shuffles grow with the text, not with the number of copies of a passage. Keys that many rows share are joined
by broadcast while their table is small, and else the most frequent ones are dealt to many tasks.

A second, shorter length (`passage`) may be asked for: then the shorter repeats are found first, and the longer ones
only within them, because every part of a repeated string is repeated too.

Defined cases: null text is empty; texts under the length have no window; matches never cross documents; repeated rows
repeat each other's windows; an empty table gives an empty result; texts longer than a slice are read in overlapping
slices, so a very long text is scanned whole; columns of the input pass through, but for those named like the new ones,
which are replaced. Arrow batches are set to 1000 rows for the session if it has no number of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm import text as T
from llm.common import Scratch, join_shared, materialize, small_batches, small_side, with_ids

#: LENGTH is what the query's contract names; PASSAGE holds 50 words at five bytes each, the space included.
LENGTH, PASSAGE = 400, 250
GRAM, CORE, BLOCK = 16, 80, 16
SLICE = 4 << 20
_LOW = np.uint64(0xFFFFFFFF)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_KEY, _PLACE = ["doc_id", "mark", "base"], ["doc_id", "mark", "base", "anchor", "lo", "hi"]
_KEY_TYPE, _SPANS = "doc_id long, mark long, base long", "array<struct<start: long, end: long>>"


def _least_ahead(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of x[i : i + w] for every i, from running minima of blocks of w."""
    n = len(x)
    full = np.full(-(-(n + w) // w) * w, _NONE, np.uint64)
    full[:n] = x
    blocks = full.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(ahead[:n], behind[w - 1 : w - 1 + n])


def slices(offsets: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, int, np.ndarray]]:
    """(begin, end, offsets of documents within) of pieces of the data; a long document comes in overlapping pieces."""
    for lo, hi in T.chunks(offsets, min(T.CHUNK_BYTES, SLICE)):
        a, b = int(offsets[lo]), int(offsets[hi])
        if b - a <= SLICE:
            yield a, b, offsets[lo : hi + 1] - a
        else:
            for x in range(a, max(a + 1, b - length + 1), SLICE):
                end = min(b, x + SLICE + length - 1)
                yield x, end, np.array([0, end - x])


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """anchor, first window, last window, hash of the anchor string, hash of the segment's whole text."""
    n = len(data)
    none = np.empty(0, np.int64)
    sizes = np.maximum(np.diff(offsets) - length + 1, 0)
    if not sizes.sum():
        return none, none, none, none, none
    up, down = T.powers(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(T._BYTE[data] * up[:n], out=prefix[1:])
    span = lambda a, b: T.mix((prefix[b] - prefix[a]) * down[a])
    i = np.arange(n - GRAM + 1)
    order = (T.mix((prefix[GRAM:] - prefix[: n - GRAM + 1]) * down[: n - GRAM + 1]) & ~_LOW) | i.astype(np.uint64)
    least = _least_ahead(order, length - CORE)
    begin = offsets[:-1]
    p = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    anchor = (least[p] & _LOW).astype(np.int64)
    first = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (p[1:] != p[:-1] + 1)))
    at = np.flatnonzero(first)
    lo, hi, anchor = p[at], p[np.concatenate((at[1:], [len(p)])) - 1], anchor[at]
    return anchor, lo, hi, span(anchor, anchor + CORE).view(np.int64), T.mix(span(lo, hi + length) + (anchor - lo).astype(np.uint64) * T._SHORT).view(np.int64)


def _anchored(own: DataFrame, length: int, places: bool) -> DataFrame:
    """(s, t) of every segment, with places also its key and anchor, lo, hi: positions in bytes of the text."""
    names = ["s", "t", *_PLACE][: 8 if places else 2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.alone()
        for b in batches:
            data, offsets = T.utf8(b.column(3))
            for begin, end, mine in slices(offsets, length):
                anchor, lo, hi, s, t = segments(data[begin:end], mine, length)
                out = [pa.array(s), pa.array(t)]
                if places:
                    doc = np.searchsorted(offsets, begin + lo, "right") - 1
                    first = offsets[doc] - begin
                    out += [b.column(k).take(pa.array(doc)) for k in range(3)]
                    out += [pa.array(anchor - first), pa.array(lo - first), pa.array(hi - first)]
                yield pa.RecordBatch.from_arrays(out, names)

    return own.mapInArrow(run, "s long, t long" + f", {_KEY_TYPE}, anchor long, lo long, hi long" * places)


def _units(anchor: np.ndarray, lo: np.ndarray, hi: np.ndarray, block: int) -> tuple[np.ndarray, ...]:
    """Blocks of windows by distance from the anchor: place in the list, number of the block, first and last distance."""
    first, last = (anchor - hi) // block, (anchor - lo) // block
    n = last - first + 1
    i = np.repeat(np.arange(len(anchor)), n)
    j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + first[i]
    return i, j, np.maximum(anchor[i] - hi[i], j * block), np.minimum(anchor[i] - lo[i], j * block + block - 1)


def _expanded(listed: DataFrame, length: int, block: int) -> DataFrame:
    """Units of the listed segments of each text: its key, s, o (number of the block), core, t, c, anchor, lo, hi."""
    names = [*_KEY, "s", "o", "core", "t", "c", "anchor", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.alone()
        for b in batches:
            for r in range(len(b)):
                values = b.column(4)[r].values
                every = [values.field(k).to_numpy() for k in range(5)]
                order = np.argsort(every[1], kind="stable")
                every = [v[order] for v in every]
                text = np.frombuffer(b.column(3)[r].as_buffer(), np.uint8)
                cut = [0]
                while cut[-1] < len(order):  # pieces of the text of a few MB
                    cut.append(max(cut[-1] + 1, int(np.searchsorted(every[1], every[1][cut[-1]] + SLICE, "right"))))
                for k in map(slice, cut, cut[1:]):
                    anchor, lo, hi, s, c = (v[k] for v in every)
                    i, j, near, far = _units(anchor, lo, hi, block)
                    at, x = anchor[i], int(lo.min())
                    piece = text[x : int(hi.max()) + length]
                    first, last = at - far, at - near
                    full = at - j * block - x
                    core = T.spans_hash(piece, full, full - block + 1 + length).view(np.int64)
                    t = core
                    if block > 1:
                        shape = (near * 1000 + far).astype(np.uint64) * T._SHORT
                        t = T.mix(T.spans_hash(piece, first - x, last - x + length) + shape).view(np.int64)
                    own = [pa.array([b.column(k)[r].as_py()] * len(i), pa.int64()) for k in range(3)]
                    yield pa.RecordBatch.from_arrays([*own, *map(pa.array, (s[i], j, core, t, c[i], at, first, last))], names)

    return listed.mapInArrow(run, f"{_KEY_TYPE}, s long, o long, core long, t long, c long, anchor long, lo long, hi long")


def _with_lists(own: DataFrame, lists: DataFrame, name: str) -> DataFrame:
    """Rows of own that have a list (by key; a null doc_id is a key like others), with it."""
    ids = lists.where("doc_id is not null").select("doc_id").distinct()
    texts = with_ids(own.where("doc_id is not null"), ids).unionByName(own.where("doc_id is null"))
    lists = lists.select(*[F.col(k).alias(f"_{k}") for k in _KEY], name)
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("mark") == F.col("_mark")) & (F.col("base") == F.col("_base"))
    return texts.join(lists, same).select(*own.columns, name)


def _listed(own: DataFrame, edges: DataFrame) -> DataFrame:
    """Key, text and the list of (anchor, lo, hi, s, c) of each text that has edges, once for equal rows."""
    lists = edges.groupBy(*_KEY).agg(F.collect_list(F.struct("anchor", "lo", "hi", "s", "c")).alias("listed"))
    return _with_lists(own, lists, "listed").dropDuplicates(_KEY)


def repeated_windows(own: DataFrame, length: int, keep: Scratch) -> DataFrame:
    """(key, lo, hi): runs of window starts of texts (doc_id, mark, base, text as bytes) whose window is also elsewhere."""
    own = own.where(f"octet_length(text) >= {length}")
    cores = _anchored(own, length, False).groupBy("s").agg(F.count(F.lit(1)).alias("n"), (F.min("t") < F.max("t")).alias("mixed"))
    cores = keep(cores.where("n > 1"), "cores")
    met = keep(join_shared(_anchored(own, length, True), cores, ["s"]).drop("n"), "shared")
    found = met.where("not mixed").select(*_KEY, "lo", "hi")

    mixed = met.where("mixed")
    twice = F.least(F.count(F.lit(1)), F.lit(2)).alias("c")
    kinds = keep(mixed.groupBy("s", "t").agg(twice, F.count(F.lit(1)).alias("n"), F.min(F.struct(*_PLACE)).alias("one")), "kinds")
    found = found.unionByName(join_shared(mixed, kinds.where("c > 1").select("s", "t", "n"), ["s", "t"]).select(*_KEY, "lo", "hi"))
    edges = kinds.join(small_side(kinds.where("c = 1").select("s").distinct()), "s").select("one.*", "s", "c")

    for block in (BLOCK, 1):
        units = keep(_expanded(_listed(own, edges), length, block), "units")
        key = ["s", "o", "core"]
        kinds = units.groupBy(*key, "t").agg(F.least(F.sum("c"), F.lit(2)).alias("c"), F.count(F.lit(1)).alias("n"), F.min(F.struct(*_PLACE)).alias("one"))
        kinds = keep(kinds, "kinds")
        shared = kinds.where("c > 1").select(*key, "t", "n")
        found = found.unionByName(join_shared(units.where("c = 1"), shared, [*key, "t"]).select(*_KEY, "lo", "hi"))
        if block > 1:
            unsure = kinds.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).where("n > 1 and least = 1").select(*key)
            edges = kinds.join(small_side(unsure), key).select("one.*", "s", "c")
    return found


def _merged(runs: pa.StructArray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the bytes that runs of windows cover, joined where they touch or overlap."""
    lo, hi = runs.field(0).to_numpy(), runs.field(1).to_numpy() + length
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    new = np.flatnonzero(np.concatenate(([True], lo[1:] > reach[:-1])))
    return lo[new], reach[np.concatenate((new[1:], [len(lo)])) - 1]


def _regions(own: DataFrame, runs: DataFrame, passage: int, length: int) -> DataFrame:
    """The parts of texts where a repeat of `length` may lie: neighbouring starts of repeated windows of `passage` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.alone()
        for b in batches:
            at, first, parts = [], [], []
            for r in range(len(b)):
                lo, end = _merged(b.column(4)[r].values, 1)  # neighbouring window starts, not the bytes they cover
                far = end - lo > length - passage
                raw = b.column(3)[r].as_buffer()
                at += [r] * int(far.sum())
                first += lo[far].tolist()
                parts += [raw.slice(x, y + passage - 1 - x).to_pybytes() for x, y in zip(lo[far].tolist(), end[far].tolist(), strict=True)]
            ids = [b.column(k).take(pa.array(at, pa.int64())) for k in range(2)]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(first, pa.int64()), pa.array(parts, pa.binary())], [*_KEY, "text"])

    return _with_lists(own, runs, "runs").mapInArrow(run, f"{_KEY_TYPE}, text binary")


def _as_runs(windows: DataFrame) -> DataFrame:
    """One row for each whole text that has any: its key (base 0) and its runs of window starts."""
    whole = F.struct((F.col("lo") + F.col("base")).alias("lo"), (F.col("hi") + F.col("base")).alias("hi"))
    return windows.groupBy("doc_id", "mark").agg(F.collect_list(whole).alias("runs")).select("doc_id", "mark", F.lit(0).cast("long").alias("base"), "runs")


def without_repeats(docs: DataFrame, length: int = LENGTH, passage: int | None = None, whole_chars: bool = False) -> DataFrame:
    """docs with n_bytes, spans array<struct<start, end>> (maximal removed runs, in bytes) and kept (the remaining bytes).

    passage: a length under `length`; `passages` then holds the maximal runs that repeats of this length cover.
    whole_chars: a character that a run covers in part stays, so that kept is valid UTF-8.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit("")).cast("binary")
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark.alias("mark"), F.lit(0).cast("long").alias("base"), text.alias("text"))
    with Scratch() as keep:
        if passage:
            shorter = keep(_as_runs(repeated_windows(own, passage, keep)), "shorter")
            within = keep(_regions(own, shorter, passage, length), "regions")
            longer = _as_runs(repeated_windows(within, length, keep)).select(F.col("doc_id").alias("_d"), F.col("mark").alias("_m"), F.col("runs").alias("_longer"))
            same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("mark") == F.col("_m"))
            runs = materialize(shorter.join(longer, same, "left").select("doc_id", "mark", F.col("_longer").alias("_runs"), F.col("runs").alias("_passages")), "runs")
        else:
            none = F.lit(None).cast("array<struct<lo: long, hi: long>>")
            runs = materialize(_as_runs(repeated_windows(own, length, keep)).select("doc_id", "mark", F.col("runs").alias("_runs"), none.alias("_passages")), "runs")
    runs = runs.withColumnsRenamed({"doc_id": "_doc", "mark": "_m"})

    new = ["n_bytes", "spans", "kept", *(["passages"] if passage else [])]
    carried = [F.col(f"`{c}`") for c in docs.columns if c not in new]
    row = docs.select(F.struct(*carried).alias("_row"), text.alias("_bytes"), F.col("doc_id").cast("long").alias("_id"), mark.alias("_mark"))
    ids = small_side(runs.select(F.col("_doc").alias("_d")).distinct())
    has = F.col("_id").eqNullSafe(F.col("_d"))
    none = F.array().cast(_SPANS)
    untouched = row.join(ids, has, "left_anti").select("_row", F.octet_length("_bytes").cast("long").alias("n_bytes"), none.alias("spans"), F.col("_bytes").alias("kept"), none.alias("passages"))
    same = F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_mark") == F.col("_m"))
    joined = row.join(ids, has, "left_semi").join(runs, same, "left").select("_row", "_bytes", "_runs", "_passages")

    def covered(runs: pa.Scalar, size: int) -> list[tuple[int, int]]:
        if not runs.is_valid:  # also a row that shares no more than its id with one that has runs
            return []
        start, end = _merged(runs.values, size)
        return list(zip(start.tolist(), end.tolist(), strict=True))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.alone()
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        listed = lambda found: pa.array([[{"start": x, "end": y} for x, y in v] for v in found], kind)
        for b in batches:
            sizes, spans, kept, wide = [], [], [], []
            for text, runs, passages in zip(b.column(1), b.column(2), b.column(3), strict=True):
                raw = text.as_py()
                gone = covered(runs, length)
                if whole_chars:
                    gone = [(x, y) for x, y in (_whole(raw, x, y) for x, y in gone) if x < y]
                edges = [0, *[v for r in gone for v in r], len(raw)]
                sizes.append(len(raw))
                spans.append(gone)
                kept.append(b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
                wide.append(covered(passages, passage or length))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), listed(spans), pa.array(kept, pa.binary()), listed(wide)], ["_row", "n_bytes", "spans", "kept", "passages"])

    touched = joined.mapInArrow(cut, f"_row {row.schema['_row'].dataType.simpleString()}, n_bytes long, spans {_SPANS}, kept binary, passages {_SPANS}")
    return untouched.unionByName(touched).select("_row.*", *new)


def _whole(raw: bytes, start: int, end: int) -> tuple[int, int]:
    inner = lambda i: i < len(raw) and raw[i] & 0xC0 == 0x80
    while start < end and inner(start):
        start += 1
    while end > start and inner(end):
        end -= 1
    return start, end


def removed(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
