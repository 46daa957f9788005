"""Operator 3: n-gram Jaccard join by parity sketches.

A document's set holds the hashes of its distinct 5-word shingles. Two sets of a and b shingles with Jaccard
similarity of 4/5 or more differ in at most (a + b) / 9 shingles. In each size band (a power of two) the shingles are
dealt to cells, and a cell holds the XOR of its shingles: d differing shingles change d cells at most. So two linked
sets share all but d of their non-empty cells, and, with cells in one global order, share one of the first d + 1 cells of each
(pigeonhole). The order puts cells that many documents have last; the list of those is a hint that changes costs,
never results.

Documents that share such a cell are candidates. A bucket first offers its least document against each of its
others, so candidates grow with rows; links found merge documents into components, and only then pairs of a bucket
that are still in different components are offered. A second parity sketch, of 512 single bits, bounds the difference
from below inside the join, so that pairs too far apart are never made. Large sets have a sketch that grows with them, which
is compared next; the rest are verified on the whole shingle sets.

Defined cases: null text and text without words have an empty set and link with nothing; a text of one to four words
has one shingle; documents with equal sets are linked; repeated rows are linked rows of their own, and doc_id names the
document; rows with a null doc_id take part only as members of the class of their set; an empty table gives an empty
result; columns not named here are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm import text as T
from llm.common import Scratch, in_blocks, materialize, small_batches, small_side, with_ids
from llm.components import components
from llm.ranks import running

SMALL_BAND, SMALL_CELLS = 6, 1 << 12
#: Words of the short bit sketch; sets above WIDE shingles also have a sketch of four to eight bits a shingle.
LANES, WIDE = 8, 600
#: A cell seen in this many different sets of one task, and this many in all, is common; so many are put last.
COMMON_HERE, COMMON, HINTS = 3, 16, 1 << 20
#: A cell that more documents have than this is dealt to several tasks.
HOT = 1 << 12
_SALT = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.array([0x9E3779B97F4A7C15, 0x3C6EF372FE94F82A], np.uint64)


def sets_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, letters A-Z lowered."""
    return T.distinct(*T.shingles(T.LOWER[data], offsets))


def _set_keys(values: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set."""
    full = np.flatnonzero(np.diff(ptr))
    out = np.zeros((2, len(ptr) - 1), np.uint64)
    if len(full):
        for k in range(2):
            out[k, full] = T.mix(np.add.reduceat(T.mix(values + _SEEDS[k]), ptr[full]) + np.diff(ptr)[full].astype(np.uint64))
    return out[0].view(np.int64), out[1].view(np.int64)


def _sketches(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Parity sketch of each set in LANES words: a bit is the parity of the number of shingles that fall on it."""
    n, width = len(ptr) - 1, 64 * LANES
    doc = np.repeat(np.arange(n), np.diff(ptr))
    at = doc * width + ((values >> np.uint64(20)) % np.uint64(width)).astype(np.int64)
    odd = (np.bincount(at, minlength=n * width) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64).reshape(n, LANES)


def _wide(values: np.ndarray) -> bytes:
    m = 4 << len(values).bit_length()
    return np.packbits(np.bincount((values >> np.uint64(20)).astype(np.int64) % m, minlength=m).astype(np.uint8) & 1).tobytes()


def _differ(a: bytes, b: bytes) -> int:
    """Hamming distance of two wide sketches; the longer one is folded onto the shorter by XOR."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    return int(np.unpackbits(np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0) ^ y).sum())


def _band_cells(values: np.ndarray, ptr: np.ndarray, docs: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the non-empty cells of the given documents in a band, and each key's place in docs."""
    cells = np.uint64(SMALL_CELLS if band < SMALL_BAND else 1 << band if band < SMALL_BAND + 2 else 3 << (band - 2))
    size = np.diff(ptr)[docs]
    at = np.repeat(ptr[docs] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    v = values[at]
    cell = (T.mix(v ^ _SALT) % cells).astype(np.int64)
    slot = np.repeat(np.arange(len(docs)), size) * int(cells) + cell
    order = np.argsort(slot, kind="stable")
    slot = slot[order]
    first = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
    parity = np.bitwise_xor.reduceat(T.mix(v)[order], first)
    slot = slot[first]
    key = T.mix(parity + T.mix((slot % int(cells)).astype(np.uint64) * np.uint64(64) + np.uint64(band)))
    return key.view(np.int64), slot // int(cells)


def cells_of(values: np.ndarray, ptr: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all cells of the documents in every band they take part in: key, document, group (document and band)."""
    n = np.diff(ptr)[docs]
    band = np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)
    reach = 5 * n // 4 >= 1 << (band + 1)  # a partner may be in the band above
    keys, owners, groups = [], [], []
    for up in (0, 1):
        for k in np.unique(band[(n > 0) & (reach | (up == 0))]).tolist():
            own = docs[(n > 0) & (band == k) & (reach | (up == 0))]
            key, at = _band_cells(values, ptr, own, k + up)
            keys.append(key)
            owners.append(own[at])
            groups.append(2 * own[at] + up)
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(groups)


def _fresh(a: np.ndarray, b: np.ndarray, seen: set) -> np.ndarray:
    """Indices of sets that this task hasn't met before; empty sets never count."""
    out = []
    for i, k in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        if k != (0, 0) and k not in seen:
            seen.add(k)
            out.append(i)
    return np.array(out, np.int64)


def summaries(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n, the two set keys, the sketch h0...; and rows (key, count) of cells common within a task."""
    lanes = [f"h{i}" for i in range(LANES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.alone()
        names, seen, held, held_n = ["doc_id", "n", "k1", "k2", "key", "count", *lanes, "wide"], set(), [], 0
        for b in batches:
            data, offsets = T.utf8(b.column(1))
            for lo, hi in T.chunks(offsets):
                values, ptr = sets_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                k1, k2 = _set_keys(values, ptr)
                n = np.diff(ptr)
                held.append(np.unique(cells_of(values, ptr, _fresh(k1, k2, seen))[0], return_counts=True))
                held_n += len(held[-1][0])
                if held_n > 1 << 18:
                    held, held_n = [_merged(held)], 0
                none = pa.nulls(hi - lo, pa.int64())
                sketch = _sketches(values, ptr)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(n), pa.array(k1), pa.array(k2), none, none, *[pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(LANES)], pa.array([_wide(values[ptr[i] : ptr[i + 1]]) if n[i] > WIDE else None for i in range(hi - lo)], pa.binary())], names)
        if held:
            key, count = _merged(held)
            key, count = key[count >= COMMON_HERE], count[count >= COMMON_HERE]
            none = pa.nulls(len(key), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(key), pa.array(count), *[none] * LANES, pa.nulls(len(key), pa.binary())], names)
        T.release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "n", "k1", "k2", "key", "count", *lanes)) + ", wide binary")


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts by key; keys seen once are forgotten (the counts are a hint)."""
    key, count = np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])
    key, at = np.unique(key, return_inverse=True)
    count = np.bincount(at, count, len(key)).astype(np.int64)
    return key[count > 1], count[count > 1]


def prefix_cells(docs: DataFrame, common: np.ndarray, seen_in: np.ndarray) -> DataFrame:
    """(key, doc_id, parts): the first floor(n / 4) + 1 cells of each set in each of its bands; one document a task for equal sets.

    common are cells to put last, seen_in how many sets have each; a cell that more than HOT have is to be dealt in `parts`.
    """
    order_ = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[order_], -(-seen_in[order_] // HOT)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.alone()
        seen: set = set()
        hints, deal = shared.value
        for b in batches:
            data, offsets = T.utf8(b.column(1))
            ids = b.column(0).to_numpy(zero_copy_only=False)
            known = ~np.isnan(ids.astype(float)) if b.column(0).null_count else np.ones(len(ids), bool)
            for lo, hi in T.chunks(offsets):
                values, ptr = sets_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                k1, k2 = _set_keys(values, ptr)
                k1[~known[lo:hi]] = k2[~known[lo:hi]] = 0
                key, doc, group = cells_of(values, ptr, _fresh(k1, k2, seen))
                late, parts = np.zeros(len(key), bool), np.ones(len(key), np.int64)
                if len(hints):
                    place = np.minimum(np.searchsorted(hints, key), len(hints) - 1)
                    late = hints[place] == key
                    parts[late] = deal[place[late]]
                order = np.lexsort((key, late, group))
                key, doc, group, parts = key[order], doc[order], group[order], parts[order]
                first = np.concatenate(([True], group[1:] != group[:-1])) if len(group) else np.empty(0, bool)
                place = np.arange(len(group)) - np.maximum.accumulate(np.where(first, np.arange(len(group)), 0)) if len(group) else group
                keep = place <= np.diff(ptr)[doc] // 4
                yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(ids[lo:hi][doc[keep]].astype(np.int64)), pa.array(parts[keep].astype(np.int32))], ["key", "doc_id", "parts"])
        T.release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "key long, doc_id long, parts int")


def _near(percent: int) -> str:
    """SQL condition on sides x and y (n, h0...): sizes and sketches allow a similarity of percent / 100."""
    apart = " + ".join(f"bit_count(x.h{i} ^ y.h{i})" for i in range(LANES))
    return f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) and {100 + percent} * ({apart}) <= {100 - percent} * (x.n + y.n)"


def sketch_filter(pairs: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow a similarity of percent / 100; info: doc_id, n, h0..."""
    met = pairs.join(info.withColumnRenamed("doc_id", "a").alias("x"), "a").join(info.withColumnRenamed("doc_id", "b").alias("y"), "b")
    return met.where(_near(percent)).select("a", "b", F.greatest("x.n", "y.n").alias("n"))


def wide_filter(pairs: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b, n) with a large set, those whose wide sketches allow the similarity; all others pass."""
    large = pairs.where(f"n > {WIDE}").select("a", "b")
    ids = large.select(F.col("a").alias("doc_id")).union(large.select("b")).distinct()
    wide = with_ids(info.where("wide is not null").select("doc_id", "n", "wide"), ids)
    side = lambda c: wide.select(F.col("doc_id").alias(c), F.col("n").alias(f"n{c}"), F.col("wide").alias(f"w{c}"))
    met = large.join(side("a"), "a", "left").join(side("b"), "b", "left").select("a", "b", "na", "nb", "wa", "wb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.alone()
        for t in batches:
            keep = []
            for na, nb, x, y in zip(*(t.column(i) for i in range(2, 6)), strict=True):
                keep.append(not x.is_valid or not y.is_valid or (100 + percent) * _differ(x.as_py(), y.as_py()) <= (100 - percent) * (na.as_py() + nb.as_py()))
            yield t.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return pairs.where(f"n <= {WIDE}").select("a", "b").unionByName(met.mapInArrow(run, "a long, b long"))


def verified(pairs: DataFrame, docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """a, b, jaccard of the pairs whose exact shingle sets are at least that similar."""
    percent = round(100 * similarity)
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.alone()
        for b in batches:
            data, offsets = T.utf8(b.column(1))
            for lo, hi in T.chunks(offsets):
                values, ptr = sets_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array([values[ptr[i] : ptr[i + 1]].tobytes() for i in range(hi - lo)], pa.binary())], ["doc_id", "set"])

    made = with_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids).mapInArrow(sets, "doc_id long, set binary")
    side = lambda s: made.select(F.col("doc_id").alias(s), F.col("set").alias(f"set{s}"))
    met = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "seta", "setb")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        T.alone()
        for t in batches:
            a, b, j = [], [], []
            for p, q, x, y in zip(*(c.to_pylist() if c.type == pa.int64() else c for c in t.columns), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if not len(x) or not len(y):
                    continue
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                union = len(x) + len(y) - both
                if 100 * both >= percent * union:
                    a.append(p)
                    b.append(q)
                    j.append(both / union)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(j, pa.float64())], ["a", "b", "jaccard"])

    return met.mapInArrow(compare, "a long, b long, jaccard double").distinct()


def near_groups(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id: connected components of the links, complete for percent >= 80."""
    if percent < 80:
        raise ValueError("the cells are laid out for a similarity of 80 % or more")
    small_batches(docs.sparkSession)
    with Scratch() as keep:
        return materialize(_groups(docs, percent, keep), "groups")


def _groups(docs: DataFrame, percent: int, keep: Scratch) -> DataFrame:
    seen = keep(summaries(docs), "sets")
    common = seen.where("key is not null").groupBy("key").agg(F.sum("count").alias("n")).where(f"n >= {COMMON}")
    common = common.orderBy(F.desc("n"), "key").limit(HINTS).toArrow()
    lanes = [f"h{i}" for i in range(LANES)]
    info = seen.where("key is null").select("doc_id", "n", "k1", "k2", *lanes, "wide")
    classes = keep(info.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("class")), "classes")
    known = info.where("n > 0 and doc_id is not null")
    of = keep(known.select("doc_id", "k1", "k2").join(classes, ["k1", "k2"]).select("doc_id", "class").distinct(), "class-of")  # of every document with a set
    chosen = known.drop("wide").join(of.where("doc_id = class").select("doc_id"), "doc_id").select("doc_id", "n", *lanes)
    chosen = keep(chosen.dropDuplicates(["doc_id"]), "chosen")

    # buckets of two documents or more; then of two classes or more, with the least class of each. A bucket that is dealt in
    # parts has a least class in each part, and parts of one document stay: what parts leave apart is compared below, by key
    def bucketed(rows: DataFrame, c: str) -> DataFrame:
        rows = rows.withColumn("part", F.pmod(F.xxhash64(c), F.col("parts")).cast("int"))
        own = Window.partitionBy("key", "part")
        rows = rows.repartition("key", "part").withColumns({"hub": F.min(c).over(own), "last": F.max(c).over(own)})
        return rows.where("hub < last or parts > 1").select("key", c, "parts", "hub")

    keyed = bucketed(prefix_cells(docs, common.column("key").to_numpy(), common.column("n").to_numpy()), "doc_id")
    met = keyed.join(of, "doc_id").select("key", F.col("class").alias("doc"), "parts").distinct()
    buckets = keep(bucketed(met, "doc").select("key", "doc", "hub"), "buckets")

    first = keep(buckets.where("hub < doc").select(F.col("hub").alias("a"), F.col("doc").alias("b")).distinct(), "first")
    close = keep(wide_filter(keep(sketch_filter(first, chosen, percent), "kept"), known, percent), "kept")
    links = keep(verified(close, docs, percent / 100), "links").select("a", "b")
    label = components(links, keep)

    marked = buckets.join(label.withColumnRenamed("node", "doc"), "doc", "left").select("key", "doc", F.coalesce("label", "doc").alias("label"))
    marked = keep(marked, "marked")
    sizes = marked.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    sides = [F.sum("n").alias("rows_in"), (F.sum("n") - F.max("n")).alias("rows_out")]
    open_ = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("labels"), F.max_by("label", F.struct("n", "label")).alias("main"), *sides).where("labels > 1")
    others = marked.join(open_, "key").join(chosen.withColumnRenamed("doc_id", "doc"), "doc")
    outside, inside = in_blocks(others.where("label <> main"), others)
    crossed = outside.alias("x").join(inside.alias("y"), F.expr(f"x.key = y.key and x._i = y._i and x._j = y._j and x.label <> y.label and {_near(percent)}"))
    crossed = crossed.select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b"), F.greatest("x.n", "y.n").alias("n")).distinct()
    second = keep(crossed.join(first, ["a", "b"], "left_anti"), "kept")
    second = keep(wide_filter(second, known, percent), "kept")
    if not second.isEmpty():
        links = links.unionByName(verified(second, docs, percent / 100).select("a", "b"))
        label = components(links, keep)

    rows = info.join(classes, ["k1", "k2"], "left").join(label.withColumnRenamed("node", "class"), "class", "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "class", "doc_id").alias("component_id"))


def _with_own_ids(rows: DataFrame) -> DataFrame:
    """rows (row, doc_id, text) with `id`: the doc_id or, if some doc_id has unlike texts, the place of (doc_id, text) in order of doc_id.

    Usually none has; then nothing but hashes is shuffled. Null ids stay null.
    """
    marks = {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(7), "text")}
    texts = rows.where("doc_id is not null").withColumns(marks).select("doc_id", "h1", "h2")
    ends = texts.groupBy("doc_id").agg(F.min(F.struct("h1", "h2")).alias("least"), F.max(F.struct("h1", "h2")).alias("most"))
    if ends.where("least <> most").isEmpty():
        return rows.withColumn("id", F.col("doc_id"))
    numbered = running(texts.distinct(), None, ["doc_id", "h1", "h2"]).select("doc_id", "h1", "h2", F.col("rank").alias("id"))
    return rows.withColumns(marks).join(small_side(materialize(numbered, "own-ids")), ["doc_id", "h1", "h2"], "left").select("row", "doc_id", "text", "id")


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The documents, with one (the least doc_id) of each group of near duplicates.

    A row stays or goes by its text: unlike texts under one doc_id are documents of their own, in the order of their hashes. Rows repeated under an id with one text stay one, the one with the least hash of all columns; rows without an id all stay.
    """
    quoted = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*quoted).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = _with_own_ids(rows)
    least = near_groups(rows.select(F.col("id").alias("doc_id"), "text"), percent).where("doc_id = component_id").select(F.col("doc_id").alias("id")).distinct()
    known = rows.where("id is not null").select("id", "row").withColumn("h", F.xxhash64("row"))
    # which of an id's rows stays is settled by hashes; only rows alike in all columns are then compared whole
    each = known.select("id", "h").groupBy("id", "h").agg(F.count(F.lit(1)).alias("n")).join(least, "id", "left_semi")
    one = materialize(each.groupBy("id").agg(F.min(F.struct("h", "n")).alias("one")).select("id", "one.h", F.col("one.n").alias("n")), "chosen")
    stay = known.join(small_side(one), ["id", "h"])
    alike = stay.where("n > 1").dropDuplicates(["id"])
    return stay.where("n = 1").unionByName(alike).select("row.*").unionByName(rows.where("id is null").select("row.*"))
