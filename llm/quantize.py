"""Operator 13: vector codes. Equal consecutive parts of each vector are coded by the nearest entry of a codebook for that part.

Everything is in integers, so results don't hang on the order of sums: a component x counts as floor(scale * x). The
codebooks start as the parts of the first vectors by vec_id; each round assigns every part to its nearest entry and replaces
entries by the floored means of their parts. A task sends one row for each used entry, not for each vector, and only codebooks, of a
fixed size, pass through the driver.

The nearest entry is found by annular pruning: entries are sorted by norm. An entry's distance from a part is at least the
difference of their norms, so with the distance to the entry of nearest norm as a start, only entries whose norm is within
that distance can be nearer. The interval's ends are found by binary search and all entries in it, both ends included, are
compared exactly. The norms are floats and the interval is widened by more than their error; ties go to the lower index.

Defined cases: vectors that are null or empty, or that hold a null, NaN or infinite component, are dropped; so are vectors of another
length than the first kept one. Lengths that don't divide into the parts are filled up with zeros. Repeated rows are vectors of
their own; ties in vec_id are ordered by the vector; null vec_ids come last. With fewer vectors than entries every vector
starts one. Equal labels are added up, nulls together. An empty table gives an empty result. Components of 2**18 and more in size
are an error, since their squares wouldn't fit the sums. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import join_shared, materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Pairs of part and entry compared at a time.
PAIRS = 1 << 18
_LIMIT = 1 << 26


def kept(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (integer components), label of the usable rows."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & whole)
    return usable.select(F.col("vec_id").cast("long"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"), "label")


def cut(v: np.ndarray, parts: int) -> np.ndarray:
    """Vectors as (parts, vectors, width), filled up with zeros where the length doesn't divide."""
    if len(v) and (v.max() >= _LIMIT or v.min() <= -_LIMIT):
        raise ValueError(f"components of {_LIMIT} and more after scaling don't fit the sums")
    width = -(-v.shape[1] // parts)
    full = np.zeros((len(v), parts * width), np.int64)
    full[:, : v.shape[1]] = v
    return np.ascontiguousarray(full.reshape(len(v), parts, width).swapaxes(0, 1))


def annulus(norm: np.ndarray, own: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First entry, of those sorted by norm, and number of entries whose norm is within reach of each part's own, both ends included."""
    slack = (own + reach) * 1e-12 + 1e-9
    first = np.searchsorted(norm, own - reach - slack, "left")
    return first, np.searchsorted(norm, own + reach + slack, "right") - first


def nearest(x: np.ndarray, entries: np.ndarray, pairs: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry for every row of x and its squared distance, by the annulus of norms."""
    norm = np.sqrt((entries * entries).sum(1, dtype=np.float64))
    order = np.argsort(norm, kind="stable")
    norm = norm[order]
    most = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    kind = np.int32 if 4 * int(most) ** 2 * x.shape[1] < 1 << 31 else np.int64  # holds any squared distance
    by_norm = [np.ascontiguousarray(c, kind) for c in entries[order].T]
    columns = [np.ascontiguousarray(c, kind) for c in x.T]
    code, error = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    step = max(1, pairs // len(entries))
    for lo in range(0, len(x), step):
        part = [c[lo : lo + step] for c in columns]
        own = np.sqrt(sum(c.astype(np.float64) ** 2 for c in part))
        at = np.searchsorted(norm, own)
        at = np.where((at == len(norm)) | ((at > 0) & (own - norm[at - 1] < norm[np.minimum(at, len(norm) - 1)] - own)), at - 1, at)
        reach = np.sqrt(sum((c - e[at]) ** 2 for c, e in zip(part, by_norm, strict=True)).astype(np.float64))
        first, many = annulus(norm, own, reach)
        begin = np.cumsum(many) - many
        place = np.arange(many.sum()) - np.repeat(begin - first, many)
        away = np.zeros(len(place), kind)
        for c, e in zip(part, by_norm, strict=True):
            apart = np.repeat(c, many) - e[place]
            away += apart * apart
        least = np.minimum.reduceat(away, begin)
        index = np.where(away == np.repeat(least, many), order[place], len(entries))
        code[lo : lo + step], error[lo : lo + step] = np.minimum.reduceat(index, begin), least
    return code, error


def _vectors(b: pa.RecordBatch) -> np.ndarray:
    """Column v of a batch as (rows, length); all its vectors have one length."""
    column = b.column("v")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 1), np.int64)


def codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """(parts, entries, width) after all rounds; None without rows."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not first:
        return None
    books = cut(np.array([r.v for r in first], np.int64), parts)
    width = books.shape[2]
    for _ in range(rounds):

        def sums(batches: Iterator[pa.RecordBatch], books: np.ndarray = books) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
            for b in batches:
                for p, x in enumerate(cut(_vectors(b), parts)):
                    if len(x):
                        code, _ = nearest(x, books[p])
                        np.add.at(total[p], code, x)
                        count[p] += np.bincount(code, minlength=len(books[p]))
            p, e = np.nonzero(count)
            for d in range(width):
                yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(np.full(len(p), d)), pa.array(total[p, e, d]), pa.array(count[p, e])], ["part", "entry", "d", "total", "n"])

        made = rows.select("v").mapInArrow(sums, "part long, entry long, d long, total long, n long")
        made = made.groupBy("part", "entry", "d").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).toArrow()  # at most the codebooks' size
        p, e, d, total, n = (made.column(c).to_numpy() for c in ("part", "entry", "d", "total", "n"))
        books = books.copy()
        books[p, e, d] = total // n
    return books


def encode(rows: DataFrame, books: np.ndarray | None) -> DataFrame:
    """vec_id, label, code (two hex digits a part), error of rows that `kept` made."""
    names = ["vec_id", "label", "code", "error"]
    label = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            x = cut(_vectors(b), len(books))
            codes, errors = zip(*(nearest(x[p], books[p]) for p in range(len(books))), strict=True)
            packed = np.stack(codes, 1).astype(np.uint8).tobytes().hex()
            size = 2 * len(books)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array([packed[i : i + size] for i in range(0, len(packed), size)], pa.string()), pa.array(np.sum(errors, 0))], names)

    return rows.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def digest(books: np.ndarray | None) -> str:
    """sha256 of all components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, [] if books is None else books.ravel().tolist())).encode()).hexdigest()


def coded(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of table (vec_id, embedding, label)."""
    if entries > 256:
        raise ValueError("a code has two hex digits a part: 256 entries at most")
    rows = kept(vectors)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(1).select(F.size("v").alias("n")).first()
    rows = rows.where(F.size("v") == (first.n if first else 0))
    books = codebooks(rows, parts, entries, rounds)
    # a label may be on any number of rows: its key never is null, and frequent ones are dealt to many tasks
    key = {"_label": F.coalesce(F.col("label").cast("string"), F.lit("")), "_none": F.col("label").isNull()}
    made = materialize(encode(rows, books), "codes").withColumns(key)
    by_label = made.groupBy("_label", "_none").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    return join_shared(made, by_label, ["_label", "_none"]).select("vec_id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
