"""Operator 1: document fingerprints by MinHash.

A fingerprint holds, for each of K multiply-shift hash functions, the least hash of the document's 5-word shingles,
mixed and then cut to 16 bits (the top bits of the least hash itself would shrink as texts grow). Near duplicates are
found by joining bands of the fingerprint in Spark and verifying the Jaccard similarity of the shingle sets.

Defined cases: a null text is empty; a text of one to four words has one shingle, its whole sequence; a text
without words has a fingerprint of its own kind, like that of every such text and unlike all others; equal texts have
equal fingerprints; repeated rows are rows of their own; an empty table gives an empty result; very long texts are hashed
whole, one at a time; columns not named here are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import text as T
from llm.common import in_blocks, materialize, partitions, small_batches

HASHES, BANDS, BAND_ROWS = 128, 25, 5
_A = np.random.Generator(np.random.PCG64(1)).integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = np.random.Generator(np.random.PCG64(2)).integers(1, 1 << 63, HASHES, dtype=np.uint64)
_TOP, _NONE = np.uint64(48), 65535
_BLOCK = 1 << 15


def signatures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """uint16 array (documents, HASHES) of the least hashes; 65535 throughout for a document without words."""
    sh, ptr = T.shingles(data, offsets)
    n = len(offsets) - 1
    out = np.full((n, HASHES), np.iinfo(np.uint64).max, np.uint64)
    if len(sh):
        # blocks of shingles that stay in the cache; a document may go over several blocks
        for lo in range(0, len(sh), _BLOCK):
            part = sh[lo : lo + _BLOCK]
            first, last = np.searchsorted(ptr, lo, "right") - 1, np.searchsorted(ptr, lo + len(part), "left")
            docs = np.arange(first, last)
            docs = docs[ptr[docs + 1] > np.maximum(ptr[docs], lo)]
            at = np.maximum(ptr[docs] - lo, 0)
            buf = np.empty(len(part), np.uint64)
            for k in range(HASHES):
                np.multiply(part, _A[k], out=buf)
                buf += _B[k]
                out[docs, k] = np.minimum(out[docs, k], np.minimum.reduceat(buf, at))
    sig = np.minimum(T.mix(out) >> _TOP, np.uint64(_NONE - 1)).astype(np.uint16)
    sig[np.diff(ptr) == 0] = _NONE
    return sig


def of_texts(texts: list[bytes]) -> np.ndarray:
    """Signatures of texts, a few MB at a time."""
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    parts = [np.empty((0, HASHES), np.uint16)]
    for lo, hi in T.chunks(offsets):
        parts.append(signatures(np.frombuffer(b"".join(texts[lo:hi]), np.uint8), offsets[lo : hi + 1] - offsets[lo]))
    return np.concatenate(parts)


def _hex(sig: np.ndarray) -> list[str]:
    raw, width = sig.astype("<u2").tobytes(), 2 * HASHES
    return [raw[i : i + width].hex() for i in range(0, len(raw), width)]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (hex), bands (array of 25 band keys)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.utf8(batch.column(1))
            for lo, hi in T.chunks(offsets):
                sig = signatures(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                bands = sig[:, : BANDS * BAND_ROWS].astype(np.uint64).reshape(-1, BANDS, BAND_ROWS)
                key = np.zeros(bands.shape[:2], np.uint64)
                for r in range(BAND_ROWS):
                    key = T.mix(key ^ bands[:, :, r])
                keys = pa.FixedSizeListArray.from_arrays(pa.array(key.view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(_hex(sig), pa.string()), keys], ["doc_id", "fingerprint", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string, bands array<long>")


def banded_pairs(keyed: DataFrame) -> DataFrame:
    """Candidate pairs (a < b) of rows (band, key, doc_id): every document of a bucket with the bucket's least, so that pairs grow with rows."""
    hubs = keyed.groupBy("band", "key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("_last")).where("a < _last")
    return keyed.join(hubs, ["band", "key"]).where("a < doc_id").select("a", F.col("doc_id").alias("b")).distinct()


def near_duplicates(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """Verified pairs a, b, jaccard of exact shingle sets, that join whatever similar documents share a band.

    Documents with equal sets are one class, its least doc_id, tied to each of its others. Classes are paired by their
    bucket's least; then the classes of a bucket that are still in different components are paired with each other,
    with the bounds of op3's sketches inside the join. So a similar pair that shares a bucket is verified or already in one component.
    """
    from llm.components import components
    from llm.jaccard import LANES, _near, summaries, verified

    percent = round(100 * similarity)
    lanes = [f"h{i}" for i in range(LANES)]
    info = materialize(summaries(docs).where("key is null and n > 0 and doc_id is not null").select("doc_id", "n", "k1", "k2", *lanes).dropDuplicates(["doc_id", "k1", "k2"]), "sets")
    classes = info.groupBy("k1", "k2").agg(F.min("doc_id").alias("class"))
    of = materialize(info.select("doc_id", "k1", "k2").join(classes, ["k1", "k2"]).select("doc_id", "class"), "class-of")
    copies = of.where("class < doc_id").select(F.col("class").alias("a"), F.col("doc_id").alias("b"), F.lit(1.0).alias("jaccard"))
    chosen = info.join(classes, ["k1", "k2"]).where("doc_id = class").select("doc_id", "n", *lanes)

    keyed = fingerprints(docs).select("doc_id", F.posexplode("bands").alias("band", "key")).join(of, "doc_id")
    buckets = materialize(keyed.select("band", "key", F.col("class").alias("doc_id")).distinct(), "buckets")
    first = materialize(banded_pairs(buckets), "first")
    links = materialize(verified(first, docs, similarity).unionByName(copies).distinct(), "links")

    label = components(links.select("a", "b")).withColumnRenamed("node", "doc_id")
    marked = materialize(buckets.join(label, "doc_id", "left").select("band", "key", "doc_id", F.coalesce("label", "doc_id").alias("label")), "marked")
    sizes = marked.groupBy("band", "key", "label").agg(F.count(F.lit(1)).alias("size"))
    # pairs within the largest component of a bucket aren't needed, so one side of a pair lies outside it
    sides = [F.sum("size").alias("rows_in"), (F.sum("size") - F.max("size")).alias("rows_out")]
    open_ = sizes.groupBy("band", "key").agg(F.count(F.lit(1)).alias("labels"), F.max_by("label", F.struct("size", "label")).alias("main"), *sides).where("labels > 1")
    others = marked.join(open_, ["band", "key"]).join(chosen, "doc_id")
    outside, inside = in_blocks(others.where("label <> main"), others, "doc_id")
    crossed = outside.alias("x").join(inside.alias("y"), F.expr(f"x.band = y.band and x.key = y.key and x._i = y._i and x._j = y._j and x.label <> y.label and {_near(percent)}"))
    second = crossed.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    return links.unionByName(verified(materialize(second, "second"), docs, similarity))


def _bounds(docs: DataFrame, n: int) -> list[float]:
    """Cut points of doc_id into n ranges of like size: at most n numbers."""
    found = docs.where("doc_id is not null").approxQuantile("doc_id", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    return sorted(set(found))


def with_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text ends with the beginning of the next document in descending doc_id (the last one's next is the first).
    Documents go to ranges of doc_id, one to a task, and are sorted there; the head of each range is copied to the end of
    the range above, so that each task sees the next text of every row it owns. Null ids come last, in a range of
    their own; rows with equal ids are ordered by text.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    small_batches(spark)
    n = 2 * partitions(spark)
    bounds = np.array(_bounds(rows, n), np.float64)

    def part(ids: pa.Array) -> np.ndarray:
        """Ranges are numbered from the top; null ids have the last."""
        known = np.array([np.nan if x is None else x for x in ids.to_pylist()], np.float64) if ids.null_count else ids.to_numpy(zero_copy_only=False).astype(np.float64)
        p = len(bounds) - np.searchsorted(bounds, known, "left")
        p[np.isnan(known)] = len(bounds) + 1
        return p.astype(np.int64)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(part(b.column(0))), b.column(0)], ["p", "doc_id"])

    ids = rows.select("doc_id").mapInArrow(numbered, "p long, doc_id long")
    heads = {r.p: r.head for r in ids.groupBy("p").agg(F.max("doc_id").alias("head")).collect()}  # one row for each range
    order = sorted(heads)
    above = {heads[p]: order[i - 1] for i, p in enumerate(order)}  # the first range's head goes to the last range

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["p", "ghost", "doc_id", "text"]
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(part(b.column(0))), pa.array(np.zeros(len(b), bool)), b.column(0), b.column(1)], names)
            own = b.column(0).to_pylist()
            at = [i for i, x in enumerate(own) if x in above]
            if at:
                g = b.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([pa.array([above[own[i]] for i in at], pa.int64()), pa.array([True] * len(at)), g.column(0), g.column(1)], names)

    def fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for b in batches:
            offsets = T.utf8(b.column(3))[1]
            for lo, hi in T.chunks(offsets):
                c = b.slice(lo, hi - lo)
                rows = [held] * (held is not None) + list(zip(c.column(0).to_pylist(), c.column(1).to_pylist(), c.column(2).to_pylist(), c.column(3).to_pylist(), strict=True))
                held = rows[-1]
                own = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
                if not own:
                    continue
                texts = [r[3] for r in rows]
                edited = [(texts[i][: len(texts[i]) - len(texts[i]) // 2] + texts[i + 1][: len(texts[i]) // 2]).encode() for i in own]
                base, other = of_texts([t.encode() for t in texts]), of_texts(edited)
                mine = base[own]
                yield pa.RecordBatch.from_arrays([
                    pa.array([rows[i][2] for i in own], pa.int64()),
                    pa.array([len(texts[i]) for i in own], pa.int64()),
                    pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
                    pa.array(_hex(mine)), pa.array(_hex(other)),
                    pa.array((mine == other).mean(1)), pa.array((mine == base[[i + 1 for i in own]]).mean(1)),
                ], names)

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    made = rows.mapInArrow(dealt, "p long, ghost boolean, doc_id long, text string").repartitionById(len(bounds) + 2, F.col("p").cast("int"))
    made = made.sortWithinPartitions("p", "ghost", F.col("doc_id").desc_nulls_last(), "text")
    return made.mapInArrow(fingerprinted, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
