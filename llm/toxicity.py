"""Operator 5: toxicity by maximum-scoring segments.

Tokens score the log-odds of the toxic class under a hierarchy of Dirichlet priors (class, 4-byte stem, 5-byte
stem, token), minus a drift that makes clean text score below zero. A linear-time scan finds every maximal segment
of a document; under the null model its score follows an extreme-value law, so a segment of score S in a document of m
tokens is expected K * m * exp(-lambda * S) times by chance. The evidence -log(expected) of the significant segments is
summed and mapped to 0..1 by a logistic curve fitted on the training rows, each scored without its own counts.

The model holds three hashed tables of a fixed number of counts and a few scalars, whatever the input. It is fitted
on every training row; nothing is sampled.

Defined cases: null or empty text has no segment and the lowest evidence; several label rows of a document count as
toxic if one is 1, null labels are no labels; without training rows of both classes every score is the share of
toxic rows (0 without any); repeated rows are scored alike; an empty table gives an empty result; whole texts are scored,
however long; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import text as T
from llm.common import materialize, small_batches, with_ids

BITS, STRENGTH, DRIFT, STEMS = 18, 10.0, 0.5, (4, 5)
SIGNIFICANT = 0.01  # a segment counts when fewer than this many of its score are expected in its document by chance
EVIDENCE = (-15.0, 60.0)
_SIZE = 1 << BITS
_BREAK = np.array([not (chr(i).isalnum() or i >= 128) for i in range(256)])
_HIST = (-15.0, 15.0, 600)
_EULER = 0.5772156649015329


@dataclass(frozen=True)
class Model:
    tables: np.ndarray  # float32 (levels, classes, buckets): token counts of clean and toxic training rows
    share: float  # of toxic tokens
    lam: float = 1.0
    log_k: float = 0.0
    slope: float = 0.0
    intercept: float = 0.0


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    data = T.LOWER[data]
    starts, ends, first = T.words(data, offsets, _BREAK)
    levels = [np.minimum(ends, starts + n) for n in STEMS] + [ends]
    return starts, ends, first, [(T.spans_hash(data, starts, e) >> np.uint64(64 - BITS)).astype(np.int64) for e in levels]


def _scores(model: Model, hashed: list[np.ndarray], own: np.ndarray | None = None) -> np.ndarray:
    """Log-odds minus drift; own: class of each token's document, whose count of one is taken out of the tables."""
    odds = np.full(len(hashed[0]), model.share)
    for table, h in zip(model.tables, hashed, strict=True):
        clean, toxic = table[0][h].astype(float), table[1][h].astype(float)
        if own is not None:
            clean, toxic = np.maximum(clean - (own == 0), 0), np.maximum(toxic - (own == 1), 0)
        odds = (toxic + STRENGTH * odds) / (clean + toxic + STRENGTH)  # mean of the posterior, the next level's prior
    prior = math.log(model.share / (1 - model.share))
    return np.log(odds / (1 - odds)) - prior - DRIFT


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) by the linear-time scan; runs of one sign are taken as one."""
    positive = scores > 0
    if not positive.any():
        return []
    edges = np.flatnonzero(np.diff(positive)) + 1
    begin = np.concatenate(([0], edges))
    sums = np.add.reduceat(scores, begin).tolist()
    end = np.concatenate((edges, [len(scores)])).tolist()
    begin = begin.tolist()
    found: list[list] = []  # start, end, sum before start, sum at end
    total = 0.0
    for b, e, s in zip(begin, end, sums, strict=True):
        if s <= 0:
            total += s
            continue
        new = [b, e, total, total + s]
        total += s
        while True:
            j = len(found) - 1
            # the last segment that starts from a lower sum; those skipped can never join again
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                new.append(j)
                found.append(new[:5])
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
    return [(b, e, hi - lo) for b, e, lo, hi, _ in found]


def _each(data: np.ndarray, offsets: np.ndarray, model: Model, toxic: np.ndarray | None = None):
    """Token scores of a chunk and, for each document, its segments and number of tokens."""
    starts, ends, first, hashed = _tokens(data, offsets)
    own = None if toxic is None else np.repeat(toxic, np.diff(first))
    s = _scores(model, hashed, own)
    return s, [(starts, ends, first[i], maximal_segments(s[first[i] : first[i + 1]]), int(first[i + 1] - first[i])) for i in range(len(offsets) - 1)]


def _evidence(lam: float, log_k: float, scores: list[float], m: int) -> float:
    """Summed -log(expected) of the significant segments, or that of the best one."""
    lone = [lam * s - log_k - math.log(m) for s in scores]
    strong = [x for x in lone if x > -math.log(SIGNIFICANT)]
    return min(max(sum(strong) if strong else max(lone, default=EVIDENCE[0]), EVIDENCE[0]), EVIDENCE[1])


def _logistic(hist: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Slope and intercept fitted to (evidence, clean rows, toxic rows) by damped Newton steps."""
    x, c, t = (np.array(v, float) for v in zip(*hist, strict=True))
    a, b = 0.0, math.log((t.sum() + 1) / (c.sum() + 1))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = (c + t) * p * (1 - p) + 1e-9
        r = t - (c + t) * p
        g = np.array([(r * x).sum() - 0.01 * a, r.sum()])
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 1.0 / max(abs(step).max(), 1e-12))
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the rows of docs that have a label (doc_id, toxic)."""
    small_batches(docs.sparkSession)
    one = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    train = with_ids(docs.select("doc_id", "text"), one).select("toxic", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(STEMS) + 1, 2, _SIZE), np.int64)
        for b in batches:
            data, offsets = T.utf8(b.column(1))
            toxic = (np.array(b.column(0).to_pylist()) == 1).astype(np.int64)
            for lo, hi in T.chunks(offsets):
                _, _, first, hashed = _tokens(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                own = np.repeat(toxic[lo:hi], np.diff(first))
                for level, h in enumerate(hashed):
                    for c in (0, 1):
                        sums[level, c] += np.bincount(h[own == c], minlength=_SIZE)
        flat = sums.transpose(0, 2, 1).reshape(-1, 2)
        at = np.flatnonzero(flat.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(flat[at, 0]), pa.array(flat[at, 1])], ["at", "clean", "toxic"])

    found = train.mapInArrow(counted, "at int, clean long, toxic long").groupBy("at").agg(F.sum("clean"), F.sum("toxic")).toArrow()  # (levels * buckets) rows at most
    flat = np.zeros(((len(STEMS) + 1) * _SIZE, 2), np.float32)
    flat[found.column(0).to_numpy(), 0], flat[found.column(0).to_numpy(), 1] = found.column(1).to_numpy(), found.column(2).to_numpy()
    tables = np.ascontiguousarray(flat.reshape(len(STEMS) + 1, _SIZE, 2).transpose(0, 2, 1))
    clean, toxic = (float(tables[-1, c].sum(dtype=np.float64)) for c in (0, 1))
    if not clean or not toxic:
        p = toxic / (clean + toxic) if clean + toxic else 0.0
        return Model(tables[:, :, :0], p)
    shared = docs.sparkSession.sparkContext.broadcast(Model(tables, toxic / (clean + toxic)))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, hist = shared.value, np.zeros(_HIST[2], np.int64)
        names = ["toxic", "m", "segments", "bin", "n"]
        for b in batches:
            data, offsets = T.utf8(b.column(1))
            toxic = (np.array(b.column(0).to_pylist()) == 1).astype(np.int64)
            for lo, hi in T.chunks(offsets):
                s, each = _each(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], model, toxic[lo:hi])
                own = np.repeat(toxic[lo:hi], [e[4] for e in each])
                hist += np.histogram(np.clip(s[own == 0], _HIST[0], _HIST[1] - 1e-9), _HIST[2], _HIST[:2])[0]
                k = hi - lo
                yield pa.RecordBatch.from_arrays([pa.array(toxic[lo:hi]), pa.array([e[4] for e in each], pa.int64()), pa.array([[x[2] for x in e[3]] for e in each], pa.list_(pa.float64())), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64())], names)
        at = np.flatnonzero(hist)
        yield pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.list_(pa.float64())), pa.array(at.astype(np.int32)), pa.array(hist[at])], names)

    seen = materialize(train.mapInArrow(scanned, "toxic long, m long, segments array<double>, bin int, n long"), "segments")
    bins = {r.bin: r.n for r in seen.where("bin is not null").groupBy("bin").agg(F.sum("n").alias("n")).collect()}  # 600 rows at most
    lam = _lambda(bins)
    rows = seen.where("toxic is not null and m > 0")
    best = F.coalesce(F.array_max("segments"), F.lit(0.0))
    log_k = (rows.where("toxic = 0").agg(F.avg(lam * best - F.log("m"))).first()[0] or 0.0) - _EULER
    lone = F.transform("segments", lambda s: lam * s - log_k - F.log("m"))
    strong = F.filter(lone, lambda x: x > -math.log(SIGNIFICANT))
    x = F.when(F.size(strong) > 0, F.aggregate(strong, F.lit(0.0), lambda a, v: a + v)).otherwise(F.coalesce(F.array_max(lone), F.lit(EVIDENCE[0])))
    x = F.round(F.greatest(F.least(x, F.lit(EVIDENCE[1])), F.lit(EVIDENCE[0])) * 4) / 4
    hist = rows.groupBy(x.alias("x")).agg(F.count_if(F.col("toxic") == 0).alias("c"), F.count_if(F.col("toxic") == 1).alias("t")).collect()  # 301 rows at most
    slope, intercept = _logistic([(r.x, r.c, r.t) for r in hist])
    return replace(shared.value, lam=lam, log_k=log_k, slope=slope, intercept=intercept)


def _lambda(bins: dict[int, int]) -> float:
    """The positive root of sum(p * exp(lambda * s)) = 1 over the clean tokens' scores."""
    width = (_HIST[1] - _HIST[0]) / _HIST[2]
    s = np.array([_HIST[0] + (k + 0.5) * width for k in bins])
    p = np.array(list(bins.values()), float)
    p /= p.sum()
    if (s > 0).sum() == 0 or (p * s).sum() >= 0:
        return 1.0
    lo, hi = 1e-6, 1.0
    while (p * np.exp(hi * s)).sum() < 1:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(mid * s)).sum() < 1 else (lo, mid)
    return float(hi)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, passages array<struct<start, end, log_expected>>: significant segments by UTF-8 byte offsets."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("log_expected", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            data, offsets = T.utf8(b.column(1))
            for lo, hi in T.chunks(offsets):
                ids = b.column(0).slice(lo, hi - lo)
                if not m.tables.size:
                    yield pa.RecordBatch.from_arrays([ids, pa.array([m.share] * (hi - lo)), pa.array([[]] * (hi - lo), kind)], ["doc_id", "score", "passages"])
                    continue
                _, each = _each(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], m)
                out, spans = [], []
                for i, (starts, ends, at, segments, n) in enumerate(each):
                    x = _evidence(m.lam, m.log_k, [s for _, _, s in segments], n)
                    out.append(1 / (1 + math.exp(-max(min(m.slope * x + m.intercept, 30.0), -30.0))))
                    base = offsets[lo + i] - offsets[lo]
                    logs = [(p, q, m.log_k + math.log(n) - m.lam * s) for p, q, s in segments]
                    spans.append([{"start": int(starts[at + p] - base), "end": int(ends[at + q - 1] - base), "log_expected": e} for p, q, e in logs if e < math.log(SIGNIFICANT)])
                yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "passages"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, passages array<struct<start: long, end: long, log_expected: double>>")
