"""Operator 13 against a slow version in plain integers."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from llm import quantize, queries

SCHEMA = "vec_id long, embedding array<float>, label int, code string, n long, part int, v string"


def brute(rows, parts, entries, rounds):
    """vec_id -> (code, error, label_error), and the codebooks' digest."""
    kept = []
    for i, v, label in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(Fraction(float(np.float32(x))) * 256) for x in v], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    width = -(-len(kept[0][1]) // parts)
    cut = [[(v + [0] * (parts * width))[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))

    def assigned(p):
        return [min((far(c[p], e), k) for k, e in enumerate(books[p])) for c in cut]

    for _ in range(rounds):
        for p in range(parts):
            mine = assigned(p)
            for k in range(len(books[p])):
                own = [c[p] for c, (_, m) in zip(cut, mine, strict=True) if m == k]
                if own:
                    books[p][k] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    every = [assigned(p) for p in range(parts)]
    errors = [sum(every[p][r][0] for p in range(parts)) for r in range(len(kept))]
    by_label = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        by_label[label] = by_label.get(label, 0) + e
    out = [(i, "".join(f"{every[p][r][1]:02x}" for p in range(parts)), errors[r], by_label[label]) for r, (i, _, label) in enumerate(kept)]
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def vectors(seed, n, length):
    """Clusters, copies, vectors of equal norm, nulls and odd values; a third under one label."""
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(length)] for _ in range(12)]
    rows = []
    for k in range(n):
        c = r.choice(centres)
        v = [x + r.gauss(0, 0.2) for x in c] if r.random() < 0.7 else [r.choice([-0.5, 0.5]) for _ in c]
        if rows and r.random() < 0.2:
            v = r.choice(rows)[1]
        rows.append((k * 7 % n, v, 1 if k % 3 == 0 else r.choice([None, 2, 3])))
    odd = [None, [], [1.0] * (length - 1) + [None], [float("nan")] * length, [float("inf")] * length, [0.0] * length, [-0.001] * length, [0.25] * (length + 3)]
    return rows + [(n + k, v, None) for k, v in enumerate(odd)] + [(None, [0.5] * length, 5), (3, [0.75] * length, 2), (3, [0.75] * length, 2)]


@pytest.mark.parametrize(("seed", "n", "length", "parts", "entries"), [(0, 300, 32, 16, 64), (1, 120, 10, 4, 16), (2, 40, 16, 16, 64), (3, 0, 16, 16, 64)])
def test_codes_against_brute_force(spark, seed, n, length, parts, entries):
    rows = vectors(seed, n, length)
    df = spark.createDataFrame([(*r, "c", 1, 2, "v") for r in rows], SCHEMA).repartition(6)
    got = quantize.coded(df, parts, entries).collect()
    want, digest = brute(rows, parts, entries, 2)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=str) == sorted(want, key=str)
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_the_query_on_a_table(spark, tmp_path):
    rows = vectors(4, 200, 64)
    spark.createDataFrame([r for r in rows], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.QUERIES["op13_vector_codes"](spark, str(tmp_path))
    want, digest = brute(rows, 16, 64, 2)
    assert sorted(map(tuple, got.select("vec_id", "code", "error", "label_error").collect()), key=str) == sorted(want, key=str)


def test_the_annulus_is_exact():
    r = np.random.default_rng(5)
    for width, entries, spread in ((4, 64, 40), (1, 64, 5), (3, 7, 1), (8, 1, 100), (4, 64, 1 << 25)):
        books = r.integers(-spread, spread, (entries, width))
        books[entries // 2 :] = books[: entries - entries // 2]  # repeated entries: the lower index counts
        x = np.concatenate((r.integers(-spread, spread, (500, width)), books, np.zeros((1, width), np.int64)))
        away = ((x[:, None, :] - books[None]) ** 2).sum(2)
        code, error = quantize.nearest(x, books, pairs=1000)
        assert (code == away.argmin(1)).all() and (error == away.min(1)).all()


def test_most_entries_are_never_compared(monkeypatch):
    """Norms that are spread out leave a small part of the entries to compare."""
    books = np.arange(64)[:, None] * np.full((1, 4), 1000)
    x = np.random.default_rng(1).integers(0, 64_000, (2000, 1)) + np.zeros((1, 4), np.int64)
    seen, annulus = [], quantize.annulus
    monkeypatch.setattr(quantize, "annulus", lambda *a: seen.append(annulus(*a)) or seen[-1])
    quantize.nearest(x, books)
    assert 0 < sum(many.sum() for _, many in seen) < 0.1 * 64 * len(x)


def test_hot_labels_are_dealt(spark, monkeypatch):
    """Beyond the size that is broadcast, labels are joined by a shuffle with frequent ones salted: the rows stay the same."""
    rows = vectors(6, 200, 16)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = sorted(map(tuple, quantize.coded(df).collect()), key=str)
    shared = quantize.join_shared
    monkeypatch.setattr(quantize, "join_shared", lambda rows, keys, on: shared(rows, keys, on, limit=0, hottest=2, salts=5))
    assert sorted(map(tuple, quantize.coded(df).collect()), key=str) == want


def test_large_components_are_refused(spark):
    df = spark.createDataFrame([(1, [3e5] * 16, 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(ValueError, match="fit the sums"):
        quantize.coded(df)
