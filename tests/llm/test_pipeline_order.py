"""Stages 1, 4 and 5 of the pipeline against plain versions, and the order that packing reads."""

import hashlib
import math

import brute
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash

import corpus_pipeline
from llm import quality, queries
from llm.common import materialize, table


def packed_in_order(pieces):
    """[(doc_id, token ids)] in the order of sequences and offsets."""
    out = []
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        ids = np.frombuffer(p.ids, "<u4").tolist()
        if p.start:
            assert out[-1][0] == p.doc_id and len(out[-1][1]) == p.start
            out[-1][1].extend(ids)
        else:
            out.append((p.doc_id, ids))
    return out


def test_packing_follows_the_order_of_files(spark, tmp_path):
    """Files of unequal size are read largest first; sequences follow the file numbers nevertheless."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.tokenizer_path())
    texts = [f"text number {k} has words. " * (1 + 7 * k % 40) for k in range(400)]
    cuts = [0, 30, 32, 250, 260, 400]
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        rows = pa.table({"doc_id": pa.array([(7 * i) % 400 for i in range(a, b)], pa.int64()), "text": texts[a:b]})
        pq.write_table(rows, tmp_path / f"part-{k:05d}-x-c000.parquet")
    docs = spark.read.parquet(str(tmp_path))
    got = packed_in_order(corpus_pipeline.pack_windows(spark, docs, "").collect())
    assert got == [((7 * i) % 400, [*plain.encode(t, add_special_tokens=False).ids, 2]) for i, t in enumerate(texts)]


def brute_quality(docs, trusted, buckets):
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    raw = lambda v: (v & ((1 << 64) - 1)).to_bytes(8, "little")

    def grams(t):
        h = [signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in brute.words(t)]
        pairs = [signed(xxhash.xxh64(raw(b), seed=xxhash.xxh64(raw(a), seed=42).intdigest()).intdigest()) for a, b in zip(h, h[1:])]
        return [x % buckets for x in h + pairs]

    of = [(i, t, grams(t)) for i, t in docs]
    counts = np.zeros((2, buckets))
    for i, _, g in of:
        for b in g:
            counts[:, b] += (1, i in trusted)
    p = np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * buckets))
    kept = []
    for i, t, g in of:
        n, _, _, _, again = brute.base_counts(t)
        if n >= 10 and 100 * again <= 20 * n and sum(p[1, b] - p[0, b] for b in g) / max(1, len(g)) >= quality.THRESHOLD:
            kept.append(i)
    return kept


def brute_mix(docs):
    """doc_id of every copy in the order of training positions; docs: (doc_id, text, source)."""
    by, size = {}, {i: len(brute.words(t)) for i, t, _ in docs}
    for i, _, s in docs:
        by.setdefault(s, []).append(i)
    names = sorted(by, key=lambda s: (s is None, s or ""))
    weight, slope = ({s: x[k % 3] for k, s in enumerate(names)} for x in ((5, 2, 1), (0.5, 0.0, -0.5)))
    total = {s: sum(size[i] for i in by[s]) for s in names}
    target, left, free = {}, 1.5 * sum(total.values()), list(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * total[s]]
        target |= {s: 2.0 * total[s] for s in over} if over else {s: level * weight[s] for s in free}
        left -= sum(target[s] for s in over)
        free = [s for s in free if s not in over] if over else []
    out = []
    for s in names:
        at = 0
        for _ in range(2):
            for i in sorted(by[s], key=lambda i: (hashlib.md5(f"10:{i}".encode()).hexdigest(), i)):
                u, k = (at + size[i] / 2) / target[s], slope[s]
                if u < 1:
                    out.append((2 * u / ((1 - k) + math.sqrt((1 - k) ** 2 + 4 * k * u)), i))
                at += size[i]
    return [i for _, i in sorted(out)]


def test_stages_against_brute_force(spark, sf):
    from tokenizers import Tokenizer

    docs = table(spark, sf, "documents")
    rows = [(r.doc_id, r.text or "", r.source) for r in docs.collect()]
    trusted = {r.doc_id for r in table(spark, sf, "labels").where("quality = 1").collect()}
    first = corpus_pipeline.quality_rules(spark, docs, sf)
    assert sorted(r.doc_id for r in first.collect()) == sorted(brute_quality([r[:2] for r in rows], trusted, quality.buckets_for(docs)))

    mixed = materialize(corpus_pipeline.mix_sources(spark, docs.repartition(7), sf), "mixed")
    stored = mixed.select("doc_id", "text", "_metadata.file_name", "_metadata.row_index").collect()
    stored = [(r.doc_id, r.text or "") for r in sorted(stored, key=lambda r: (r.file_name, r.row_index))]
    assert [i for i, _ in stored] == brute_mix(rows)

    plain = Tokenizer.from_file(queries.tokenizer_path())
    pieces = corpus_pipeline.pack_windows(spark, mixed, sf).collect()
    assert packed_in_order(pieces) == [(i, [*plain.encode(t, add_special_tokens=False).ids, 2]) for i, t in stored]


def test_a_worker_keeps_one_operator_s_memory(spark):
    """The next stage's tasks run in packing's workers: its words go when another operator begins there."""
    from types import SimpleNamespace

    import pyarrow as pa

    from llm import jaccard, packing, repeats
    from llm.queries import tokenizer_path

    task = SimpleNamespace(mapInArrow=lambda f, schema: f)
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["one two three four five six"])], ["doc_id", "text"])
    own = pa.RecordBatch.from_arrays([pa.array([1])] * 3 + [pa.array([b"word " * 200])], ["a", "b", "c", "text"])
    begins = [(jaccard.summaries(SimpleNamespace(select=lambda *a: task)), batch), (repeats._anchored(task, 400, False), own)]
    for run, rows in begins:
        packing.word_tokens(tokenizer_path()).encode([b"some words"])
        assert packing._made
        assert list(run(iter([rows]))) and not packing._made
    again = packing.word_tokens(tokenizer_path())
    assert again.encode([b"some words"])[0].tolist()[-1] == packing.END
