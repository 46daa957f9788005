"""Operators 11 and 12 against the libraries, text by text."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import alignment, pieces, queries

A, B = queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")
PARTS = [*"abcde  \n.;,(){}'-<>0é한🙂", " ", "　", "\t", "\r", "\x1c", "\x85", "\x00", "​", "�", "ﬁ", "²", "the", "ing", " of", "    ", "\r\n", "\n\n", "<s>", "<|endoftext|>", "<0x41>", "'s ", "12345"]


def texts(seed, n, parts, longest=60):
    r = random.Random(seed)
    return ["".join(r.choice(parts) for _ in range(r.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def given():
    odd = [None, "", " ", "  ", "\n", " \nfoo", "a  ", "▁x", "x ▁ y", "▁▁", "word " * 3000, "x" * 5000, "a\n" * 400, "same text here", "same text here"]
    return odd + texts(1, 250, PARTS) + texts(2, 60, [*PARTS, "▁"]) + texts(3, 40, ["plain ", "words ", "only, ", "with\nlines "], 200)


@pytest.fixture(scope="module")
def docs(spark, given):
    rows = [(None if k == 20 else k, t, 7, "k", b"w", 1) for k, t in enumerate(given)]
    return spark.createDataFrame(rows, "doc_id long, text string, n long, key string, words binary, `group` int").repartition(5)


@pytest.fixture(scope="module")
def folder(docs, tmp_path_factory):
    """The documents as a table that the registered queries read."""
    made = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{made}/documents.parquet")
    return made


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=B)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("memo", [1_200_000, 300])
def test_coding_as_the_library_does(spark, docs, folder, given, library, memo, monkeypatch):
    made = pieces.Encoder(B)
    monkeypatch.setattr(pieces, "MEMO", memo)
    monkeypatch.setattr(pieces, "PARTS", memo)
    for t in given:
        at, ends = made.encode([t])
        assert made.ids_of(at).tolist() == library.encode(t or "") and ends.tolist() == [len(at)]
    if memo == 300:
        return
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.QUERIES["op12_sentencepiece"](spark, folder).collect()}
    want = {}
    for k, t in enumerate(given):
        ids = library.encode(t or "")
        want[None if k == 20 else k] = len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))
    assert got == want
    coded = pieces.encode(docs, B)
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in coded.collect()} == {None if k == 20 else k: library.encode(t or "") for k, t in enumerate(given)}
    assert {r.doc_id: r.text for r in pieces.decode(coded, B).collect()} == {None if k == 20 else k: library.decode(library.encode(t or "")) for k, t in enumerate(given)}


@pytest.mark.parametrize("short", [0, 32])
def test_agenda_merges_highest_scores_first(short, library, monkeypatch):
    """The list and the heap, on whole texts without any cut."""
    monkeypatch.setattr(pieces, "SHORT", short)
    vocabulary = pieces.Pieces(B)
    for t in texts(5, 300, PARTS) + ["ab" * 2000, "a" * 4001]:
        assert vocabulary.ids(("▁" + t.replace(" ", "▁"))) == library.encode(t) or not t


def test_decoding_any_ids(library):
    r, vocabulary = random.Random(3), pieces.Pieces(B)
    for _ in range(3000):
        ids = [r.choice([0, 1, 2, 259, 264, *range(3, 259), r.randrange(32000)]) for _ in range(r.randint(0, 12))]
        assert vocabulary.decode(np.array(ids, np.int64)) == library.decode(ids), ids


def test_a_wrong_id_is_noticed(monkeypatch):
    made = pieces.Encoder(B)
    monkeypatch.setattr(made.pieces, "merged", lambda part: list(part))
    with pytest.raises(RuntimeError, match="differ from the library"):
        made.encode(["some words that merge"])


def brute_alignment(given, library):
    """Every text by itself and whole, groups and links by their definition."""
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(A)
    a_side.encode_special_tokens = True
    of, names = alignment.byte_alphabet(), {i: t for t, i in a_side.get_vocab().items()}
    rows, counts = [], Counter()
    for t in given:
        raw = f" {t}".encode()
        a = [(i, bytes(of[c] for c in names[i])) for i in a_side.encode(f" {t}", add_special_tokens=False).ids] if t else []
        b = []
        for i in library.encode(t) if t else []:
            p = library.id_to_piece(i)
            b.append((i, bytes([int(p[3:-1], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode()))
        if not t or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            rows.append(None)
            continue
        ends = []
        for side in (a, b):
            at, found = 0, {}
            for k, (i, x) in enumerate(side):
                at += len(x)
                found[at] = (k, i)
            ends.append(found)
        links, groups, x, y = [], [], 0, 0
        for e in sorted(ends[0].keys() & ends[1].keys()):
            (p, i), (q, j) = ends[0][e], ends[1][e]
            links.append((i, j))
            groups.append(",".join(str(i) for i, _ in a[x : p + 1]) + "|" + ",".join(str(i) for i, _ in b[y : q + 1]))
            x, y = p + 1, q + 1
        counts.update(links)
        rows.append((len(a), len(b), links, groups))
    best = defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, links, groups = r
            out.append((n_a, n_b, len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), sha(";".join(groups))))
    return out, counts


def test_alignment_against_brute_force(spark, docs, folder, given, library):
    got = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op11_alignment"](spark, folder).collect()}
    want, counts = brute_alignment(given, library)
    assert any(w[1] for w in want) and sum(w[6] == "" for w in want) > 5
    assert got == {None if k == 20 else k: w for k, w in enumerate(want)}
    assert {(r.a_id, r.b_id): r.n for r in alignment.pair_counts(docs, A, B).collect()} == dict(counts)


def test_alignment_in_many_groups(spark, given, library, monkeypatch):
    """A memory that is begun anew and groups that end early, in one task's own process."""
    monkeypatch.setattr(alignment, "MEMO", 60)
    monkeypatch.setattr(alignment, "GROUP_BYTES", 2000)
    monkeypatch.setattr(alignment, "ROWS", 7)
    monkeypatch.setattr(alignment.T, "CHUNK_BYTES", 500)
    monkeypatch.setattr(alignment.T.chunks, "__defaults__", (500,))
    import types

    import pyarrow as pa

    caught = {}

    class Docs:  # stands for a DataFrame: keeps the function that tasks run
        sparkSession = spark

        def select(self, *_):
            return self

        def mapInArrow(self, run, schema):
            caught["run"] = run
            return self

    alignment.aligned(Docs(), A, B)
    monkeypatch.setattr(alignment, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 3)))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(given)), pa.int64()), pa.array(given, pa.string())], ["doc_id", "text"])
    rows = [r for b in caught["run"](iter([batch])) for r in b.to_pylist()]
    assert len({r["group"] for r in rows}) > 5
    counts, want = Counter(), brute_alignment(given, library)
    for r in rows:
        if r["kind"] == alignment.KEY:
            counts[(r["key"] & 0xFFFFFFFF, r["key"] >> 32)] += r["n"]
    assert counts == want[1]
    made = spark.createDataFrame([tuple(r[c] for c in alignment._NAMES) for r in rows], alignment._SCHEMA)
    asked = made.where(F.col("kind") == alignment.KEY)
    shards = asked.groupBy("key").agg(F.sum("n").alias("n"))
    highest = shards.groupBy(F.shiftright("key", 32).alias("b")).agg(F.max("n").alias("highest"))
    got = {r[0]: tuple(r)[1:] for r in alignment.finished(made, alignment.looked_up(asked, shards), highest).collect()}
    assert got == dict(enumerate(want[0]))


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "one"), (1, "one")]])
def test_small_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert alignment.alignment(docs, A, B).count() == len(rows)
    assert pieces.round_trip(docs, B).count() == len(rows)
    assert pieces.decode(pieces.encode(docs, B), B).count() == len(rows)


def test_counts_of_missing_keys_are_zero(spark):
    asked = spark.createDataFrame([(1, 5), (2, 5), (1, 9)], "`group` long, key long")
    shards = spark.createDataFrame([(5, 3), (4, 1)], "key long, n long")
    assert sorted(map(tuple, alignment.looked_up(asked, shards).collect())) == [(1, 5, 3), (1, 9, 0), (2, 5, 3)]
    assert alignment.looked_up(asked, shards.limit(0)).where("n = 0").count() == 3
