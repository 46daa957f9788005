import glob
import hashlib
import math
import os
import random
import re
import time
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import chat, common, components, fingerprints, html, jaccard, mixing, packing, quality, queries, ranks, repeats, sharding, text, toxicity
from llm.common import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank long, `key` string, n int, size int, before int, hub int, label int"


def docs_frame(spark, rows, extra=True):
    schema = DOCS if extra else "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) + ((7, "k", 1, 2, 3, 4, 5) if extra else ()) for i, t, s in rows], schema)


def sample(seed=0, n=60):
    """Random prose with copies, near copies, shared passages, repeats, blanks, nulls and odd characters."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdéß한🙂") for _ in range(r.randint(1, 6))) for _ in range(150)]
    passage = " ".join(r.choice(vocabulary) for _ in range(140))
    texts = [None, "", " \n\t ", "one", "Two words", "TWO WORDS", "a b c d", "a b c d e", "a  b\tc d e", "x" * 900, "x" * 450]
    while len(texts) < n:
        kind = r.random()
        if kind < 0.25 and len(texts) > 15:
            w = (r.choice(texts) or "").split(" ")
            for _ in range(r.randint(0, max(1, len(w) // 12))):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            texts.append(" ".join(w))
        elif kind < 0.35:
            texts.append(r.choice(texts))
        elif kind < 0.6:
            own = [r.choice(vocabulary) for _ in range(r.randint(0, 60))]
            texts.append(" ".join(own) + ". " + passage + "\n" + " ".join(own[::-1]))
        else:
            texts.append("".join(r.choice(vocabulary) + r.choice([" ", " ", " ", ". ", "\n"]) for _ in range(r.randint(0, 300))))
    return [(i * 3 + 1, t, r.choice(["s1", "s1", "s1", "s2", None])) for i, t in enumerate(texts)]


@pytest.fixture(scope="module", params=[0, 1])
def rows(request):
    return sample(request.param)


def test_fingerprints_of_edits(spark, rows):
    got = {r.doc_id: r for r in fingerprints.with_edits(docs_frame(spark, rows)).collect()}
    order = sorted(((i, t or "") for i, t, _ in rows), reverse=True)
    assert len(got) == len(rows)
    by_text = {}
    for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(t, got[i].fingerprint) == got[i].fingerprint
        w = lambda x: {tuple(brute.words(x)[k : k + 5]) for k in range(max(1, len(brute.words(x)) - 4))}
        true = lambda x, y: len(w(x) & w(y)) / len(w(x) | w(y))
        assert abs(got[i].near_next - true(t, after)) < 0.2 and abs(got[i].near_edited - true(t, edited)) < 0.2
        plain = [text._BYTE.tolist(), text._BASE, text._MULT.tolist(), int(text._SHORT), fingerprints._A.tolist(), fingerprints._B.tolist()]
        assert got[i].fingerprint == brute.minhash(t, *plain) and got[i].edited_fingerprint == brute.minhash(edited, *plain)


@pytest.mark.parametrize("given", [[], [(1, "only one text here", "s")], [(None, "a b c", "s"), (2, None, None), (2, None, None), (None, "a b c", "s")]])
def test_small_tables(spark, given):
    docs = docs_frame(spark, given)
    trusted = docs.where("doc_id = 2").select("doc_id", F.lit(1).alias("toxic"))
    n = len(given)
    assert fingerprints.with_edits(docs).count() == n
    assert quality.quality(docs, trusted).count() == n
    assert jaccard.near_groups(docs).count() == n
    assert repeats.without_repeats(docs).count() == n
    assert packing.pack(docs, queries.tokenizer_path()).count() == n
    assert sharding.stratified_shards(docs).count() == n
    assert mixing.mix_plan(docs).count() == n
    assert toxicity.score(docs, toxicity.fit(docs, trusted)).count() == n
    assert chat.format_chats(spark.createDataFrame([(x[0], 0, x[2], x[1]) for x in given], "conv_id long, turn long, role string, text string")).count() == len({x[0] for x in given})
    assert html.extract(spark.createDataFrame([(x[0], None, x[1]) for x in given], "page_id long, url string, html string")).count() == n


@pytest.mark.parametrize("n", [50_000, 500_000])
def test_fingerprints_of_long_texts(spark, n):
    """Likeness follows the exact Jaccard similarity whatever the length."""
    r = random.Random(n)
    own = [" ".join(f"{r.randrange(1 << 20):x}" for _ in range(n)) for _ in range(2)]
    texts = {3: own[0], 2: own[0][: len(own[0]) // 2] + own[1][len(own[1]) // 2 :], 1: own[1]}
    got = {x.doc_id: x for x in fingerprints.with_edits(docs_frame(spark, [(i, t, "s") for i, t in texts.items()])).collect()}

    def true(x, y):
        x, y = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (x.split(), y.split()))
        return len(x & y) / len(x | y)

    for i, after in ((3, 2), (2, 1), (1, 3)):
        t, nxt = texts[i], texts[after]
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        assert abs(got[i].near_next - true(t, nxt)) < 0.17  # four standard errors of 128 slots
        assert abs(got[i].near_edited - true(t, edited)) < 0.17


def test_fingerprint_without_words_stands_apart():
    sig = fingerprints.of_texts([b"", b" \n", *[f"w{k}".encode() for k in range(3000)]])
    assert (sig[:2] == 65535).all() and (sig[2:] != 65535).all()


def test_recall_of_the_band_join(spark):
    """Of all pairs of Jaccard similarity 0.8 and more, found by comparing every two sets, at least 0.9 are joined."""
    r = random.Random(12)
    rows = []
    for _ in range(40):
        w = [f"w{r.randrange(10**6)}" for _ in range(r.randint(40, 400))]
        for edits in range(r.randint(1, 5)):
            v = list(w)
            for _ in range(edits):
                v[r.randrange(len(v))] = "other"
            rows.append((len(rows), " ".join(v), "s"))
    sets = {i: brute.shingle_set(t) for i, t, _ in rows}
    want = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    group = brute.components(sets, [(p.a, p.b) for p in fingerprints.near_duplicates(docs_frame(spark, rows)).collect()])
    assert len(want) > 50 and sum(group[a] == group[b] for a, b in want) >= 0.9 * len(want)


def test_banded_near_duplicates(spark):
    r = random.Random(3)
    base = [[f"w{r.randrange(500)}" for _ in range(200)] for _ in range(6)]
    rows = []
    for k, w in enumerate(base):
        for c in range(5):
            v = list(w)
            v[r.randrange(200)] = "changed"
            rows.append((10 * k + c, " ".join(v), "s"))
    pairs = fingerprints.near_duplicates(docs_frame(spark, rows)).collect()
    assert all(p.jaccard >= 0.8 and p.a // 10 == p.b // 10 for p in pairs)
    linked = brute.components([x[0] for x in rows], [(p.a, p.b) for p in pairs])
    assert all(linked[i] == 10 * (i // 10) for i, _, _ in rows)


@pytest.mark.parametrize("block", [1000, 3])
def test_banded_pairs_behind_an_unrelated_hub(spark, block, monkeypatch):
    """Pairs that meet only in buckets whose least document is less similar than 0.8 are still joined, in blocks too."""
    monkeypatch.setattr(common, "PAIR_BLOCK", block)
    r = random.Random(7)
    word = lambda: f"v{r.randrange(10**6)}"
    texts, last = [], []
    for _ in range(3):
        base = [word() for _ in range(300)]

        def version(edits):
            v = list(base)  # noqa: B023
            for k in r.sample(range(10, 290, 10), edits):
                v[k] = word()
            return " ".join(v)

        texts += [version(6) for _ in range(40)]
        last += [version(2) for _ in range(2)]
    rows = [(k, t, "s") for k, t in enumerate([*texts, *last, last[0].replace(" ", "  "), last[1]])]
    docs = docs_frame(spark, rows)
    pairs = fingerprints.near_duplicates(docs).collect()
    sets = {i: brute.shingle_set(t) for i, t, _ in rows}
    true = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert all(p.a < p.b and p.jaccard == pytest.approx(true(p.a, p.b)) and p.jaccard >= 0.8 for p in pairs)
    bands = {x.doc_id: set(enumerate(x.bands)) for x in fingerprints.fingerprints(docs).collect()}
    want = [(a, b) for a in sets for b in sets if a < b and bands[a] & bands[b] and true(a, b) >= 0.8]
    least = {}
    for i in sorted(bands, reverse=True):
        least |= dict.fromkeys(bands[i], i)
    assert any(all(least[k] not in (a, b) and true(least[k], b) < 0.8 for k in bands[a] & bands[b]) for a, b in want)  # the case is there
    assert brute.components(sets, [(p.a, p.b) for p in pairs]) == brute.components(sets, want)


def test_quality_counts(spark, rows):
    docs = docs_frame(spark, rows)
    got = {r.doc_id: r for r in quality.quality(docs, docs.where("doc_id % 2 = 0").select("doc_id"), buckets=64, threshold=0.0).collect()}
    texts = {i: t for i, t, _ in rows}
    for i, r in got.items():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.base_counts(texts[i]), texts[i]
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)


@pytest.mark.parametrize("broadcast", [1 << 22, 1])
def test_quality_against_brute_force(spark, rows, broadcast, monkeypatch):
    import xxhash

    monkeypatch.setattr(quality, "BROADCAST_BUCKETS", broadcast)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    raw = lambda v: (v & ((1 << 64) - 1)).to_bytes(8, "little")

    def grams(t):
        h = [signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in brute.words(t)]
        pairs = [signed(xxhash.xxh64(raw(b), seed=xxhash.xxh64(raw(a), seed=42).intdigest()).intdigest()) for a, b in zip(h, h[1:])]
        return [x % 64 for x in h + pairs]

    trusted = {i for i, _, _ in rows if i % 2 == 0}
    docs = docs_frame(spark, rows).withColumns({c: F.lit(1) for c in ("_text", "_words", "_h", "_b", "_k", "_n", "g", "bucket", "llr", "kept")})
    made = quality.quality(docs, docs.where("doc_id % 2 = 0").select("doc_id"), buckets=64, threshold=0.001)
    assert [c for c in made.columns if c in docs.columns] == made.columns[: len(docs.columns) - 2] + ["llr", "kept"]
    full = {r.doc_id: r for r in made.collect()}
    got = {i: r.llr for i, r in full.items()}
    counts = np.zeros((2, 64))
    for i, t, _ in rows:
        for b in grams(t):
            counts[:, b] += (1, i in trusted)
    p = (counts + 0.5) / (counts.sum(1, keepdims=True) + 32)
    ratio = np.log(p[1]) - np.log(p[0])
    for i, t, _ in rows:
        g = grams(t)
        want = sum(ratio[b] for b in g) / max(1, len(g))
        assert got[i] == pytest.approx(want, abs=1e-9)
        assert full[i].text == t and full[i].kept == (not full[i].base_failed and want >= 0.001)
    assert {r.kept for r in full.values() if not r.base_failed} == {True, False}


def test_quality_buckets_grow(spark):
    docs = docs_frame(spark, [(1, "x" * 1000, "s"), (2, None, "s")])
    assert quality.buckets_for(docs) == quality.buckets_for(docs.where("false")) == quality.LEAST_BUCKETS
    long = docs.where("doc_id = 1").select("doc_id", F.repeat("text", 1000).alias("text")).join(spark.range(300))
    assert quality.buckets_for(long) == 1 << 15  # 300 MB


def test_verdicts_are_stable_as_the_corpus_grows(spark):
    """The same documents among eight times as many alike ones keep their verdicts."""
    r = random.Random(2)
    good, junk = [f"good{k}" for k in range(12)], [f"junk{k}" for k in range(12)]
    made = lambda k: (k, " ".join(r.choice(junk if k % 5 == 0 else good) for _ in range(60)), "s")
    rows = [made(k) for k in range(8000)]
    kept = []
    for n, buckets in ((1000, 1 << 7), (8000, 1 << 10)):  # in proportion to the text
        docs = docs_frame(spark, rows[:n])
        found = quality.quality(docs, docs.where("doc_id % 10 = 1").select("doc_id"), buckets)
        kept.append({x.doc_id for x in found.where("kept and doc_id < 1000").collect()})
    assert all(k % 5 for k in kept[1]) and len(kept[0] ^ kept[1]) <= 20




def test_jaccard_groups(spark, rows):
    want = brute.near_groups([(i, t) for i, t, _ in rows])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_groups(docs_frame(spark, rows)).collect()}
    assert got == want


@pytest.mark.parametrize("hot", [1 << 12, 3])
def test_jaccard_groups_of_frequent_cells(spark, hot, monkeypatch):
    """Cells that many documents have: the same links whether a bucket is one or dealt in parts."""
    monkeypatch.setattr(jaccard, "HOT", hot)
    monkeypatch.setattr(jaccard, "COMMON_HERE", 1)
    monkeypatch.setattr(jaccard, "COMMON", 2)
    r = random.Random(8)
    line = "this line stands in nearly every document of the table"
    rows = []
    for k in range(120):
        words = [r.choice("abcdefghijklmnopqrstuvwxyz") * r.randint(1, 3) for _ in range(r.choice([0, 2, 30]))]
        text = " ".join([line, *words]) if k % 4 else " ".join(words * 2)
        rows += [(2 * k, text, None), (2 * k + 1, text.replace("every", "each", 1) if k % 5 == 0 else text, None)]
    keys = []
    prefix = jaccard.prefix_cells
    monkeypatch.setattr(jaccard, "prefix_cells", lambda *a: keys.append(prefix(*a)) or keys[-1])
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard.near_groups(docs_frame(spark, rows)).collect()}
    assert got == brute.near_groups([(i, t) for i, t, _ in rows])
    assert (keys[0].agg(F.max("parts")).first()[0] > 1) == (hot == 3)


def test_one_of_each_goes_by_text(spark):
    """Unlike texts under one id all stay, near copies of either go; columns that clash with those used inside come back as they were."""
    long = lambda w: " ".join(f"{w}{k}" for k in range(40))
    rows = [(1, long("a")), (1, long("b")), (1, long("b")), (5, long("b") + " end"), (6, long("a") + " end"), (7, long("c")), (2, long("c")), (None, long("a")), (None, None), (8, None), (9, ""), (0, long("d")), (7, long("d"))]
    made = [(i, t, 10 * k, "h", k, 2.5, [k]) for k, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(made, "doc_id long, text string, n int, h1 string, `row` int, id double, `one` array<int>")
    got = jaccard.one_of_each(docs)
    assert got.columns == docs.columns
    kept = sorted((r.n // 10 for r in got.collect()))
    assert kept[0] == 0 and kept[1] in (1, 2) and kept[2:] == [6, 7, 8, 9, 10, 11]
    assert all(tuple(r) == made[r.n // 10] for r in got.collect())
    again = [sorted(r.n for r in jaccard.one_of_each(docs.repartition(n)).collect()) for n in (1, 7)]
    assert again[0] == again[1] == [10 * k for k in kept]  # the choice doesn't hang on the order of rows
    repeated = docs.where("n = 0").unionByName(docs.where("n = 0"))
    assert jaccard.one_of_each(repeated).count() == 1


def test_mix_keeps_clashing_columns(spark, rows):
    docs = docs_frame(spark, rows[:30], extra=False)
    extra = {c: F.lit(k) for k, c in enumerate(["_n", "_at", "_h1", "_h2", "h1", "n", "at", "row", "size", "positions", "_key", "rank", "before"])}
    docs = docs.withColumns(extra)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    known = {r.doc_id: tuple(r) for r in docs.collect()}
    got = mixed.collect()
    assert got and all(tuple(r) == known[r.doc_id] for r in got)
    plan = {r.doc_id: r.copies for r in mixing.mix_plan(docs).collect()}
    assert {i: sum(r.doc_id == i for r in got) for i in plan} == plan


@pytest.mark.parametrize("block", [1000, 2])
def test_jaccard_chain_and_hidden_links(spark, block, monkeypatch):
    """Sliding windows over one text: neighbours link, distant ones don't, and all are one component."""
    monkeypatch.setattr(common, "PAIR_BLOCK", block)
    r = random.Random(5)
    stream = [f"t{k}" for k in range(900)]
    rows = [(k, " ".join(stream[8 * k : 8 * k + 120]), "s") for k in range(60)]
    r.shuffle(rows)
    got = {x.component_id for x in jaccard.near_groups(docs_frame(spark, rows)).collect()}
    assert got == {0}
    kept = jaccard.one_of_each(docs_frame(spark, rows)).collect()
    assert [x.doc_id for x in kept] == [0]


def test_sketch_bounds_difference():
    r = np.random.default_rng(1)
    for _ in range(50):
        a = np.unique(r.integers(0, 1 << 63, r.integers(1, 3000), dtype=np.uint64))
        b = np.concatenate((a[r.random(len(a)) < 0.9], r.integers(0, 1 << 63, r.integers(0, 300), dtype=np.uint64)))
        x, y = jaccard._sketches(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
        d = len(set(a.tolist()) ^ set(b.tolist()))
        assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= d and jaccard._differ(jaccard._wide(a), jaccard._wide(b)) <= d


def test_components(spark):
    r = random.Random(2)
    links = [(k, k + 1) for k in range(100, 140)] + [(7, 200 + k) for k in range(30)] + [(r.randrange(300, 340), r.randrange(300, 340)) for _ in range(30)]
    got = {x.node: x.label for x in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {v for e in links for v in e if e[0] != e[1]}
    want = brute.components(nodes | {v for e in links for v in e}, links)
    assert got == {v: want[v] for v in nodes}


def test_pages():
    page = """<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body><nav><a href=x>Home</a></nav>
    <div class="cookie-notice">We use cookies</div><article><header><h1>A &amp; B</h1></header><p>First <b>para</b>
    graph.<br>Same block.<p>Second&nbsp;one<div class="ad">Buy</div><form>Name <input></form><section id="comments"><p>Nice!</section></article>
    <aside>Side</aside><footer>&copy; x</footer>"""
    assert html.main_text(page) == "A & B\n\nFirst para graph. Same block.\n\nSecond one"
    plain = "<div><a href=1>One</a><a href=2>Two</a><a href=3>Three</a></div>" + "".join(f"<div>{'long prose goes here ' * 12}{k}</div>" for k in range(4)) + "<div><a href=4>Four</a> <a href=5>Five</a></div>"
    assert html.main_text(plain).count("long prose") == 48 and "Two" not in html.main_text(plain)
    assert html.main_text(None) == html.main_text("") == html.main_text("<nav>x</nav>") == ""
    assert html.main_text("<article><p>cut off <b>he") == "cut off he"


def test_given_pages_without_their_marks(spark, sf):
    """With the tags that mark the article taken out, the smoothed ratio and the threshold decide: nearly all of its blocks and nothing else."""
    blocks = found = others = 0
    for r in table(spark, sf, "pages").collect():
        marked = html.main_text(r.html).split("\n\n")
        bare = [b for b in html.main_text(re.sub(r"(?i)</?(article|main)\b[^>]*>", "", r.html or "")).split("\n\n") if b]
        blocks, found, others = blocks + len(marked), found + sum(b in bare for b in marked), others + sum(b not in marked for b in bare)
    assert blocks > 200 and found >= 0.95 * blocks and others == 0


def test_pages_where_marks_are_not_the_whole_content():
    """The ratio decides on marked pages too: text outside a teaser's article stays, link runs inside an article go."""
    prose = [f"{'long prose goes here ' * 12}{k}" for k in range(6)]
    links = "<div><a href=1>One</a><a href=2>Two</a></div>" * 4
    teaser = "<article><h2>Card</h2><p>Read about the card here, it is short.</p></article>"
    divs, paragraphs = "".join(f"<div>{t}</div>" for t in prose), "".join(f"<p>{t}</p>" for t in prose)
    for page in (links + divs + links + teaser, f"{links}<main>{paragraphs}</main>{teaser}", f"{teaser}<main>{paragraphs}{teaser}</main>{links}"):
        got = html.main_text(page)
        assert all(t in got for t in prose) and "about the card" in got and "One" not in got
    got = html.main_text(f"<article><h1>Title here</h1>{paragraphs}<ul><li>first item</li><li>second item</li></ul>{links}</article><div>Some stray line</div>{links}")
    assert all(t in got for t in [*prose, "Title here", "first item", "second item"]) and got.count("One") <= 2  # of eight; smoothing reaches over the edge


def test_pages_keep_what_names_only_seem_to_mark():
    prose = [f"{'long prose goes here ' * 12}{k}" for k in range(3)]
    sections = f'<section class="legal-history"><p>{prose[0]}</p></section><div class="share-holders"><p>{prose[1]}</p></div>'
    got = html.main_text(f'<article><h1>T</h1>{sections}<div class="ad-slot-2 big"><p>Buy this long thing now</p></div><p class="comments">Nice</p><p>{prose[2]}</p></article>')
    assert got == "\n\n".join(["T", *prose])
    got = html.main_text(f"<nav><a>x</a></nav><h2>Title</h2><p>{prose[0]}</p><p><![CDATA[{prose[1]}]]></p>" + "<ul><li><a href=1>one</a></li><li><a href=2>two</a></li></ul>" * 3)
    assert got == f"Title\n\n{prose[0]}\n\n{prose[1]}"


@pytest.mark.parametrize("page", ["<p>" + "<b>" * 50_000 + "x" + "</i>" * 50_000, "<i><p>" + "<b>" * 50_000 + "</i>" * 50_000 + "x", "<div>" * 50_000 + "x" + "</p>" * 50_000])
def test_stray_tags_take_time_in_proportion(page):
    """100,000 tags cost about what parsing them does: a scan of the open elements for each would take minutes."""
    best = math.inf
    for _ in range(3):
        began = time.process_time()
        assert html.main_text(page) == "x"
        best = min(best, time.process_time() - began)
    assert best < 3


def test_pages_against_a_slow_version():
    """Pages made from a known list of blocks: the parser finds just those, and the choice is that of plain formulas."""
    r = random.Random(3)
    for _ in range(60):
        page, blocks = [], []

        def put(n, level, hidden):
            for _ in range(n):
                word = lambda: "".join(r.choice("abc é&") for _ in range(r.randint(1, 9)))
                text = " ".join(word() for _ in range(r.choice([1, 3, 60])))
                plain = " ".join(text.split())
                tag, link, bold = r.choice(["p", "div", "li", "h2"]), r.random() < 0.3, r.randint(0, 3)
                inner = "<b>" * bold + text.replace("&", "&amp;") + "</b>" * bold
                page.append(f"<{tag}>" + (f"<a href='#'>{inner}</a>" if link else inner) + f"</{tag}>")
                if plain and not hidden:
                    blocks.append((plain, 2 + 2 * bold + 2 * link, len(text) if link else 0, level, tag == "h2"))

        for _ in range(r.randint(1, 6)):
            name, level, hidden = r.choice([("div", 0, False), ("main", 1, False), ("article", 2, False), ("nav", 0, True), ("div class='cookie-banner'", 0, True)])
            page.append(f"<{name}>")
            put(r.randint(0, 8), level, hidden)
            page.append(f"</{name.split()[0]}>")
        assert html.blocks_of("".join(page)) == blocks
        assert html.chosen(blocks) == brute.content(blocks)


def test_segments_scan():
    def slow(s):
        best = None
        for i in range(len(s)):
            total = 0.0
            for j in range(i, len(s)):
                total += s[j]
                if total > 1e-12 and (best is None or total > best[0] + 1e-12):
                    best = (total, i, j + 1)
        return slow(s[: best[1]]) + [(best[1], best[2], best[0])] + [(a + best[2], b + best[2], c) for a, b, c in slow(s[best[2] :])] if best else []

    r = random.Random(9)
    for _ in range(300):
        s = np.array([r.choice([-3, -2, -1.5, 1, 2.25, 3.125, -0.7]) + r.random() * 0.01 for _ in range(r.randint(1, 14))])
        assert [(a, b, round(c, 6)) for a, b, c in toxicity.maximal_segments(s)] == [(a, b, round(float(c), 6)) for a, b, c in slow(s)]


def test_toxicity_learns(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("aeioulmnrst") for _ in range(r.randint(2, 7)))
    rows, labels = [], []
    for k in range(900):
        w = [word() for _ in range(80)]
        bad = k % 5 == 0
        if bad:
            at = r.randrange(70)
            w[at : at + 4] = [r.choice(["vile", "grubslob", "scumm"]) + r.choice(["", "er", "ing"]) for _ in range(4)]
        rows.append((k, " ".join(w), "s"))
        labels.append((k, int(bad)))
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = docs_frame(spark, rows)
    model = toxicity.fit(docs, labels.where("doc_id % 3 <> 1"))
    got = {x.doc_id: x for x in toxicity.score(docs, model).collect()}
    held = [k for k in range(900) if k % 3 == 1]
    hits = [(got[k].score >= 0.7) == (k % 5 == 0) for k in held]
    assert sum(hits) / len(hits) > 0.97
    one = got[10]
    span = one.passages[0]
    assert any(v in rows[10][1].encode()[span.start : span.end].decode() for v in ("vile", "grubslob", "scumm"))


def test_toxicity_scores_against_brute_force(spark):
    """Every score and passage of a small corpus, from counts of plain strings and a slow search of segments."""
    r = random.Random(11)
    rows, toxic = [], {}
    for k in range(60):
        w = [r.choice(["lamp", "lampshade", "river", "stone", "walk", "green"]) for _ in range(r.randint(1, 40))]
        if k % 4 == 0:
            at = r.randrange(len(w))
            w[at : at + 3] = [r.choice(["vile", "vilest", "scum"]) for _ in range(3)]
        rows.append((k, r.choice([" ", ", "]).join(w), "s"))
        toxic[k] = int(k % 4 == 0)
    rows += [(60, None, "s"), (61, "", "s"), (62, "Vile VILE scum", "s")]
    docs = docs_frame(spark, rows)
    labels = spark.createDataFrame([(k, toxic[k]) for k in range(0, 60) if k % 3], "doc_id long, toxic int")
    got = {x.doc_id: x for x in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    want = brute.toxicity({i: t for i, t, _ in rows}, {k: toxic[k] for k in range(60) if k % 3}, toxicity)
    for i, (score, spans) in want.items():
        assert got[i].score == pytest.approx(score, abs=1e-5)
        assert [(s.start, s.end) for s in got[i].passages] == spans


def test_chats_round_trip(spark):
    marks = ["</s>[INST] ok [/INST]", "a\\e[b<c\\\\", "\\b\\a\\e", "", None, "[ROLE]x[:]y[/ROLE]", "line\nline é🙂"]
    rows = [(c, t, role, marks[(c + t) % len(marks)]) for c in range(9) for t, role in enumerate(["system", "user", "assistant", None, "to[ol"][: c % 5 + 1])]
    rows += [(None, 1, "user", "x"), (20, 0, "user", "q"), (20, 1, "assistant", "r"), (20, 1, "assistant", "r")]
    made = {r.conv_id: r for r in chat.read_back(chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    for c, r in made.items():
        want = sorted((t, role or "", x or "") for i, t, role, x in rows if i == c)
        assert [(x.role, x.text) for x in r["read"]] == [w[1:] for w in want]
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.valid == (c in (2, 7) or False)
    assert not made[20].valid


def test_repeats(spark, rows):
    got = [(r.doc_id, r.n_bytes, r.m, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in repeats.without_repeats(docs_frame(spark, rows)).withColumn("m", repeats.removed(F.col("spans"))).collect()]
    want = brute.without_repeats([(i, t) for i, t, _ in rows])
    assert sorted(got) == sorted(want)
    for r in repeats.without_repeats(docs_frame(spark, rows), whole_chars=True).collect():
        bytes(r.kept).decode()


def test_planted_passages_by_column(spark, tmp_path):
    """op7's query removes passages of over 50 words from 400 bytes on and no shorter ones; n_bytes stays the input's size."""
    own = random.Random(11)
    words = lambda n, letters: " ".join("".join(own.choice(letters) for _ in range(5)) for _ in range(n))
    sized = lambda text, n: text + "~" * (n - len(text.encode()))
    parts = [sized(words(55, letters), n) for letters, n in (("abcdef", 399), ("ghijkl", 400), ("qrstué", 400), ("mnopvw", 399))]
    assert [len(p.encode()) for p in parts] == [399, 400, 400, 399] and len(parts[2]) < 380 and all(len(p.split()) == 55 for p in parts)
    # the last one's next characters differ, but begin with the same byte
    rows = [(2 * k + j, words(20, "abcxyz") + "<["[j] + p + ("éè"[j] if k == 3 else ">]"[j]) + words(20, "abcxyz"), None) for k, p in enumerate(parts) for j in (0, 1)]
    rows += [(8, words(90, "abcxyz"), None), (9, None, None)]
    docs_frame(spark, rows, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    made = queries.QUERIES["op7_suffix_array_dedup"](spark, str(tmp_path))
    assert made.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    got = sorted(map(tuple, made.collect()))
    assert got == sorted(brute.without_repeats([(i, t) for i, t, _ in rows]))
    assert [r[2] for r in got] == [0, 0, 400, 400, 400, 400, 400, 400, 0, 0]
    assert [r[1] for r in got] == [len((t or "").encode()) for _, t, _ in rows]


def test_repeats_in_slices(spark, monkeypatch):
    """Edges of slices of a long text change nothing."""
    rows = [(i, t, None) for i, t in enumerate([("abcdefghij" * 60 + str(k)) * 2 + f"tail {k} " * 50 for k in range(3)])]
    offsets = np.array([0, 5000, 6000, 20000])
    monkeypatch.setattr(text, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(repeats, "SLICE", 2500)
    data = np.frombuffer(bytes(random.Random(0).choice(b"ab") for _ in range(20000)), np.uint8)
    windows = set()
    for begin, end, own in repeats.slices(offsets):
        _, lo, hi, _, _ = repeats.segments(data[begin:end], own)
        for a, b in zip(lo + begin, hi + begin, strict=True):
            windows |= set(range(a, b + 1))
    assert windows == {p for a, b in zip(offsets, offsets[1:]) for p in range(a, b - 399)}
    want = brute.without_repeats([(i, t) for i, t, _ in rows])
    got = [(r.doc_id, r.n_bytes, r.m, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in repeats.without_repeats(docs_frame(spark, rows)).withColumn("m", repeats.removed(F.col("spans"))).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_repeats_within_shorter_ones(spark, rows, limit, monkeypatch):
    """Found within shorter repeats, the long ones are the same; the short ones are those of their own length.

    Also with keys joined by shuffle, a third of all rows sharing one passage, null ids and clashing columns.
    """
    if limit == 0:
        monkeypatch.setattr(repeats, "join_shared", lambda rows, keys, on: common.join_shared(rows, keys, on, limit=0, hottest=3, salts=4))
    own = random.Random(5)
    passage = lambda n: "".join(own.choice("abcdefgh ") for _ in range(n))
    parts = {n: passage(n) for n in (249, 250, 300, 399, 400, 800)}
    rows = rows + [(1000 + k, passage(90) + parts[n] + passage(90), None) for k, n in enumerate([*parts] * 2)]
    rows += [(2000 + k, passage(40) + parts[300] + passage(40), None) for k in range(len(rows) // 2)]
    rows += [(None, passage(300), None), (None, parts[800], None), (None, None, None)]
    docs = docs_frame(spark, rows, extra=False).withColumns({c: F.lit(1) for c in ("n_bytes", "spans", "kept", "mark", "base", "runs", "_row", "_id", "s", "t")})
    made = repeats.without_repeats(docs, passage=250)
    assert made.columns == ["doc_id", "text", "lang", "source", "n_chars", "mark", "base", "runs", "_row", "_id", "s", "t", "n_bytes", "spans", "kept", "passages"]
    got = [(r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest(), sum(s.end - s.start for s in r.passages)) for r in made.collect()]
    texts = [(i, t) for i, t, _ in rows]
    want = [(*x, y[2]) for x, y in zip(brute.without_repeats(texts), brute.without_repeats(texts, 250), strict=True)]
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(got, key=key) == sorted(want, key=key)
    by = {x[0]: x for x in got}
    for k, n in enumerate([*parts] * 2):
        assert (by[1000 + k][2] >= n) == (n >= 400) and (by[1000 + k][5] >= n) == (n >= 250)


def test_scratch_tables_go(spark, rows):
    before = set(glob.glob(f"{common.shared_dir(spark)}/*"))
    assert repeats.without_repeats(docs_frame(spark, rows), passage=250).count() == len(rows)
    assert {os.path.basename(x).split("-")[0] for x in set(glob.glob(f"{common.shared_dir(spark)}/*")) - before} == {"runs"}


def test_packing(spark, rows):
    from tokenizers import Tokenizer

    rows = rows + [(9999, "Long sentence goes on. " * 4000, None), (9998, "word " * 9000, None), (9997, "a <|endoftext|> b<|startoftext|>c", None)]
    plain = Tokenizer.from_file(queries.tokenizer_path())
    want = {i: [*plain.encode(t or "", add_special_tokens=False).ids, 2] for i, t, _ in rows}
    pieces = packing.pack(docs_frame(spark, rows), queries.tokenizer_path()).collect()
    whole, windows = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4").tolist()
        assert len(ids) == p.length and p.doc_tokens == len(want[p.doc_id])
        whole.setdefault(p.doc_id, []).append((p.start, ids))
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert {i: [x for _, ids in sorted(v) for x in ids] for i, v in whole.items()} == want
    for v in windows.values():
        at = 0
        for offset, n in sorted(v):
            assert offset == at
            at += n
        assert at <= 4096


@pytest.mark.parametrize("run", [1 << 23, 60_000, 1])
def test_packing_is_the_best_of_each_run(spark, run):
    """Padding and penalties are the least of each whole run, and padding is within the stated bound; the workers' collector is as it was."""
    r = random.Random(4)
    rows = [(k, "some words to pack here. " * 300, None) for k in range(60)]
    rows += [(100 + k, "".join(r.choice(["word ", "and ", "more ", "end. ", "on, "]) for _ in range(r.choice([3, 40, 900, 9000]))), None) for k in range(60)]
    tokens = packing.WordTokens(queries.tokenizer_path())
    for n in (1, 6):
        split = docs_frame(spark, rows).repartition(n, "doc_id").persist()
        order = [[(x.doc_id, x.text) for x in p] for p in split.rdd.glom().collect()]
        pieces = packing.pack(split, queries.tokenizer_path(), run_tokens=run).orderBy("sequence_id", "offset").collect()
        split.unpersist()
        for part, docs in enumerate(order):
            own = [p for p in pieces if p.sequence_id >> 32 == part]
            while docs:
                k, size = 0, 0
                while k < len(docs) and size < run:
                    size += len(tokens.encode([docs[k][1].encode()])[0])
                    k += 1
                ids, ends, stops = tokens.encode([t.encode() for _, t in docs[:k]])
                t, penalty = packing.candidates(len(ids), ends, stops)
                windows, taken = {}, 0
                while taken < len(ids):
                    p = own.pop(0)
                    assert p.offset == windows.get(p.sequence_id, 0)
                    windows[p.sequence_id] = p.offset + p.length
                    taken += p.length
                assert p.doc_id == docs[k - 1][0] and p.start + p.length == p.doc_tokens and not (own and own[0].offset)
                cuts, cost = np.cumsum(list(windows.values())).tolist(), dict(zip(t.tolist(), penalty.tolist(), strict=True))
                padding = sum(4096 - w for w in windows.values())
                assert padding + sum(cost[c] for c in cuts) == brute.least_cost(t.tolist(), penalty.tolist(), 4096)
                assert padding <= (packing.STEP + packing.INSIDE) * len(windows) + 4096
                docs = docs[k:]
            assert not own

    def collector(batches):
        import gc

        import pyarrow as pa

        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([gc.isenabled()])], ["on"])

    state = spark.range(8, numPartitions=8).mapInArrow(collector, "on boolean").collect()
    assert all(r.on for r in state)


def test_best_cuts_are_best():
    r = random.Random(6)
    for _ in range(200):
        t = [0, *sorted(r.sample(range(1, 60), 9))]
        size = max(max(b - a for a, b in zip(t, t[1:])), r.randint(8, 25))
        penalty = [r.choice([0, 2, 7]) for _ in t]

        def cost(cuts):
            return sum(penalty[j] + size - (t[j] - t[i]) for i, j in zip([0, *cuts], cuts))

        def every(i):
            if i == len(t) - 1:
                return [[]]
            return [[j, *rest] for j in range(i + 1, len(t)) if t[j] - t[i] <= size for rest in every(j)]

        assert cost(packing.best_cuts(t, penalty, size)) == min(map(cost, every(0)))


def test_sharding(spark, rows):
    got = sharding.stratified_shards(docs_frame(spark, rows), shards=7).collect()
    texts = {i: (t or "", s) for i, t, s in rows}
    shards = {}
    for r in got:
        t, s = texts[r.doc_id]
        assert (r.size, r.text_crc32, r.source) == (len(t.encode()) + 8, zlib.crc32(t.encode()), s)
        shards.setdefault(r.shard, []).append(r)
    sizes = [len(v) for v in shards.values()]
    assert max(sizes) - min(sizes) <= 1 and len(got) == len(rows)
    for v in shards.values():
        assert sorted(r.slot for r in v) == list(range(len(v)))
    for source in {s for _, _, s in rows}:
        n = sum(s == source for _, _, s in rows)
        for v in shards.values():
            assert abs(sum(r.source == source for r in v) - n * len(v) / len(rows)) <= 2


def test_sharding_against_brute_force(spark, rows):
    """Places follow from exact fractions: rank within the source, then the order of all fractional ranks."""
    rows = rows + [(7, "same text", "s1"), (7, "same text", "s1"), (None, "no id", ""), (None, None, None)]
    key = lambda i: hashlib.md5(f"9:{'' if i is None else i}".encode()).hexdigest()
    tied = lambda r: (key(r[0]), r[0] is not None, r[0] or 0, len((r[1] or "").encode()), zlib.crc32((r[1] or "").encode()))
    order = []
    for source in {s for _, _, s in rows}:
        own = sorted((r for r in rows if r[2] == source), key=tied)
        name = (source is None, hashlib.md5((source or "").encode()).hexdigest())
        order += [((2 * k + 1) / (2 * len(own)), *name, *tied(r), r[0]) for k, r in enumerate(own)]
    order.sort(key=lambda x: x[:-1])
    n, want, slots = len(order), [], {}
    for at, (*_, size, _, i) in enumerate(order):
        shard = at * 7 // n
        want.append((-1 if i is None else i, size + 8, shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
    got = [(-1 if r.doc_id is None else r.doc_id, r.size, r.shard, r.slot) for r in sharding.stratified_shards(docs_frame(spark, rows), shards=7).collect()]
    assert sorted(got) == sorted(want)


def test_running_sums(spark):
    r = random.Random(8)
    data = [(k, r.choice(["hot", "hot", "a", None]), r.randrange(9)) for k in range(500)]
    got = {x.id: x for x in ranks.running(spark.createDataFrame(data, "id long, g string, v long"), "g", ["id"], F.col("v")).collect()}
    for g in {"hot", "a", None}:
        n = total = 0
        for k, _, v in [d for d in data if d[1] == g]:
            assert (got[k]["rank"], got[k].before) == (n, total)
            n, total = n + 1, total + v
        assert all(got[d[0]].group_rows == n and got[d[0]].group_value == total for d in data if d[1] == g)


def test_mixing(spark, rows):
    plan = mixing.mix_plan(docs_frame(spark, rows)).collect()
    sizes = {i: len(brute.words(t)) for i, t, _ in rows}
    of = {}
    for i, _, s in rows:
        of[s] = of.get(s, 0) + sizes[i]
    names = sorted(of, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    want, left, free = {}, 1.5 * sum(of.values()), list(names)
    while True:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 2 * of[s]]
        if not over:
            break
        for s in over:
            want[s] = 2.0 * of[s]
            left -= want[s]
            free.remove(s)
    want |= {s: level * weight[s] for s in free}
    taken = dict.fromkeys(names, 0)
    for r in plan:
        assert r.size == sizes[r.doc_id] and r.source_size == of[r.source] and r.target == pytest.approx(want[r.source])
        assert r.copies == len(r.positions) <= 2 and all(0 <= p <= 1 + 1e-9 for p in r.positions)
        taken[r.source] += r.size * r.copies
    for s in names:
        assert abs(taken[s] - want[s]) <= max(sizes[i] for i, _, x in rows if x == s)
    mixed = mixing.mix(docs_frame(spark, rows))
    assert mixed.columns == docs_frame(spark, rows).columns and mixed.count() == sum(r.copies for r in plan)


def test_schedule_inverse():
    for slope in (0.5, 0.0, -0.5):
        for u in (0.01, 0.3, 0.77, 1.0):
            t = 2 * u / ((1 - slope) + math.sqrt((1 - slope) ** 2 + 4 * slope * u))
            assert t + slope * (t * t - t) == pytest.approx(u)


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = table(spark, sf, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "jaccard join", "suffix-array dedup", "mixing", "packing"]
    at = docs
    kept = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        made = stage(spark, at, sf)
        assert made.columns == docs.columns
        from llm.common import materialize

        at = materialize(made, "t")
        kept.append({r.doc_id: r.text for r in at.collect()})
    clean = {r.doc_id for r in quality.quality(docs, table(spark, sf, "labels").where("quality = 1")).where("kept").collect()}
    assert set(kept[0]) == clean
    groups = brute.near_groups(kept[0].items())
    assert set(kept[1]) == {c for _, c in groups.values()}
    whole = {i: t.encode() for i, t in kept[1].items()}
    spans = {i: n for i, _, n, _, _ in brute.without_repeats(kept[1].items(), repeats.PASSAGE)}
    for i, raw in whole.items():
        assert 0 <= len(kept[2][i].encode()) - (len(raw) - spans[i]) <= 6 * (1 + spans[i] // repeats.PASSAGE)
    assert corpus_pipeline.run(spark, sf).count() > 0


def test_induced_sorting():
    from llm.suffixes import suffixes

    r = random.Random(1)
    for _ in range(1500):
        t = [r.randint(0, r.choice([0, 1, 2, 5])) for _ in range(r.randint(0, 40))]
        order = sorted(range(len(t)), key=lambda i: t[i:])

        def common(a, b):
            k = 0
            while a + k < len(t) and b + k < len(t) and t[a + k] == t[b + k]:
                k += 1
            return k

        want = order, [0] * bool(t) + [common(a, b) for a, b in zip(order, order[1:])]
        assert suffixes(t, limit=r.choice([1, 3, 1000])) == want


def test_repeats_against_suffix_order(spark, rows):
    from llm.suffixes import repeated_bytes

    rows = rows[:40]
    want = repeated_bytes([(t or "").encode() for _, t, _ in rows], 400, limit=5000)
    got = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in repeats.without_repeats(docs_frame(spark, rows)).collect()}
    assert got == {i: w for (i, _, _), w in zip(rows, want)}
