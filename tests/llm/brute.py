"""Plain versions of the operators' definitions, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingle_set(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_groups(docs):
    sets = {i: shingle_set(t) for i, t in docs}
    ids = sorted(sets)
    links = []
    by = defaultdict(set)
    for i in ids:
        for s in sets[i]:
            by[s].add(i)
    tried = set()
    for group in by.values():
        for a in group:
            for b in group:
                if a < b and (a, b) not in tried:
                    tried.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= 80 * len(sets[a] | sets[b]):
                        links.append((a, b))
    comp = components(ids, links)
    return {i: (len(sets[i]), comp[i]) for i in ids}


def without_repeats(docs, length=400):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256); rows with equal ids may not differ in text."""
    raw = [(i, (t or "").encode()) for i, t in docs]
    n = Counter(r[p : p + length] for _, r in raw for p in range(len(r) - length + 1))
    out = []
    for i, r in raw:
        hit = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if n[r[p : p + length]] > 1:
                hit[p : p + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(hit)))
        kept = bytes(c for c, h in zip(r, hit) if not h)
        out.append((i, len(r), sum(hit), spans, hashlib.sha256(kept).hexdigest()))
    return out


def base_counts(text):
    w = words(text)
    text = text or ""
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = set()
    for i in range(len(w) - 4):
        if seen[tuple(w[i : i + 5])] > 1:
            hit.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def content(blocks):
    """Blocks (text, tags, linked, level, heading) whose smoothed and weighted ratio reaches the cut between two clusters."""
    if not blocks:
        return []
    raw = [math.log(1 + max(0, len(t) - k) / (1 + n)) for t, n, k, _, _ in blocks]
    weight = lambda d: math.exp(-d * d / 2) if d <= 3 else 0.0
    ratio = [sum(v * weight(abs(i - j)) for j, v in enumerate(raw)) / sum(weight(abs(i - j)) for j in range(len(raw))) for i in range(len(raw))]
    values = [0.0, *ratio]
    centres = min(values), max(values)
    for _ in range(50):
        far = [v for v in values if v > sum(centres) / 2]
        near = [v for v in values if v <= sum(centres) / 2]
        if not far:
            break
        centres = sum(near) / len(near), sum(far) / len(far)
    cut = min(sum(centres) / 2, math.log(41))
    kept = [v * (1, 4, 6)[b[3]] > cut - 1e-12 for v, b in zip(ratio, blocks)]
    return [b[0] for i, b in enumerate(blocks) if kept[i] or any(all(x[4] for x in blocks[i:j]) and kept[j] for j in range(i + 1, len(blocks)))]


def minhash(text, byte, base, mult, short, a, b):
    """The fingerprint of a text in plain integers: least of a[k] * shingle + b[k], mixed, its top 16 bits, as hex."""
    full = (1 << 64) - 1

    def mix(x):
        x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & full
        x = ((x ^ x >> 27) * 0x94D049BB133111EB) & full
        return x ^ x >> 31

    words_ = [w.encode() for w in words(text)]
    hashed = [mix((sum(byte[c] * pow(base, i, 1 << 64) for i, c in enumerate(w)) + len(w) * short) & full) for w in words_]
    if not hashed:
        return "ffff" * len(a)
    if len(hashed) < 5:
        shingles = [mix((sum(h * m for h, m in zip(hashed, mult)) + len(hashed) * short) & full)]
    else:
        shingles = [mix(sum(h * m for h, m in zip(hashed[i : i + 5], mult)) & full) for i in range(len(hashed) - 4)]
    least = [min((x * s + y) & full for s in shingles) for x, y in zip(a, b)]
    return b"".join(min(mix(v) >> 48, 65534).to_bytes(2, "little") for v in least).hex()


def maximal(scores):
    """All maximal scoring segments by definition: the best one first, then those left and right of it."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > 1e-12 and (best is None or total > best[2] + 1e-12):
                best = (i, j + 1, total)
    if best is None:
        return []
    i, j, _ = best
    return maximal(scores[:i]) + [best] + [(a + j, b + j, s) for a, b, s in maximal(scores[j:])]


def toxicity(texts, labels, given):
    """doc_id -> (score, passages) with the constants of the module given."""
    import numpy as np

    tokens = {i: [(m.start(), m.end(), m[0]) for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", (t or "").encode())] for i, t in texts.items()}
    levels = [lambda w: w[:4].lower(), lambda w: w[:5].lower(), lambda w: w.lower()]
    counts = [Counter(), Counter(), Counter()]
    for i, y in labels.items():
        for _, _, w in tokens[i]:
            for k, of in enumerate(levels):
                counts[k][of(w), y] += 1
    clean, toxic = (sum(n for (_, c), n in counts[2].items() if c == y) for y in (0, 1))
    share = toxic / (clean + toxic)

    def scores(i, own=None):
        out = []
        for _, _, w in tokens[i]:
            odds = share
            for k, of in enumerate(levels):
                c, t = (max(counts[k][of(w), y] - (own == y), 0) for y in (0, 1))
                odds = (t + given.STRENGTH * odds) / (c + t + given.STRENGTH)
            out.append(math.log(odds / (1 - odds)) - math.log(share / (1 - share)) - given.DRIFT)
        return out

    train = {i: scores(i, y) for i, y in labels.items()}
    low, high, n = given._HIST
    centres = [low + (math.floor((s - low) / (high - low) * n) + 0.5) * (high - low) / n for i, y in labels.items() if y == 0 for s in train[i]]
    f = lambda x: sum(math.exp(x * s) for s in centres) / len(centres) - 1
    a, b = 1e-6, 1.0
    if max(centres) > 0 and sum(centres) < 0:  # else there is no such root, and 1 stands for it
        while f(b) < 0:
            b *= 2
        for _ in range(100):
            a, b = ((a + b) / 2, b) if f((a + b) / 2) < 0 else (a, (a + b) / 2)
    lam = b
    best = [lam * max([s for _, _, s in maximal(train[i])], default=0.0) - math.log(len(train[i])) for i, y in labels.items() if y == 0 and train[i]]
    log_k = sum(best) / len(best) - 0.5772156649015329

    def evidence(values, m):
        lone = [lam * s - log_k - math.log(m) for _, _, s in values]
        strong = [x for x in lone if x > -math.log(given.SIGNIFICANT)]
        return min(max(sum(strong) if strong else max(lone, default=given.EVIDENCE[0]), given.EVIDENCE[0]), given.EVIDENCE[1])

    points = [(math.floor(evidence(maximal(train[i]), len(train[i])) * 4 + 0.5) / 4, y) for i, y in labels.items() if train[i]]
    x, y = np.array([p for p, _ in points]), np.array([q for _, q in points], float)
    slope, cut = 0.0, 0.0
    for _ in range(500):  # the same penalised likelihood, climbed by small steps
        p = 1 / (1 + np.exp(-np.clip(slope * x + cut, -30, 30)))
        g = np.array([((y - p) * x).sum() - 0.01 * slope, (y - p).sum()])
        w = p * (1 - p) + 1e-9
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g) * 0.2
        slope, cut = slope + step[0], cut + step[1]
        if abs(step).max() < 1e-12:
            break
    out = {}
    for i in texts:
        values = maximal(scores(i))
        e = evidence(values, len(tokens[i]))
        spans = [(tokens[i][p][0], tokens[i][q - 1][1]) for p, q, s in values if log_k + math.log(len(tokens[i])) - lam * s < math.log(given.SIGNIFICANT)]
        out[i] = (1 / (1 + math.exp(-max(min(slope * e + cut, 30), -30))), spans)
    return out


def least_cost(t, penalty, size):
    """Least padding plus penalties of a run from t[0] to t[-1], over every way back from every cut."""
    best = [0]
    for j in range(1, len(t)):
        i, least = j - 1, None
        while i >= 0 and t[j] - t[i] <= size:
            cost = best[i] + size - (t[j] - t[i])
            least = cost if least is None or cost < least else least
            i -= 1
        best.append(least + penalty[j])
    return best[-1]
