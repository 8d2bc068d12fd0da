"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile("[^\x20\x09-\x0D]+")


def substring(docs, length=13):
    """(id, text) rows -> {(id, text): (n_words, n_removed, sha)}"""
    words = {(i, t): WORD.findall(t or "") for i, t in docs}
    least = {}
    big = float("inf")
    for (i, _), w in words.items():
        for k in range(len(w) - length + 1):
            key = tuple(w[k:k + length])
            least[key] = min(least.get(key, big), big if i is None else i)
    out = {}
    for (i, t), w in words.items():
        gone = set()
        for k in range(len(w) - length + 1):
            if least[tuple(w[k:k + length])] < (big if i is None else i):
                gone.update(range(k, k + length))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, t] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def suffix(docs, length=200):
    """(id, text) rows -> rows (id, n_bytes, n_removed, n_spans, sha), in input order"""
    seen = collections.Counter()
    data = [(t or "").encode() for _, t in docs]
    for b in data:
        seen.update(b[k:k + length] for k in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(docs, data):
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def decontamination(docs, items, window=13):
    """rows (id, n_words, n_hit, n_items, sha of the item ids, contaminated), in input order"""
    phrases = collections.defaultdict(set)
    for name, text in items:
        w = ALNUM.findall(lower(text))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            phrases[tuple(w[k:k + window])].add(name)
    lengths = {len(p) for p in phrases}
    out = []
    for i, text in docs:
        w, hit, found = ALNUM.findall(lower(text)), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                names = phrases.get(tuple(w[k:k + n]))
                if names:
                    hit.update(range(k, k + n))
                    found |= {str(x) for x in names if x is not None}
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return out


def shingles(text, n=2):
    w = WORD.findall(lower(text))
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def near(docs, percent=80, n=2):
    """rows (id, size of the set, component id, kept), in input order"""
    sets = [shingles(t, n) for _, t in docs]
    ids = [float("inf") if i is None else i for i, _ in docs]
    parent = list(range(len(docs)))

    def root(v):
        while parent[v] != v:
            parent[v] = v = parent[parent[v]]
        return v

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b] and min(len(sets[a]), len(sets[b])) * 100 >= percent * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if both * 100 >= percent * (len(sets[a]) + len(sets[b]) - both):
                    parent[root(a)] = root(b)
    least = {}
    for k in range(len(docs)):
        least[root(k)] = min(least.get(root(k), float("inf")), ids[k])
    out = []
    for k, (i, _) in enumerate(docs):
        c = least[root(k)]
        out.append((i, len(sets[k]), None if c == float("inf") else c, ids[k] == c))
    return out


def counts(text):
    """(n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words)"""
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    times = collections.Counter(grams)
    hit = {k + j for k, g in enumerate(grams) if times[g] > 1 for j in range(3)}
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), len(hit))


def whitening(rows, components=4, weights="one", scale=256):
    """(id, vector) rows -> {(id, component): rows of n, deviation, whitened, explained}"""
    import math

    import numpy as np

    whole = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    usual = collections.Counter(len(v) for _, v in whole)
    d = min(usual, key=lambda k: (-usual[k], k))
    x = [(i, tuple(math.floor(c * scale) for c in v)) for i, v in whole if len(v) == d]
    times = collections.Counter(v for _, v in x)
    fit = list(times) if weights == "one" else [v for _, v in x]
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = np.array([s / n for s in sums])
    c = np.array(fit, float) - mean
    values, columns = np.linalg.eigh(c.T @ c / n)
    values, columns = values[::-1], columns[:, ::-1]
    out = collections.defaultdict(list)
    for i, v in x:
        deviation = sum((n * a - s) ** 2 for a, s in zip(v, sums))
        for k in range(min(components, d)):
            out[i, k + 1].append({
                "n": n, "deviation": deviation, "explained": values[k] / values.sum(),
                "whitened": float((np.array(v, float) - mean) @ columns[:, k] / math.sqrt(values[k]))})
    return dict(out)


def token_alignment(docs, a_encode, b_encode, a_bytes, b_bytes):
    """(id, text) rows -> rows as of the query, in input order; whole texts, every pair of tokens tried by its range"""
    made = []
    for _, text in docs:
        a, b = (a_encode(" " + text), b_encode(text)) if text else ([], [])
        wanted = (" " + (text or "")).encode()
        if b"".join(a_bytes[k] for k in a) != wanted or b"".join(b_bytes[k] for k in b) != wanted:
            a, b = [], []

        def spans(ids, table):
            out, at = [], 0
            for k in ids:
                out.append((at, at + len(table[k])))
                at += len(table[k])
            return out

        sa, sb = spans(a, a_bytes), spans(b, b_bytes)
        both = sorted({y for _, y in sa} & {y for _, y in sb})
        groups, low = [], 0
        for high in both:
            groups.append(([k for k, (x, y) in zip(a, sa) if low <= x and y <= high],
                           [k for k, (x, y) in zip(b, sb) if low <= x and y <= high]))
            low = high
        links = [(x, y) for x, (p, q) in zip(a, sa) for y, (r, s) in zip(b, sb) if max(p, r) < min(q, s)]
        made.append((a, b, groups, links))
    count = collections.Counter(p for *_, links in made for p in set(links))
    highest = collections.defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    out = []
    for (i, _), (a, b, groups, links) in zip(docs, made):
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(count[p] == highest[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if a else ""))
    return out
