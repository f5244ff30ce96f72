"""Plain-Python versions of the corpus operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text, lower=False):
    data = (text or "").encode()
    return (data.translate(LOWER) if lower else data).split()


def quality(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if counts[x] > 1 for k in range(5)}
    return (
        len(w),
        sum(len(x.decode()) for x in w),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def removals(texts, span=35):
    """(words, removed, kept words) of each text."""
    all_words = [words(t) for t in texts]
    counts = Counter(tuple(w[i : i + span]) for w in all_words for i in range(len(w) - span + 1))
    out = []
    for w in all_words:
        keep = [True] * len(w)
        for i in range(len(w) - span + 1):
            if counts[tuple(w[i : i + span])] > 1:
                keep[i : i + span] = [False] * span
        kept = [x for x, k in zip(w, keep) if k]
        out.append((len(w), len(w) - len(kept), kept))
    return out


def sha(kept):
    return hashlib.sha256(b" ".join(kept)).hexdigest()


def shingles(w, width):
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def classes(rows, num, den, width):
    """n-grams and smallest linked id of each document."""
    sets = {d: shingles(words(t, lower=True), width) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if not sets[a] or not sets[b] or len(sets[a]) * den < num * len(sets[b]) or len(sets[b]) * den < num * len(sets[a]):
                continue
            shared = len(sets[a] & sets[b])
            if shared * den >= num * (len(sets[a]) + len(sets[b]) - shared):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: (len(sets[d]), root(d)) for d in ids}


def contained(docs, items, width=5):
    out = set()
    for i, text in items:
        own = words(text, lower=True)
        k = min(width, len(own))
        need = shingles(own, k) if own else frozenset()
        for d, other in docs:
            if d is None or i is None or not need:
                continue
            w = words(other, lower=True)
            shared = len(need & {tuple(w[j : j + k]) for j in range(len(w) - k + 1)})
            if 5 * shared >= 4 * len(need):
                out.add((d, i, len(need), shared))
    return out


def lm(rows, learn, least=2, prior=50.0):
    """Tokens, known, N, base and model score of each row."""
    tokens = [(d, words(t, lower=True) + [b"\n"]) for d, t in rows]
    counts, pairs = Counter(), Counter()
    for d, w in tokens:
        if learn(d):
            counts.update(w)
            pairs.update(zip(w, w[1:]))
    total, vocabulary = sum(counts.values()), len(counts)
    pairs = {k: n for k, n in pairs.items() if n >= least}
    context = Counter()
    for (v, _), n in pairs.items():
        context[v] += n

    def low(x):
        return (counts[x] + 0.5) / (total + 0.5 * (vocabulary + 1))

    out = []
    for _, w in tokens:
        score = math.log10(low(w[0]))
        for v, x in zip(w, w[1:]):
            score += math.log10((pairs.get((v, x), 0) + prior * low(x)) / (context[v] + prior))
        out.append((len(w), sum(counts[x] > 0 for x in w), total, sum(math.log10(low(x)) for x in w), score))
    return out


def remainder(d):
    return zlib.crc32(str(d).encode()) % 5
