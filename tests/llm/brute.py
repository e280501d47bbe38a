"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
from collections import Counter, defaultdict

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class Sets:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def shingle_set(text, k, lower=True):
    data = (text or "").encode()
    words = (data.translate(LOWER) if lower else data).split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)}


def jaccard(docs, k, percent):
    """[(doc_id, n_shingles, component_id)] of (doc_id, text) rows."""
    sets = [(d, shingle_set(t, k)) for d, t in docs]
    parts = Sets([d for d, _ in sets if d is not None])
    holders = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, (d, s) in enumerate(sets):
        met = Counter(j for x in s for j in holders[x] if j > i)
        for j, both in met.items():
            e, other = sets[j]
            if None not in (d, e) and 100 * both >= percent * (len(s) + len(other) - both):
                parts.join(d, e)
    return [(d, len(s), None if d is None else parts.root(d)) for d, s in sets]


def byte_repeats(docs, length):
    """[(doc_id, n_bytes, n_removed, n_spans, kept_sha256)]; a null doc_id is above all others."""
    rank = lambda d: float("inf") if d is None else d
    texts = [(d, (t or "").encode()) for d, t in docs]
    least = {}
    for d, b in texts:
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            least[w] = min(least.get(w, float("inf")), rank(d))
    out = []
    for d, b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if least[b[i:i + length]] < rank(d):
                gone[i:i + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def word_repeats(docs, length):
    """[(doc_id, n_words, n_removed, kept_sha256)]"""
    texts = [(d, (t or "").encode().split()) for d, t in docs]
    times = Counter(tuple(w[i:i + length]) for _, w in texts for i in range(len(w) - length + 1))
    out = []
    for d, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if times[tuple(w[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def copies(docs):
    """[(doc_id, keep_id, group_size, text_sha256)]"""
    groups = defaultdict(list)
    for d, t in docs:
        groups[t or ""].append(d)
    out = []
    for d, t in docs:
        some = [x for x in groups[t or ""] if x is not None]
        out.append((d, max(some) if some else None, len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()))
    return out


def vectors(rows, least):
    """[(vec_id, n_links, component_id)] of (vec_id, embedding, label)"""
    import math

    fine = [(i, e, lab) for i, e, lab in rows if i is not None and lab is not None and e is not None
            and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    parts, links = Sets([r[0] for r in rows if r[0] is not None]), Counter()
    for x in range(len(fine)):
        for y in range(x):
            (i, a, p), (j, b, q) = fine[x], fine[y]
            if p != q or len(a) != len(b):
                continue
            cosine = sum(u * v for u, v in zip(a, b)) / math.sqrt(sum(u * u for u in a) * sum(v * v for v in b))
            if cosine >= least:
                links[x] += 1
                links[y] += 1
                parts.join(i, j)
    of = {id(r[1]): links[k] for k, r in enumerate(fine)}
    return [(i, of.get(id(e), 0), None if i is None else parts.root(i)) for i, e, _ in rows]
