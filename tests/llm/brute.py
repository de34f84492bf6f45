"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, n):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def jaccard_components(docs: dict, n: int, percent: int) -> dict:
    sets = {d: shingles(t, n) for d, t in docs.items()}
    parent = {d: d for d in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = sets[a], sets[b]
            both = len(x & y)
            if both and 100 * both >= percent * (len(x) + len(y) - both):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {d: (len(sets[d]), find(d)) for d in ids}


def near(a, b):
    """Whether two word lists of at least 8 words are one word apart."""
    if min(len(a), len(b)) < 8 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def dedup_lines(docs: dict) -> dict:
    """Texts by doc_id without lines that have an equal or near line earlier."""
    seen, out = [], {}
    for d in sorted(docs):
        kept = []
        for line in (docs[d] or "").split("\n"):
            w = tuple(words(line))
            if w and any(w == o or near(w, o) for o in seen):
                seen.append(w)
                continue
            if w:
                seen.append(w)
            kept.append(line)
        out[d] = "\n".join(kept)
    return out


def water_fill(sizes: dict, weights=(5, 2, 1), epochs=3) -> dict:
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(epochs * sizes[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if share[s] > epochs * sizes[s]}
        if not above:
            return share | {s: float(epochs * sizes[s]) for s in capped}
        capped |= above


def kneser_ney(texts: list[str], order: int, discounts, uniform: float, start="\x00"):
    """Probability of a character after a context, straight from the definition."""
    counts = [defaultdict(int) for _ in range(order + 1)]
    for t in texts:
        row = start * (order - 1) + t
        for i in range(order - 1, len(row)):
            counts[order][row[i - order + 1 : i + 1]] += 1
    for o in range(order - 1, 0, -1):
        for g in counts[o + 1]:
            counts[o][g[1:]] += 1
    off = [None] * (order + 1)
    followers = [defaultdict(list) for _ in range(order + 1)]
    for o in range(1, order + 1):
        off[o] = discounts([sum(c == i for c in counts[o].values()) for i in range(1, 5)])
        for g in counts[o]:
            followers[o][g[:-1]].append(g)

    def d(o, c):
        return min(off[o][min(c, 3) - 1], c)

    def p(context, ch):
        o = len(context) + 1
        below = uniform if o == 1 else p(context[1:], ch)
        seen = followers[o].get(context)
        if not seen:
            return below
        total = sum(counts[o][g] for g in seen)
        c = counts[o].get(context + ch, 0)
        own = (c - d(o, c)) / total if c else 0.0
        return own + sum(d(o, counts[o][g]) for g in seen) / total * below

    def loss(text):
        row = start * (order - 1) + text
        return -sum(math.log(p(row[i - order + 1 : i], row[i])) for i in range(order - 1, len(row))) / max(1, len(text))

    return loss
