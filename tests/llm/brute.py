"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def smallest_reachable(ids, linked):
    """For each id the smallest one that the boolean matrix ``linked`` reaches; None counts as larger than any other."""
    order = sorted({i for i in ids if i is not None}) + [None]
    labels = np.array([order.index(i) for i in ids])
    while True:
        new = np.array([min(labels[i], labels[linked[i]].min(initial=len(order))) for i in range(len(ids))])
        if (new == labels).all():
            return [order[x] for x in labels]
        labels = new


def fingerprint(text, width=3):
    own = (text or "").translate({c: c + 32 for c in range(65, 91)})
    own = words(own)
    shingles = [" ".join(own[i : i + width]) for i in range(len(own) - width + 1)] or ([" ".join(own)] if own else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            ones[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(shingles))


def simhash(rows, limit=3):
    """rows: (id, text). (id, fingerprint, component)."""
    prints = np.array([fingerprint(t) for _, t in rows], np.uint64)
    linked = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= limit
    return [(i, f"{int(p):016x}", c) for (i, _), p, c in zip(rows, prints, smallest_reachable([i for i, _ in rows], linked))]


def repeats(rows, window):
    """rows with distinct ids: {id: (words, removed, digest)}."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        own = words(text)
        gone = [False] * len(own)
        for at in range(len(own) - window + 1):
            key = tuple(own[at : at + window])
            if key in seen:
                gone[at : at + window] = [True] * window
            seen.add(key)
        kept = [w for w, g in zip(own, gone) if not g]
        out[i] = (len(own), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def near(rows, threshold):
    """rows: (id, vector). (id, links, component)."""
    valid = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    linked = np.zeros((len(rows), len(rows)), bool)
    for a, (_, x) in enumerate(rows):
        for b, (_, y) in enumerate(rows):
            if a != b and valid[a] and valid[b] and len(x) == len(y):
                p, q = np.array(x, float), np.array(y, float)
                linked[a, b] = p @ q / np.sqrt((p @ p) * (q @ q)) >= threshold
    return list(zip([i for i, _ in rows], linked.sum(axis=1).tolist(), smallest_reachable([i for i, _ in rows], linked)))


def targets(sizes, weights=(1, 2, 3), cap=3):
    """{source: words}: the targets, by water filling one round at a time."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        left = sum(weight[s] for s in names if s not in full)
        out = {s: cap * sizes[s] if s in full else rest * weight[s] / left for s in names}
        new = {s for s in names if s not in full and out[s] > cap * sizes[s]}
        if not new:
            return out
        full |= new
