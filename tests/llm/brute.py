"""The plain way to every result, for small inputs."""

import hashlib
import re

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text.encode()) if text else []


def shingles(text):
    lower = [w.translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")) for w in words(text)]
    return {tuple(lower[i : i + 5]) for i in range(max(1, len(lower) - 4))} if lower else set()


def components(names, links):
    parent = {n: n for n in names}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in names}


def near_texts(docs):
    sets = {d: shingles(t) for d, t in docs}
    ids = sorted(sets)
    links = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    found = components(ids, links)
    return {(d, len(sets[d]), found[d], found[d] == d) for d in ids}


def repeats(docs, k=13):
    first, out = {}, set()
    for d, t in sorted(docs):
        w = words(t)
        for i in range(len(w) - k + 1):
            first.setdefault(tuple(w[i : i + k]), d)
    for d, t in docs:
        w = words(t)
        gone = {j for i in range(len(w) - k + 1) if first[tuple(w[i : i + k])] < d for j in range(i, i + k)}
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.add((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def near_vectors(rows, threshold=0.98):
    ids = [r[0] for r in rows]
    units = np.array([np.asarray(r[1], np.float32).astype(float) for r in rows])
    units /= np.linalg.norm(units, axis=1)[:, None]
    close = units @ units.T >= threshold
    links = [(a, b) for a in range(len(ids)) for b in range(a) if close[a, b] and rows[a][2] == rows[b][2]]
    degree = np.bincount([x for link in links for x in link], minlength=len(ids))
    found = components(ids, [(ids[a], ids[b]) for a, b in links])
    return {(i, int(n), found[i], found[i] == i) for i, n in zip(ids, degree)}


def top_k(rows, k=5, every=50):
    values = [(i, [int(np.floor(256.0 * float(np.float32(x)))) for x in v]) for i, v in rows]
    out = set()
    for q, x in values:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in values if i != q)
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out
