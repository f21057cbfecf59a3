"""Plain versions of the operators, for small tables."""

import hashlib
import re
from collections import defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def substring(docs, length=20):
    """doc_id -> (n_words, n_removed, digest) for (doc_id, text) with distinct ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda x: x[0]):
        w = WORD.findall(text or "")
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            if key in seen:
                gone[i : i + length] = [True] * length
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[doc_id] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def exact(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id))
    out = {}
    for text, rows in groups.items():
        keep = min(rows)[1]
        for _, doc_id in rows:
            out[doc_id] = (keep, len(rows), doc_id == keep, hashlib.sha256(text.encode()).hexdigest())
    return out


def vectors(rows, threshold=0.93):
    """vec_id -> (n_links, component) for (vec_id, embedding, label) with distinct ids."""
    good = {}
    for i, v, label in rows:
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = (label, np.array(v, float))
    links, n = [], defaultdict(int)
    ids = sorted(good)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            (la, a), (lb, b) = good[i], good[j]
            if la == lb and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                links.append((i, j))
                n[i] += 1
                n[j] += 1
    found = components([i for i, _, _ in rows], links)
    return {i: (n[i], found[i]) for i in found}


def shingles(text, k=5):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard(docs):
    """doc_id -> (n_shingles, component) for (doc_id, text) with distinct ids."""
    sets = {i: shingles(t) for i, t in docs}
    has = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            has[x].append(i)
    pairs = {(a, b) for v in has.values() if len(v) < 2000 for a in v for b in v if a < b}
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    found = components(sets, links)
    return {i: (len(sets[i]), found[i]) for i in sets}
