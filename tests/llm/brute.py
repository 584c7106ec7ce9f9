"""Plain-Python versions of the corpus operators, for comparison on small inputs."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def shingle_set(text, width=5):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    if len(w) < width:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def near_components(rows, percent):
    """doc_id -> (n_shingles, component) by comparing all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    index = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            index[g].append(i)
    pairs = defaultdict(int)
    for ids in index.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                pairs[a, b] += 1
    for (a, b), n in pairs.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def remove_repeats(rows, window):
    """doc_id -> (n_words, n_removed, kept words joined)."""
    places = defaultdict(int)
    split = [(i, words(t)) for i, t in rows]
    for _, w in split:
        for k in range(len(w) - window + 1):
            places[tuple(w[k : k + window])] += 1
    out = {}
    for i, w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if places[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out
