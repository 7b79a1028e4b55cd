"""Plain versions of the corpus operators, over rows in memory."""

import re


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near_duplicates(rows, size, percent=80):
    """rows: (doc_id, text) with distinct ids. Returns doc_id -> (set size, smallest reachable doc_id)."""
    sets = {d: shingle_set(t, size) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by_shingle = {}
    for d, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(d)
    for d, s in sets.items():
        common = {}
        for x in s:
            for other in by_shingle[x]:
                if other < d:
                    common[other] = common.get(other, 0) + 1
        for other, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[other]) - n):
                a, b = sorted((find(d), find(other)))
                root[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def common_subsequence(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def license_places(text, phrases):
    """Number of words, and (start, label) of every phrase."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    found = []
    for phrase, label in phrases:
        own = phrase.split()
        found += [(i, label) for i in range(len(words) - len(own) + 1) if words[i : i + len(own)] == own]
    return len(words), sorted(found)


def near_vectors(rows, threshold):
    """rows: (id, vector, label). Returns id -> (links, smallest reachable id)."""
    import numpy as np

    def fine(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [(i, np.array(v, float), k) for i, v, k in rows if k is not None and fine(v)]
    links, root = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, v, k) in enumerate(good):
        for j, w, m in good[:n]:
            if k == m and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (links[i], find(i)) for i in root}
