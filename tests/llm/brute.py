"""Plain versions of the operators on small inputs."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words((text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def components(rows):
    """rows (doc_id, text) -> sorted (doc_id, n_shingles, component_id)."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = {}
    for i, s in enumerate(sets):
        shared = {}
        for g in s:
            for j in having.setdefault(g, []):
                shared[j] = shared.get(j, 0) + 1
            having[g].append(i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in groups.items()}
    return sorted(((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def substring_dedup(rows, window=50):
    """rows (doc_id, text) -> list of (doc_id, n_words, n_removed, kept words)."""
    first = {}
    for doc_id, text in rows:
        w = words(text)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if doc_id is not None and first[tuple(w[k : k + window])] < doc_id:
                gone[k : k + window] = [True] * window
        out.append((doc_id, len(w), sum(gone), [x for x, g in zip(w, gone) if not g]))
    return out


def digest(kept):
    return hashlib.sha256(" ".join(kept).encode()).hexdigest()


def base_counts(text):
    text = text or ""
    w = words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    where = {}
    for k in range(len(w) - 2):
        where.setdefault(tuple(w[k : k + 3]), []).append(k)
    again = {i for ks in where.values() if len(ks) > 1 for k in ks for i in (k, k + 1, k + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again)
