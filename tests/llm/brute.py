"""Plain versions of the operators, for tests."""

from __future__ import annotations

import re
from collections import Counter
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text: str | None, n: int) -> frozenset:
    w = WORD.findall(lower(text or ""))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) or (frozenset([tuple(w)]) if w else frozenset())


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: root(n) for n in nodes}


def jaccard_components(rows, n: int, percent: int) -> list[tuple]:
    """(key, size of set, component) of rows (key, text)."""
    sets = [shingles(t, n) for _, t in rows]
    links = [(i, j) for i, j in combinations(range(len(rows)), 2) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    roots = components(range(len(rows)), links)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[roots[i]] = min(key, least.get(roots[i], key))
    return [(k, len(sets[i]), least.get(roots[i]) if sets[i] else k) for i, (k, _) in enumerate(rows)]


def covered(rows, length: int) -> list[bytearray]:
    """Marks of the bytes inside strings that occur elsewhere; equal rows are each other's elsewhere."""
    seen = Counter(b[i : i + length] for b in rows for i in range(len(b) - length + 1))
    out = []
    for b in rows:
        marks = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                marks[i : i + length] = b"\1" * length
        out.append(marks)
    return out


def repeat_words(text: str | None) -> int:
    w = WORD.findall(text or "")
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    return len({i + k for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for k in range(3)})
