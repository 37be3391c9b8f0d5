"""Plain Python versions of what the operators compute, for small inputs."""

from __future__ import annotations

import re
from collections import defaultdict


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def shingles(text: str | None) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0d]+", lower_ascii(text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_duplicates(rows: list[tuple[int, str | None]]) -> set[tuple]:
    """(doc_id, n_shingles, component_id, kept) by comparing every pair that shares a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    having = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            having[x].append(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        shared = defaultdict(int)
        for x in s:
            for j in having[x]:
                if j > i:
                    shared[j] += 1
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {(i, len(s), root(i), root(i) == i) for i, s in sets.items()}
