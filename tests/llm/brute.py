"""Plain versions of operators, for comparison on small tables."""

from __future__ import annotations

import re

WORD = re.compile(r"[^ \t-\r]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text: str | None, size: int = 4) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def jaccard_components(rows: list[tuple], size: int = 4, percent: int = 85) -> list[tuple]:
    """(id, n_shingles, component_id) of (id, text) rows; all pairs that share a shingle are tested."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    where: dict = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        near = {}
        for x in s:
            for j in where[x]:
                if j < i:
                    near[j] = near.get(j, 0) + 1
        for j, c in near.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                parent[find(i)] = find(j)
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            r = find(i)
            least[r] = min(d, least.get(r, d))
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]
