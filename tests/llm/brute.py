"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    order = ("assign", "access", "hex")
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(s, order[k], e) for s, k, e in sorted(found)]


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text: str | None) -> set[tuple[str, ...]]:
    own = words(text)
    return {tuple(own[i:i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def jaccard_classes(texts: list[str | None]) -> list[tuple[int, int]]:
    """(smallest member of the class, links) by position."""
    sets = [shingles(t) for t in texts]
    root, links = list(range(len(sets))), [0] * len(sets)

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 5 * both >= 4 * (len(a) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [(find(i), links[i]) for i in range(len(sets))]


def minimax(sizes: list[int], shards: int) -> int:
    """Smallest capacity for a contiguous partition, by trying all of them."""
    def needs(capacity: int) -> int:
        used, filled = 1, 0
        for size in sizes:
            if filled + size > capacity:
                used, filled = used + 1, 0
            filled += size
        return used

    capacity = max(sizes)
    while needs(capacity) > shards:
        capacity += 1
    return capacity
