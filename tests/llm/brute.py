"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter, defaultdict


def spans_of(covered: list[bool]) -> int:
    return sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))


def covered_parts(sequences: list, length: int) -> list[list[bool]]:
    """For each sequence, which of its items lie in a window of ``length`` that starts at two places or more."""
    count = Counter(s[i : i + length] for s in sequences for i in range(len(s) - length + 1))
    out = []
    for s in sequences:
        covered = [False] * len(s)
        for i in range(len(s) - length + 1):
            if count[s[i : i + length]] > 1:
                covered[i : i + length] = [True] * length
        out.append(covered)
    return out


def suffix_digests(rows: list[tuple], length: int) -> list[tuple]:
    data = [(t or "").encode() for _, t in rows]
    out = []
    for (doc_id, _), d, covered in zip(rows, data, covered_parts(data, length)):
        kept = bytes(b for b, c in zip(d, covered) if not c)
        out.append((doc_id, len(d), sum(covered), spans_of(covered), hashlib.sha256(kept).hexdigest()))
    return out


def word_digests(rows: list[tuple], window: int) -> list[tuple]:
    words = [tuple((t or "").encode().split()) for _, t in rows]
    out = []
    for (doc_id, _), w, covered in zip(rows, words, covered_parts(words, window)):
        kept = b" ".join(x for x, c in zip(w, covered) if not c)
        out.append((doc_id, len(w), sum(covered), hashlib.sha256(kept).hexdigest()))
    return out


def weighted_sets(texts: list[str], size: int) -> list[set]:
    out = []
    for text in texts:
        words = (text or "").lower().split()
        grams = Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else Counter()
        out.append({(g, j) for g, n in grams.items() for j in range(n)})
    return out


def classes(ids: list[int], links: list[tuple[int, int]]) -> dict[int, int]:
    parent = {i: i for i in ids}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def near_duplicate_classes(rows: list[tuple], size: int = 5, similarity: float = 0.8) -> dict[int, int]:
    sets = weighted_sets([t for _, t in rows], size)
    holders, common = defaultdict(list), Counter()
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for group in holders.values():
        common.update(itertools.combinations(group, 2))
    links = [(rows[a][0], rows[b][0]) for (a, b), n in common.items() if n >= similarity * (len(sets[a]) + len(sets[b]) - n)]
    return classes([i for i, _ in rows], links)
