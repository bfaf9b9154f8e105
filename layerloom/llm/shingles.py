"""Word shingles of many texts at once, as arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pandas as pd

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_30, _27, _31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x + _A).astype(np.uint64)
    x ^= x >> _30
    x *= _B
    x ^= x >> _27
    x *= _C
    x ^= x >> _31
    return x


def words_of(text: str) -> list[str]:
    return text.lower().split()


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in a row, and the number of words of each text."""
    words = [words_of(t) for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    if not counts.sum():
        return np.zeros(0, np.uint64), counts
    codes, names = pd.factorize(np.concatenate([np.array(w, dtype=object) for w in words if w]))
    return pd.util.hash_array(np.asarray(names, dtype=object), categorize=False)[codes], counts


def shingles(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every shingle of ``size`` words. A text with fewer words, but at least one, is one shingle."""
    hashes, counts = word_hashes(texts)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    joined = np.zeros(len(hashes), np.uint64)
    starts = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(hashes)) - starts[owner]
    for k in range(size):  # words beyond a short text's end count as nothing
        here = np.where(place + k < counts[owner], padded[k : k + len(hashes)], np.uint64(0))
        joined = mixed(joined ^ here) if k else here.copy()
    keep = place < np.maximum(counts[owner] - size + 1, 1)
    return owner[keep], mixed(joined[keep])


def elements(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted sets as sets: the j-th occurrence of a shingle in a text is an element of its own. Sorted by text, then hash."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(owner)), 0))
    return owner, mixed(hashes + (np.arange(len(owner)) - first).astype(np.uint64) * _C)
