"""Word shingles as sorted arrays of 64-bit hashes, made in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
_CACHE: dict[bytes, int] = {}
_CACHE_WORDS = 200_000
_M = [np.uint64(pow(0x9E3779B97F4A7C15, k, 1 << 64)) for k in range(16)]


def forget_words() -> None:
    _CACHE.clear()


def words(text: str) -> list[bytes]:
    """A-Z in lower case, split at the ASCII white space: bytes.split() has exactly those characters."""
    return text.encode().lower().split()


def _hashes(tokens: list[bytes]) -> np.ndarray:
    found = list(map(_CACHE.get, tokens))
    if None in found:
        if len(_CACHE) > _CACHE_WORDS:
            _CACHE.clear()
        for k, value in enumerate(found):
            if value is None:
                w = tokens[k]
                value = xxhash.xxh64_intdigest(w)
                if len(w) <= 64:
                    _CACHE[w] = value
                found[k] = value
    return np.array(found, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that the order of the values is as good as random."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's word shingles; fewer words than ``size`` are one shingle, none are none."""
    tokens = words(text)
    if not tokens:
        return np.zeros(0, np.uint64)
    h = _hashes(tokens)
    if len(tokens) < size:
        x = np.uint64(len(tokens))
        with np.errstate(over="ignore"):
            for k, value in enumerate(h):
                x = x + value * _M[k + 1]
        return mixed(np.array([x], np.uint64))
    n = len(h) - size + 1
    x = np.zeros(n, np.uint64) if size != SHINGLE else h[:n] * _M[1]
    for k in range(0 if size != SHINGLE else 1, size):
        x += h[k : k + n] * _M[k + 1]
    return np.unique(mixed(x))


def jaccard_at_least(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct arrays; empty sets link with nothing."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    both = int((a[at] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)
