"""Word shingles as sorted 64-bit hashes, for texts in UTF-8."""

from __future__ import annotations

import numpy as np

#: Word hashes kept per Python worker.
CACHE_WORDS = 300_000
_STEP, _END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHE_WORDS and len(word) <= 40:
            self[word] = h
        return h


_KNOWN = _Words()


def words(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def shingles(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; a shorter text is one shingle, an empty one none."""
    w = words(text)
    if not w:
        return np.zeros(0, dtype=np.uint64)
    size = min(k, len(w))
    h = np.fromiter(map(_KNOWN.__getitem__, w), dtype=np.uint64, count=len(w))
    n = len(w) - size + 1
    with np.errstate(over="ignore"):
        out = h[:n].copy()
        for j in range(1, size):
            out = out * _STEP + h[j:j + n]
        out = (out ^ np.uint64(size)) * _END
        out ^= out >> np.uint64(32)
        out *= _STEP
        out ^= out >> np.uint64(29)
    return np.unique(out)


def shingle_set(text: bytes, k: int) -> frozenset:
    """The shingles themselves, for exact comparison."""
    w = words(text)
    if len(w) < k:
        return frozenset([b" ".join(w)]) if w else frozenset()
    return frozenset(b" ".join(w[i:i + k]) for i in range(len(w) - k + 1))
