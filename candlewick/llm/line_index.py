"""A minimal perfect hash over 128-bit keys, with compact arrays beside it.

Built level by level: keys whose slot in a level's bit array is theirs alone stay
there, the others go to the next level. A key's number is the rank of its bit, so
the arrays (fingerprint, count, first document) have one cell per key. Keys that
still collide after ``LEVELS`` levels are kept in a small sorted list.
"""

from __future__ import annotations

import io

import numpy as np

LEVELS = 32
SPACE = 2.0  # bits per key and level


def _mix(x: np.ndarray, level: int) -> np.ndarray:
    """64-bit finalizer, different for every level."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _key(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return _mix(high.view(np.uint64), LEVELS) ^ low.view(np.uint64)


class LineIndex:
    def __init__(self, parts: dict[str, np.ndarray]):
        self.parts = parts
        self.words, self.sizes = parts["words"], parts["sizes"]
        self.offsets = np.concatenate(([0], np.cumsum(self.sizes))).astype(np.int64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.rank = np.concatenate(([0], np.cumsum(counts)))

    @classmethod
    def build(cls, high: np.ndarray, low: np.ndarray, count: np.ndarray, first: np.ndarray,
              named: np.ndarray | None = None) -> LineIndex:
        """Index of distinct keys (int64 halves) with their count, first document and whether that has an id."""
        named = np.ones(len(high), dtype=bool) if named is None else named
        keys, left = _key(high, low), np.arange(len(high))
        levels, sizes, placed = [], [], []
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, -(-int(SPACE * len(left)) // 64) * 64)
            at = (_mix(keys[left], level) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size)[at] == 1
            bits = np.zeros(size, dtype=np.uint8)
            bits[at[alone]] = 1
            levels.append(np.packbits(bits, bitorder="little").view("<u8"))
            sizes.append(size)
            order = np.argsort(at[alone])
            placed.append(left[alone][order])
            left = left[~alone]
        rest = left[np.lexsort((low[left], high[left]))]
        order = np.concatenate([*placed, rest]).astype(np.int64)
        return cls({
            "words": np.concatenate(levels) if levels else np.zeros(0, "<u8"),
            "sizes": np.array(sizes, dtype=np.int64),
            "fingerprint": (low[order].view(np.uint64) >> np.uint64(32)).astype(np.uint32),
            "count": count[order].astype(np.int64), "first": first[order].astype(np.int64), "named": named[order],
            "rest_high": high[rest], "rest_low": low[rest]})

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Cell of each key; -1 where the fingerprint shows that the key is not indexed."""
        keys, cell = _key(high, low), np.full(len(high), -1, dtype=np.int64)
        left = np.arange(len(high))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = (_mix(keys[left], level) % np.uint64(size)).astype(np.int64) + self.offsets[level]
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            cell[left[hit]] = (self.rank[at >> 6] + below)[hit]
            left = left[~hit]
        base = len(self.parts["first"]) - len(self.parts["rest_high"])
        rest = {k: base + i for i, k in enumerate(zip(self.parts["rest_high"].tolist(),
                                                      self.parts["rest_low"].tolist()))}
        for i in left.tolist():
            cell[i] = rest.get((int(high[i]), int(low[i])), -1) if rest else -1
        known = cell >= 0
        cell[known] = np.where(self.parts["fingerprint"][cell[known]]
                               == (low[known].view(np.uint64) >> np.uint64(32)).astype(np.uint32), cell[known], -1)
        return cell

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.parts)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> LineIndex:
        with np.load(io.BytesIO(data), allow_pickle=False) as parts:
            return cls({n: parts[n] for n in parts.files})
