"""CRC-32 of word features, for whole batches of texts at once.

A CRC without its initial and final complement is linear: it is the XOR of one
contribution per byte, and a byte's contribution depends only on its value and
its distance from the end. ``POSITION`` holds those contributions for the last
``SPAN`` bytes; the CRC of a span is the XOR of its bytes' entries
(``bitwise_xor.reduceat`` over all spans of a batch) and of a constant of its
length (the CRC of that many zero bytes). Longer spans are cut into blocks of
``SPAN`` bytes that are folded from the front: four bytes of the table's far
end carry a block's value over the next block.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np

#: Distances from the end in the position table, and the block size of longer spans.
SPAN = 64
#: Blocks expanded to bytes at once: bounds the scratch arrays to a few tens of megabytes.
BLOCKS = 1 << 16


@functools.cache
def position_table() -> np.ndarray:
    """``[distance, byte]``: a byte's contribution to the CRC at that distance from the end."""
    last = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        last = np.where(last & 1, (last >> 1) ^ np.uint32(0xEDB88320), last >> 1).astype(np.uint32)
    rows = [last]
    for _ in range(SPAN - 1):
        rows.append((rows[-1] >> 8) ^ last[rows[-1] & 255])
    return np.array(rows, dtype=np.uint32)


@functools.cache
def length_constant(n: int) -> int:
    """What initial and final complement add to the CRC of ``n`` bytes."""
    zeros, crc = bytes(min(n, 1 << 16)), 0
    for at in range(0, n, 1 << 16):
        crc = zlib.crc32(zeros[:n - at], crc)
    return crc


def _blocks(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XOR of the contributions of each block of 1 to ``SPAN`` bytes."""
    table, out = position_table().ravel(), np.empty(len(starts), dtype=np.uint32)
    for a in range(0, len(starts), BLOCKS):
        n = sizes[a:a + BLOCKS]
        ends = np.cumsum(n)
        at = np.arange(ends[-1])
        source = at + np.repeat(starts[a:a + BLOCKS] - (ends - n), n)
        distance = np.repeat(ends - 1, n) - at
        out[a:a + BLOCKS] = np.bitwise_xor.reduceat(table[distance * 256 + data[source]], ends - n)
    return out


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Unsigned CRC-32 of ``data[start:end]`` for every span; spans may overlap, none is empty."""
    if not len(starts):
        return np.empty(0, dtype=np.uint32)
    size = ends - starts
    count = (size + SPAN - 1) // SPAN                       # blocks of a span; only the first may be short
    head = size - (count - 1) * SPAN
    crc = _blocks(data, starts, head)
    long = np.flatnonzero(count > 1)
    if len(long):
        more, table = count[long] - 1, position_table()
        first = np.concatenate([[0], np.cumsum(more)])
        step = np.arange(first[-1]) - np.repeat(first[:-1], more)
        rest = _blocks(data, np.repeat(starts[long] + head[long], more) + step * SPAN,
                       np.full(first[-1], SPAN, dtype=np.int64))
        order = np.argsort(-more, kind="stable")            # spans that still have a block come first
        long, more, first = long[order], more[order], first[:-1][order]
        for k in range(more[0]):
            n = np.searchsorted(-more, -k, side="left")
            old = crc[long[:n]]
            crc[long[:n]] = (table[SPAN - 1, old & 255] ^ table[SPAN - 2, (old >> 8) & 255]
                             ^ table[SPAN - 3, (old >> 16) & 255] ^ table[SPAN - 4, old >> 24]
                             ^ rest[first[:n] + k])
    lengths, which = np.unique(size, return_inverse=True)
    return crc ^ np.array([length_constant(int(n)) for n in lengths], dtype=np.uint32)[which]


def _byte_rules() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A"):ord("Z") + 1] += 32
    word = np.zeros(256, dtype=bool)
    word[ord("0"):ord("9") + 1] = word[ord("a"):ord("z") + 1] = word[128:] = True
    return lower, word


LOWER, IS_WORD = _byte_rules()


def word_features(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, and text number and bucket of every feature (all words, then all word pairs).

    ``data`` holds the UTF-8 bytes of the texts end to end, ``offsets`` their
    ends, from 0. A-Z are lower-cased; a word is a run of 0-9, a-z and non-ASCII.
    """
    texts = len(offsets) - 1
    low = LOWER[data]
    inside = IS_WORD[low]
    before = np.concatenate([[False], inside[:-1]])
    before[offsets[:-1][offsets[:-1] < len(data)]] = False  # a word ends with its text
    after = np.concatenate([inside[1:], [False]])
    ends_of_texts = offsets[1:][offsets[1:] > offsets[0]]
    after[ends_of_texts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    size = np.flatnonzero(inside & ~after) + 1 - starts
    text = np.searchsorted(offsets, starts, side="right") - 1
    n_words = np.bincount(text, minlength=texts)
    # the words joined by single spaces, so that a pair of words is one span
    begin = np.cumsum(size + 1) - size - 1
    joined = np.full(int((size + 1).sum()), 32, dtype=np.uint8)
    joined[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = low[inside]
    pair = np.flatnonzero(text[:-1] == text[1:])
    crc = crc32_spans(joined, np.concatenate([begin, begin[pair]]),
                      np.concatenate([begin + size, begin[pair + 1] + size[pair + 1]]))
    return n_words, np.concatenate([text, text[pair]]), crc % np.uint32(buckets)


def text_slices(column, most: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) of runs of rows of an Arrow string column without nulls,
    of about ``most`` bytes or one longer text each."""
    import pyarrow as pa

    wide = pa.types.is_large_string(column.type)
    _, at, held = column.buffers()
    at = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, side="right")) - 1)
        yield row, data[at[row]:at[end]], at[row:end + 1] - at[row]
        row = end
