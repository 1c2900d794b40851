"""Words ``[^\\x20\\x09-\\x0D]+`` of lower-cased (A-Z) texts, as 64-bit hashes, in numpy."""

from __future__ import annotations

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64 bits (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word, words per text, last two bytes of every word)."""
    joined = b" ".join(texts) + b" " * 9
    raw = _LOWER[np.frombuffer(joined, dtype=np.uint8)]
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    text_ends = np.cumsum(sizes + 1)
    counts = np.diff(np.searchsorted(starts, text_ends, side="left"), prepend=0)

    # Eight bytes at a time: the first block of all words, then the next block of the longer ones.
    blocks = np.ndarray((len(raw) - 8,), dtype="<u8", buffer=raw.data, strides=(1,))
    size = ends - starts
    h = mix64((blocks[starts] & _MASK[np.minimum(size, 8)]) + size.astype(np.uint64) * _ODD)
    longer, done = np.flatnonzero(size > 8), 8
    while len(longer):
        block = blocks[starts[longer] + done] & _MASK[np.minimum(size[longer] - done, 8)]
        h[longer] = mix64((h[longer] * _ODD) ^ block)
        done += 8
        longer = longer[size[longer] > done]
    tail = raw[ends - 1].astype(np.uint16) | (np.where(size > 1, raw[ends - 2], 0).astype(np.uint16) << np.uint16(8))
    return h, counts, tail
