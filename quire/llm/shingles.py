"""Word shingles of texts as 64-bit hashes, computed for many texts at once.

Words are runs of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased.  A text with fewer words
than the shingle width has one shingle, the whole sequence; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from quire.llm.common import mix

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True
#: A fixed random value for every byte and an odd base.
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        _POWERS[:] = []
        for base in (_BASE, _INVERSE):
            p = np.ones(size, np.uint64)
            done = 1
            factor = base
            while done < size:  # doubling: the next stretch is the stretch so far times base**done
                k = min(done, size - done)
                p[done : done + k] = p[:k] * np.uint64(factor)
                done += k
                factor = factor * factor % (1 << 64)
            _POWERS.append(p)
    return _POWERS[0], _POWERS[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """c with c[i] = sum of value(byte j) * base**j for j < i, modulo 2**64."""
    up, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of the bytes [begin, end), equal for equal bytes at any place."""
    _, down = _powers(len(prefix))
    return (prefix[end] - prefix[begin]) * down[begin]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and the number of words before each text (and in all)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_WHITE[data]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    # A word never crosses from one text to the next.
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    cut = edges[inside[edges] & inside[edges + 1]]
    starts[cut] = True
    ends[cut - 1] = True
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return begin, end, np.searchsorted(begin, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every word and the word offsets of the texts."""
    low = _LOWER[data]
    begin, end, first = words(low, offsets)
    return mix(span_hash(prefix_hash(low), begin, end) + (end - begin).astype(np.uint64)), first


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes (below 2**63) of every text."""
    h, first = word_hashes(data, offsets)
    n = len(h)
    rolled = np.zeros(max(0, n - width + 1), np.uint64)
    factor = 1
    for j in range(width):
        rolled += h[j : n - width + 1 + j] * np.uint64(factor) if n >= width else np.uint64(0)
        factor = factor * 0xD6E8FEB86659FD93 % (1 << 64)
    rolled = (mix(rolled) >> np.uint64(1)).astype(np.int64)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif b > a:
            own, factor = 0, 0x2545F4914F6CDD1D
            for x in h[a:b].tolist():
                own = (own * factor + x + 1) % (1 << 64)
            yield (mix(np.array([own], np.uint64)) >> np.uint64(1)).astype(np.int64)
        else:
            yield np.zeros(0, np.int64)
