"""Words, and sets of hashed word shingles, for many documents at once in numpy.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased. A document's set
holds the 64-bit hashes of its distinct runs of ``k`` words; with fewer words, that of its whole
sequence; without words it is empty.
"""

from __future__ import annotations

from functools import cache

import numpy as np

U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: An odd base and its inverse modulo 2**64, for polynomial hashes of words.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the SplitMix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: Bytes that are hashed at once; a longer word stands alone.
_STRETCH = 1 << 21
_LETTERS = mix(np.arange(1, 257, dtype=U) * U(_BASE))


@cache
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word's hash, in order, and each document's first word (one more for the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # a document's first byte follows a gap
    gap = np.concatenate(([True], space))
    starts = np.flatnonzero(~space & (gap[:-1] | edge[:-1]))
    after = np.concatenate((space, [True]))
    ends = np.flatnonzero(~space & (after[1:] | edge[1:])) + 1
    hashes, i = np.empty(len(starts), U), 0
    while i < len(starts):  # a stretch of words at a time, so that the tables of powers stay small
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _STRETCH, "right")))
        a, b = starts[i:j] - starts[i], ends[i:j] - starts[i]
        part = data[starts[i] : ends[j - 1]]
        size = 1 << max(16, (len(part) - 1).bit_length())
        sums = np.zeros(len(part) + 1, U)
        np.cumsum(_LETTERS[_LOWER[part]] * _powers(_BASE, size)[: len(part)], out=sums[1:])
        hashes[i:j] = mix((sums[b] - sums[a]) * _powers(_INVERSE, size)[a] + (b - a).astype(U))
        i = j
    return hashes, np.searchsorted(starts, offsets).astype(np.int64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All documents' sets, each sorted, end to end; and each one's first place."""
    words, first = word_hashes(data, offsets)
    counts = np.diff(first)
    if len(words) >= k:
        joined = words[: len(words) - k + 1].copy()
        for i in range(1, k):
            joined = mix(joined * U(3) + words[i : len(words) - k + 1 + i])
    else:
        joined = np.zeros(0, U)
    sets = []
    for a, n in zip(first[:-1].tolist(), counts.tolist(), strict=True):
        if n >= k:
            own = np.sort(joined[a : a + n - k + 1])
            if len(own) > 1:
                new = own[1:] != own[:-1]
                if not new.all():
                    own = np.concatenate((own[:1], own[1:][new]))
            sets.append(own)
        elif n:
            own = words[a : a + 1].copy()
            for i in range(1, n):
                own = mix(own * U(3) + words[a + i : a + i + 1])
            sets.append(mix(own + U(n)))  # apart from a shingle of the same words' start
        else:
            sets.append(np.zeros(0, U))
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, U)), np.concatenate(([0], np.cumsum(sizes)))
