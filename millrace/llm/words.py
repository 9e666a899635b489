"""Words and word n-grams of many texts at once, as numpy arrays of 64-bit hashes.

Texts are UTF-8 bytes. Only A-Z is lower-cased. A word is a maximal run of word bytes; both word
classes below hold every byte from 0x80 on, so no character is ever cut.
"""

from __future__ import annotations

import numpy as np

_ALL = np.arange(256)
LOWER = np.where((_ALL >= 65) & (_ALL <= 90), _ALL + 32, _ALL).astype(np.uint8)
#: [^\x20\x09-\x0D]
NOT_SPACE = ~((_ALL == 32) | ((_ALL >= 9) & (_ALL <= 13)))
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F], after lower-casing
ALNUM = ((_ALL >= 48) & (_ALL <= 57)) | ((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n pseudo-random 64-bit numbers, a longer stream begins with a shorter one."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15))


_factors = stream(1, 256)
_order = stream(2, 64) | np.uint64(1)


def factors(n: int) -> np.ndarray:
    global _factors
    if n > len(_factors):
        _factors = stream(1, 2 * n)
    return _factors


def words(texts: list[bytes], keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, offsets, starts, ends, low): text i has the words hashes[offsets[i]:offsets[i + 1]], word j the bytes
    low[starts[j]:ends[j]] of the lower-cased, joined texts.

    A word's hash is multilinear over its bytes, with a factor for each place, so equal words and no others (but for
    chances of 2**-50 or so) share one.
    """
    joined = LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
    inside = np.empty(len(joined) + 1, np.bool_)
    inside[0] = False
    np.take(keep, joined, out=inside[1:])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    begins = np.cumsum([0, *(len(x) + 1 for x in texts)])
    offsets = np.searchsorted(starts, begins)
    if not len(starts):
        return np.empty(0, np.uint64), offsets, starts, ends, joined
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(first[-1] + lengths[-1]) - np.repeat(first, lengths)
    value = joined[inside[1:]].astype(np.uint64)
    value += np.uint64(1)
    value *= factors(int(lengths.max()))[place]
    return mix(np.add.reduceat(value, first) + lengths.astype(np.uint64)), offsets, starts, ends, joined


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words, also of those that cross from one text to the next: len(hashes) - n + 1 of them."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out += hashes[j : j + m] * (_order[j] if n <= len(_order) else stream(2, n)[j] | np.uint64(1))
    return mix(out + np.uint64(n))


def expand(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers begin[i] .. begin[i] + length[i] - 1, one range after the other."""
    total = int(length.sum())
    first = np.cumsum(length) - length
    return np.arange(total) + np.repeat(begin - first, length)
