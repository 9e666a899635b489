r"""Pre-tokens of many texts at once: the split patterns of two public vocabularies as array operations.

Every code point has a class: letter, number, space or other. A pre-token is then a stretch between boundaries that
follow from the classes of neighbours, which is what the patterns' regular expressions match:

spaced:    's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
unspaced:  's|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+   (spaces go)
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

from . import words as W

OTHER, LETTER, NUMBER, SPACE, END = range(5)
STOP = 0x10FFFF  # a non-character that stands between texts


@cache
def classes() -> np.ndarray:
    kind = {"L": LETTER, "N": NUMBER}
    out = np.array([kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x30000)], np.uint8)
    out = np.concatenate([out, np.zeros(0x110000 - len(out), np.uint8)])
    out[0x30000:0x323B0] = LETTER
    for first, last in ((9, 13), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        out[first : last + 1] = SPACE
    out[STOP] = END
    return out


def split(texts: list[str], spaced: bool) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(joined, starts, ends, hashes, offsets): text i has the pre-tokens offsets[i] .. offsets[i + 1], each a slice of joined."""
    stop = chr(STOP)
    # a text that holds the stop character itself is cut there only if it is replaced: an unassigned neighbour has the same class
    joined = stop + stop.join(t.replace(stop, chr(STOP - 1)) if stop in t else t for t in texts) + stop
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = classes()[code]
    n = len(code)
    edge = np.empty(n, bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    if not spaced:
        edge |= kind == NUMBER
    edge |= kind == END
    joins = np.zeros(n, bool)
    if spaced:
        # the last of a run of spaces, before something else, stands apart; if it is U+0020, it begins what follows
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != END))
        edge[last] = True
        blank = last[code[last] == 32]
        joins[blank] = True
        edge[blank + 1] = False
    # contractions, where a match can begin at the apostrophe
    at = np.flatnonzero(code == 39)
    at = at[(kind[at - 1] != OTHER) & ~joins[at - 1]]
    one, two = code[at + 1], code[np.minimum(at + 2, n - 1)]
    short = (one == 115) | (one == 116) | (one == 109) | (one == 100)
    long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
    edge[at[short | long] + 1] = False
    edge[at[short] + 2] = True
    edge[at[long] + 3] = True
    starts = np.flatnonzero(edge)
    ends = np.append(starts[1:], n)
    wanted = kind[starts] != END
    if not spaced:
        wanted &= kind[starts] != SPACE
    starts, ends = starts[wanted], ends[wanted]
    offsets = np.searchsorted(starts, np.flatnonzero(kind == END))
    if not len(starts):
        return joined, starts, ends, np.empty(0, np.uint64), offsets
    lengths = ends - starts
    if spaced:
        inside, first = slice(1, n - 1), starts - 1
        value = code[inside].astype(np.uint64)
        place = np.arange(n - 2)
        fill = np.zeros(n - 2, np.int64)
        fill[first] = np.diff(first, prepend=0)
        place -= np.cumsum(fill)
        value *= W.factors(int(place.max()) + 1)[place]
        sums = np.add.reduceat(value, first)
        # a stop between two texts went with the last pre-token of the first of them: take it off again
        tail = np.flatnonzero(np.append(first[1:], n - 2) > ends - 1)
        for k in tail:
            sums[k] = value[first[k] : ends[k] - 1].sum()
    else:
        at = W.expand(starts, lengths)
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(at)) - np.repeat(first, lengths)
        sums = np.add.reduceat(code[at].astype(np.uint64) * W.factors(int(lengths.max()))[place], first)
    return joined, starts, ends, W.mix(sums + lengths.astype(np.uint64)), offsets


class Numbered:
    """Numbers 0, 1, 2 ... for 64-bit keys: open addressing, for whole arrays. It forgets all when full."""

    def __init__(self, bits: int = 21):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.values = np.full(1 << self.bits, -1, np.int64)
        self.count = 0

    def full(self, more: int) -> bool:
        return self.count + more > 1 << (self.bits - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers, -1 for those without."""
        mask = np.uint64((1 << self.bits) - 1)
        slot = keys >> np.uint64(64 - self.bits)
        out = self.values[slot]
        todo = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        slot = slot[todo]
        while len(todo):
            slot = (slot + np.uint64(1)) & mask
            value = self.values[slot]
            out[todo] = value
            more = (value >= 0) & (self.keys[slot] != keys[todo])
            todo, slot = todo[more], slot[more]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Numbers for new, distinct keys, in their order."""
        if self.full(len(keys)):
            grown = self.keys[self.values >= 0], self.values[self.values >= 0]
            self.bits = max(self.bits + 1, (4 * (self.count + len(keys))).bit_length())
            self.keys = np.zeros(1 << self.bits, np.uint64)
            self.values = np.full(1 << self.bits, -1, np.int64)
            self._put(*grown)
        self._put(keys, np.arange(self.count, self.count + len(keys)))
        self.count += len(keys)

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        mask = np.uint64((1 << self.bits) - 1)
        slot = keys >> np.uint64(64 - self.bits)
        todo = np.arange(len(keys))
        while len(todo):
            here = slot[todo]
            free = self.values[here] < 0
            self.keys[here[free]], self.values[here[free]] = keys[todo[free]], values[todo[free]]
            put = (self.values[here] == values[todo]) & (self.keys[here] == keys[todo])
            todo = todo[~put]
            slot[todo] = (slot[todo] + np.uint64(1)) & mask
