"""Byte-pair merging of many pre-tokens at once: rank-synchronous merging of ragged numpy arrays."""

from __future__ import annotations

import json

import numpy as np

from .words import expand

NONE = np.iinfo(np.int32).max


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class PairTable:
    """Rank of a pair of symbols: open addressing, probed for whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, size: int):
        self.size = size
        self.bits = max(4, int(4 * len(left)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        keys = left * size + right
        slot, todo = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(todo):
            self.probes += 1
            free = todo[self.keys[slot[todo]] < 0]
            self.keys[slot[free]] = keys[free]  # of several, the last stays
            put = self.keys[slot[todo]] == keys[todo]
            self.ranks[slot[todo[put]]] = todo[put]
            todo = todo[~put]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.size + right
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.ranks[slot], NONE)
        todo = np.flatnonzero((found != keys) & (found >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.ranks[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return out


class RankedMerges:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids = dict(model["vocab"])
        self.special = [x["content"] for x in spec["added_tokens"]]
        size = max(ids.values()) + 1
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.table = PairTable(np.array([ids[a] for a, _ in pairs]), np.array([ids[b] for _, b in pairs]), size)
        self.of_byte = np.array([ids[c] for c in byte_symbols()], np.int64)
        end = model.get("end_of_word_suffix") or ""
        self.of_last = np.array([ids[c + end] for c in byte_symbols()], np.int64)

    def merge(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, lengths): what survives of the pre-tokens, none of them empty, one after the other."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        raw = np.frombuffer(b"".join(tokens), np.uint8)
        symbols = self.of_byte[raw]
        ends = np.cumsum(lengths)
        symbols[ends - 1] = self.of_last[raw[ends - 1]]
        rank = np.full(len(symbols), NONE, np.int32)
        rank[:-1] = self.table.rank(symbols[:-1], symbols[1:])
        rank[ends - 1] = NONE
        alive = np.arange(len(tokens))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(alive):
            least = np.minimum.reduceat(rank, np.cumsum(lengths) - lengths)
            live = least < NONE
            if not live.all():
                within = np.repeat(live, lengths)
                done.append((alive[~live], lengths[~live], symbols[~within]))
                symbols, rank = symbols[within], rank[within]
                alive, lengths, least = alive[live], lengths[live], least[live]
                if not len(alive):
                    break
            hit = rank == np.repeat(least, lengths)
            at = np.flatnonzero(hit)
            # a run of one symbol gives overlapping places: take every second, from the left
            if (at[1:] - at[:-1] == 1).any():
                begun = np.ones(len(at), bool)
                begun[1:] = at[1:] - at[:-1] > 1
                nth = np.arange(len(at))
                at = at[(nth - np.maximum.accumulate(np.where(begun, nth, 0))) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            gone = np.cumsum(~stay)
            owner_ends = np.cumsum(lengths)
            lengths = lengths - np.diff(gone[owner_ends - 1], prepend=0)
            at -= gone[at]
            symbols, rank = symbols[stay], rank[stay]
            ends = np.cumsum(lengths) - 1
            tail = np.zeros(len(symbols), bool)
            tail[ends] = True
            # only pairs with a merged symbol have a new rank
            fresh = np.zeros(len(symbols), bool)
            fresh[at] = True
            fresh[at[at > 0] - 1] = True
            fresh &= ~tail
            fresh = np.flatnonzero(fresh)
            rank[fresh] = self.table.rank(symbols[fresh], symbols[fresh + 1])
            rank[ends] = NONE
        order = np.concatenate([x[0] for x in done]) if done else np.empty(0, np.int64)
        counts = np.concatenate([x[1] for x in done]) if done else order
        flat = np.concatenate([x[2] for x in done]) if done else order
        by = np.argsort(order)
        begin = (np.cumsum(counts) - counts)[by]
        counts = counts[by]
        return flat[expand(begin, counts)], counts
