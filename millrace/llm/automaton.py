"""Deterministic automata over bytes, run on many short blocks at once.

A block emits, for every state in which it may be entered, the state in which it is left and what was counted on the way.
Such functions compose, and composition is associative, so blocks, slices and whole texts are scanned in any order and in
parallel, and learn afterwards in which state they were entered.
"""

from __future__ import annotations

import numpy as np

from .words import expand

WIDTH = 256


class Automaton:
    """classes: the class of each byte; step and emit: (state, class) to the next state and to what is counted there.

    A state without a block is 0. One more class, the last, pads blocks: it changes and counts nothing.
    """

    def __init__(self, classes: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.states = len(step)
        self.kinds = step.shape[1] + 1
        self.classes = classes.astype(np.uint8)
        self.step = np.hstack([step, np.arange(self.states)[:, None]]).astype(np.int64).ravel()
        self.emit = np.hstack([emit, np.zeros((self.states, 1), np.int64)]).astype(np.int64).ravel()

    def blocks(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(classes by block and place, number of blocks of each text): every text begins a block of its own."""
        many = -(-lengths // WIDTH)
        out = np.full(int(many.sum()) * WIDTH, self.kinds - 1, np.uint8)
        out[expand((np.cumsum(many) - many) * WIDTH, lengths)] = self.classes[data]
        return out.reshape(-1, WIDTH), many

    def functions(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(left, counted) by block and state of entry."""
        at = np.repeat(np.arange(self.states)[None, :], len(blocks), 0)
        counted = np.zeros(at.shape, np.int64)
        for column in np.ascontiguousarray(blocks.T):
            at *= self.kinds
            at += column[:, None]
            counted += self.emit[at]
            at = self.step[at]
        return at, counted

    @staticmethod
    def composed(left: np.ndarray, counted: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Functions of everything from the first block of the text (first: its number, for each block) to each block."""
        nth = np.arange(len(left)) - first
        reach = 1
        while len(nth) and reach <= nth.max():
            to = np.flatnonzero(nth >= reach)
            before, after = left[to - reach], left[to]
            sums = counted[to - reach] + np.take_along_axis(counted[to], before, 1)
            left, counted = left.copy(), counted.copy()
            left[to], counted[to] = np.take_along_axis(after, before, 1), sums
            reach *= 2
        return left, counted

    def places(self, blocks: np.ndarray, entered: np.ndarray, wanted: np.ndarray, mask: int) -> np.ndarray:
        """Where in each block, entered in that state, the wanted-th count (from 1, of those within the mask) is taken."""
        at, counted = entered.astype(np.int64), np.zeros(len(blocks), np.int64)
        place = np.full(len(blocks), -1, np.int64)
        for i, column in enumerate(np.ascontiguousarray(blocks.T)):
            at = at * self.kinds + column
            counted += self.emit[at] & mask
            at = self.step[at]
            place[(place < 0) & (counted >= wanted)] = i
        return place
