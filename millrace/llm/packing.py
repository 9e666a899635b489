"""Packing of tokenised documents into sequences of a fixed length.

Method: Martello-Toth dominance reduction, then best fit. Only the number of pieces of each length matters for the
plan, and there are at most `limit` lengths, so the instance is a histogram of bounded size whatever the corpus, and so
are the plan and the work on it: a step of the reduction uses up a length or all but one of its pieces, a step of best
fit a length or a group of equal bins. The
reduction fixes bins that provably dominate every other choice for their largest piece and takes them off the
histogram, again and again until none is left to fix; best fit in decreasing order packs what remains. Pieces then
find their places from their rank among the pieces of their length: ranks come from counts by task and length, so no
length, however common, meets in one task.

Defined cases: null and empty texts are one token, the closing id; an empty table gives no rows; repeated rows are
packed as often as they occur; other columns are ignored, whatever their names; documents of any length are whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .bpe import RankedMerges
from .common import CHUNK_BYTES, released, written
from .pretokens import Numbered, split

#: Characters for which normalising and lower-casing are the same, letter by letter, here and in the library.
PLAIN = regex.compile("[^\\x00-\\u024f\\u2010-\\u2027\\u2030-\\u205e\\u20ac]")


class WordIds:
    """Token ids of texts: each distinct pre-token is merged once, arrays put the texts together. Texts with special
    strings, or with characters whose normal form could differ from the library's, go to the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.merges = RankedMerges(path)
        self.special = self.merges.special
        self._clear()

    def _clear(self) -> None:
        self.known = Numbered()
        self.pool, self.start, self.size = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self, keys: np.ndarray, tokens: list[bytes]) -> None:
        flat, sizes = self.merges.merge(tokens)
        self.known.add(keys)
        self.start = np.concatenate([self.start, len(self.pool) + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.pool = np.concatenate([self.pool, flat.astype(np.uint32)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        odd = [i for i, x in enumerate(texts) if not x.isascii() and PLAIN.search(x) or any(s in x for s in self.special)]
        plain = [x.lower() for x in texts]
        for i in odd:
            plain[i] = ""
        joined, starts, ends, keys, offsets = split(plain, spaced=False)
        number = self.known.find(keys)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new, first = np.unique(keys[missing], return_index=True)
            if self.known.full(len(new)):
                self._clear()
                new, first = np.unique(keys, return_index=True)
                missing = np.arange(len(keys))
            first = missing[first]
            self._learn(new, [joined[a:b].encode() for a, b in zip(starts[first].tolist(), ends[first].tolist())])
            number = self.known.find(keys)
        size = self.size[number]
        flat = self.pool[W.expand(self.start[number], size)]
        cuts = np.concatenate([[0], np.cumsum(size)])[offsets]
        out = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        for i in odd:
            out[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.uint32)
        return out


class Placement(NamedTuple):
    """Pieces of a length, by rank from `rank`, `count` of them: `each` to a bin, from bin `bin` on, from `offset` on in it."""

    length: int
    rank: int
    count: int
    each: int
    bin: int
    offset: int


class Histogram:
    """Counts by length with the shortest and the longest that fit."""

    def __init__(self, counts: dict[int, int], limit: int):
        self.n = np.zeros(limit + 1, np.int64)
        for length, count in counts.items():
            self.n[length] += count
        self.given = np.zeros(limit + 1, np.int64)

    def take(self, length: int, count: int) -> int:
        """Takes count pieces off; the rank of the first."""
        rank = int(self.given[length])
        self.given[length] += count
        self.n[length] -= count
        return rank

    def largest(self, most: int) -> int:
        at = np.flatnonzero(self.n[: most + 1])
        return int(at[-1]) if len(at) else 0

    def smallest(self, k: int) -> list[int]:
        """The k smallest pieces."""
        out: list[int] = []
        for length in np.flatnonzero(self.n):
            out += [int(length)] * min(k - len(out), int(self.n[length]))
            if len(out) == k:
                break
        return out


def dominant(hist: Histogram, length: int, limit: int) -> list[int] | None:
    """Partners for one piece of this length that dominate all other sets with it, None if none are proved to.

    A set dominates another if the other's pieces can be dealt into groups that each fit in place of one of its pieces.
    """
    room = limit - length
    hist.n[length] -= 1
    try:
        if room and hist.n[room]:
            return [room]  # whatever else joins this piece fits in place of that partner
        best = hist.largest(room)
        if not best:
            return []
        low = hist.smallest(3)
        if len(low) < 2 or low[0] + low[1] > room:
            return [best]  # one partner at most: the longest dominates
        if len(low) < 3 or sum(low) > room:
            # two partners at most: one alone dominates if every pair fits in its place
            lengths = np.flatnonzero(hist.n[: room + 1])
            partner = [hist.largest(room - int(x)) if hist.n[x] else 0 for x in lengths]
            pairs = [int(x) + y for x, y in zip(lengths, partner) if y and (y != x or hist.n[x] > 1)]
            if not pairs or max(pairs) <= best:
                return [best]
        return None
    finally:
        hist.n[length] += 1


def plan(counts: dict[int, int], limit: int) -> tuple[list[Placement], int, int]:
    """(placements, bins, bins that the reduction fixed) for counts by length."""
    hist = Histogram(counts, limit)
    out: list[Placement] = []
    bins = 0
    again = True
    while again:
        again = False
        for length in map(int, np.flatnonzero(hist.n)[::-1]):
            while hist.n[length]:
                partners = dominant(hist, length, limit)
                if partners is None:
                    break
                # the same set again while its pieces last: with fewer pieces about, the sets that it dominates only get
                # fewer, so what proves it stays true
                if not partners:
                    times = int(hist.n[length]) if 2 * length > limit else 1
                elif partners[0] == length:
                    times = int(hist.n[length]) // 2
                else:
                    times = int(min(hist.n[length], hist.n[partners[0]]))
                out.append(Placement(length, hist.take(length, times), times, 1, bins, 0))
                if partners:
                    out.append(Placement(partners[0], hist.take(partners[0], times), times, 1, bins, length))
                bins += times
                again = True
        # a pass that fixed something may have made other sets dominant
    fixed = bins
    # best fit, longest first; a group holds bins of one room: room -> [(first bin, bins)]
    rooms: dict[int, list[tuple[int, int]]] = {}
    for length in map(int, np.flatnonzero(hist.n)[::-1]):
        while (left := int(hist.n[length])) > 0:
            fit = min((r for r in rooms if r >= length), default=0)
            if fit:
                first, size = rooms[fit].pop()
                if not rooms[fit]:
                    del rooms[fit]
            else:
                fit, first = limit, bins
                size = -(-left // (limit // length))
                bins += size
            each = fit // length
            full = min(size, left // each)
            if full:
                out.append(Placement(length, hist.take(length, full * each), full * each, each, first, limit - fit))
                if fit > each * length:
                    rooms.setdefault(fit - each * length, []).append((first, full))
            elif left:
                out.append(Placement(length, hist.take(length, left), left, each, first, limit - fit))
                rooms.setdefault(fit - left * length, []).append((first, 1))
                full = 1
            if size > full:
                rooms.setdefault(fit, []).append((first + full, size - full))
    return out, bins, fixed


def pieces(docs: DataFrame, vocabulary: str, id_col: str, text_col: str, limit: int, closing: int) -> DataFrame:
    """One row a piece, with its rank among the pieces of its length that the task made."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = WordIds(vocabulary)
        task = TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, np.int64)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            begin = size = 0
            for i, x in enumerate([*texts, None]):
                if x is None or size + len(x) > CHUNK_BYTES and i > begin:
                    yield cut(batch.slice(begin, i - begin).column(0), coder.encode(texts[begin:i]), seen, task)
                    begin, size = i, 0
                size += len(x or "")
        released()

    def cut(ids: pa.Array, coded: list[np.ndarray], seen: np.ndarray, task: int) -> pa.RecordBatch:
        rows = []
        for k, tokens in enumerate(coded):
            tokens = np.append(tokens, np.uint32(closing)).astype("<u4")
            for piece, start in enumerate(range(0, len(tokens), limit)):
                part = tokens[start : start + limit]
                rows.append((k, piece, start, len(part), zlib.crc32(part.tobytes()), task, int(seen[len(part)])))
                seen[len(part)] += 1
        cols = list(zip(*rows)) if rows else [()] * 7
        return pa.RecordBatch.from_arrays([ids.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])], names=["id", "piece", "start", "length", "ids_crc32", "task", "task_rank"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long, task long, task_rank long")


def packed(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, closing: int = 0) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    spark = docs.sparkSession
    # written: the ranks of a task must not change when it runs again
    cut = written(pieces(docs, vocabulary, id_col, text_col, limit, closing), "pieces")
    by_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    first = by_task.select("length", "task", F.coalesce(before, F.lit(0)).alias("first"))
    # at most `limit` rows, whatever the corpus
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    placements, _, _ = plan(counts, limit)
    placements.sort()
    table = spark.sparkContext.broadcast(np.array(placements or [(0,) * 6], np.int64))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = table.value
        span = int(at[:, 1].max()) + 2
        keys = at[:, 0] * span + at[:, 1]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            row = at[np.searchsorted(keys, length * span + rank, "right") - 1]
            nth = rank - row[:, 1]
            columns = [*batch.columns[:5], pa.array(row[:, 4] + nth // row[:, 3]), pa.array(row[:, 5] + nth % row[:, 3] * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = docs.schema[id_col].dataType.simpleString()
    ranked = cut.join(first, ["length", "task"]).select("id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("task_rank")).alias("rank"))
    return ranked.mapInArrow(place, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
