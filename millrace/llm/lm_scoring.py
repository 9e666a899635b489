r"""Language-model scores by deleted interpolation.

Tokens are the words `[^\x20\x09-\x0D]+` with A-Z lower-cased, then one end. Training documents have crc32(id) mod 7 other
than 2; of these, remainder 3 is deleted from the counts while the mixture weights are learned.

Method: P(w | v) = a c(v, w) / c(v) + b c(w) / N + c / (V + 1), maximum-likelihood estimates whose weights (a, b, c) belong
to a bucket of the context's frequency (its bit length). They are learned by expectation-maximisation, until they stand
still, on the counts of the deleted documents against those of the others; of these, estimates within a quarter of an
octave of each other are summed up to their mean. The scores use the counts of all training documents. Words, contexts
and pairs are counted by whole 64-bit hashes.

A pass over the documents counts words, another the pairs that are suspected to be frequent. A third deals what the
documents hold of each pair to cells by word, as compressed arrays: a cell then has its words' and pairs' counts and all
documents to score with them. Words of HOT_TOKENS and more are dealt by pair, such pairs by document too; both
lists are bounded by shares of all tokens, and their counts are broadcast. Only sums by document leave a cell.

A cell by word does not hold its contexts' frequencies. Those of the `HEAD` most frequent words are broadcast. What
follows any other word is dealt a second time, to cells by context, which have that word's frequency and its pairs; there
a word outside the head lacks its own count and gets it by a join.

Defined cases: null text counts as empty (one token, the end); a null id counts as crc32 0; an empty table gives no
rows; repeated rows are counted as often as they occur; without training tokens every token has the probability 1;
other columns are ignored, whatever their names; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import checkpointed, chunks, crc32_of_id, drop_written, freed, written

END = W.stream(21, 1)[0]
#: Among hashes of contexts: a document's begin, and any word outside the head.
BEGIN, OTHER = W.stream(22, 2)
FOLDS, TEST, DELETED = 7, 2, 3
CHUNK, CHUNK_DOCS = 4 << 20, 1 << 14
TOKENS_A_PARTITION, CELLS_A_PARTITION = 2_000_000, 4
#: Words and pairs of so many tokens are dealt apart. Their lists are broadcast, so a word has at least this share of all
#: tokens besides, and a pair that one; a suspected pair has half of it in a chunk.
HOT_TOKENS, WORD_SHARE, PAIR_SHARE = 250_000, 1 / (1 << 20), 1 / 16384
#: So many words at most, and the hot ones, have their counts broadcast as contexts; tokens after others in a cell by context.
HEAD, RARE_A_CELL = 1 << 20, 250_000
#: Sums by document that a task gathers from its cells before it passes them on.
HELD_SUMS = 1_000_000
EM_ROUNDS, STILL, STEPS_AN_OCTAVE, ABSENT = 5000, 1e-8, 4, -(10**6)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, lengths): the words of each text and its end."""
    hashes, offsets, *_ = W.words(texts, W.NOT_SPACE)
    return np.insert(hashes, offsets[1:], END), np.diff(offsets) + 1


def contexts(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.empty(len(hashes), np.uint64)
    out[1:] = hashes[:-1]
    out[np.cumsum(lengths) - lengths] = BEGIN
    return out


def pair_keys(hashes: np.ndarray, context: np.ndarray) -> np.ndarray:
    return W.mix(hashes + context * np.uint64(0x9E3779B97F4A7C15))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[int], np.ndarray, np.ndarray]]:
    """(ids, folds, hashes, lengths) of chunks of documents."""
    ids: list = []
    folds: list[int] = []
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for part, texts in chunks(batches, "text"):
        if ids and (size + sum(map(len, texts)) > CHUNK or len(ids) + len(texts) > CHUNK_DOCS):
            yield ids, folds, *(np.concatenate(x) for x in zip(*parts))
            ids, folds, parts, size = [], [], [], 0
        for k in range(0, len(texts), CHUNK_DOCS):
            some = texts[k : k + CHUNK_DOCS]
            if len(ids) + len(some) > CHUNK_DOCS:
                yield ids, folds, *(np.concatenate(x) for x in zip(*parts))
                ids, folds, parts, size = [], [], [], 0
            ids += part.column(0).to_pylist()[k : k + CHUNK_DOCS]
            folds += part.column(1).to_pylist()[k : k + CHUNK_DOCS]
            parts.append(tokens(some))
            size += sum(map(len, some))
    if ids:
        yield ids, folds, *(np.concatenate(x) for x in zip(*parts))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of training documents by chunk, and pairs that are frequent in it."""
    for _, folds, hashes, lengths in _documents(batches):
        fold = np.repeat(folds, lengths)
        total = len(hashes)
        known = fold != TEST
        word, inverse, count = np.unique(hashes[known], return_inverse=True, return_counts=True)
        deleted = np.bincount(inverse[fold[known] == DELETED], minlength=len(word))
        common = (count >= total * PAIR_SHARE / 2)[inverse]
        keys, n = np.unique(pair_keys(hashes[known][common], contexts(hashes, lengths)[known][common]), return_counts=True)
        keys, n = keys[n >= total * PAIR_SHARE / 2], n[n >= total * PAIR_SHARE / 2]
        starts = [int(np.sum(np.array(folds) != TEST) - np.sum(np.array(folds) == DELETED)), folds.count(DELETED)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat([0, 1, 2], [len(word), len(keys), 1]).astype(np.int32)),
                pa.array(np.concatenate([word, keys, [np.uint64(0)]]).view(np.int64)),
                pa.array(np.concatenate([count - deleted, n, starts[:1]]).astype(np.int64)),
                pa.array(np.concatenate([deleted, np.zeros(len(keys), np.int64), starts[1:]])),
            ],
            names=["kind", "key", "main", "deleted"],
        )


def _count_only(keys: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((len(keys), 2), np.int64)
        for _, folds, hashes, lengths in _documents(batches):
            fold = np.repeat(folds, lengths)
            pair = pair_keys(hashes, contexts(hashes, lengths))
            at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
            hit = (keys[at] == pair) & (fold != TEST)
            np.add.at(found, (at[hit], (fold[hit] == DELETED).astype(int)), 1)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(found[:, 0]), pa.array(found[:, 1])], names=["key", "main", "deleted"])

    return run


class Table:
    """Sorted keys with the counts of main and deleted documents."""

    def __init__(self, rows: list):
        rows = sorted((np.int64(r.key).view(np.uint64), r.main, r.deleted) for r in rows)
        self.keys = np.array([r[0] for r in rows] or [0], np.uint64)
        self.counts = np.array([r[1:] for r in rows] or [(0, 0)], np.int64)
        self.empty = not rows

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if it has none."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (not self.empty), at, -1)


class Head:
    """Frequent words as contexts, numbered by frequency from 1; 0 is a document's begin, `rare` any other word."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, starts: list[int]):
        by = np.lexsort((keys, -counts.sum(1)))
        self.hash_of = np.concatenate([[BEGIN], keys[by], [OTHER]]).astype(np.uint64)
        self.counts = np.concatenate([[starts], counts[by], [[0, 0]]]).astype(np.int64)
        self.rare = len(keys) + 1
        self.number = np.argsort(keys[by]) + 1
        self.keys = self.hash_of[self.number]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each word."""
        if not len(self.keys):
            return np.full(len(keys), self.rare)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.number[at], self.rare)


def _kinds(group: np.ndarray, member: np.ndarray, n: int, codes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct pairs of numbers below n in order, how many codes each has, and all codes with their times."""
    pair, places = group * n + member, None
    if n * n >= 1 << 47:
        places, pair = np.unique(pair, return_inverse=True)
    key, times = np.unique((pair << 16) | codes, return_counts=True)
    begun = np.flatnonzero(np.diff(key >> 16, prepend=-1))
    kind = key[begun] >> 16 if places is None else places[key[begun] >> 16]
    return kind // n, kind % n, np.diff(np.append(begun, len(key))), (key & 0xFFFF).astype(np.uint16), times.astype(np.uint32)


def _blobs(cell: np.ndarray, group: np.ndarray, member: np.ndarray, extra: np.ndarray, has_extra: np.ndarray, size: np.ndarray, code: np.ndarray, times: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(cell, data): runs of a group's hash, their members' numbers, the hashes of members that have none, and the codes."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    by = np.argsort(cell, kind="stable")
    row = W.expand((np.cumsum(size) - size)[by], size[by])
    cell, group, member, extra, has_extra, size, code, times = cell[by], group[by], member[by].astype(np.uint32), extra[by], has_extra[by], size[by].astype(np.uint32), code[row], times[row]
    edge = np.append(np.flatnonzero(np.diff(cell, prepend=-1)), len(cell))
    entry = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        first = np.flatnonzero(np.concatenate([[True], group[a + 1 : b] != group[a : b - 1]]))
        more = extra[a:b][has_extra[a:b]]
        data = [np.diff(group[a:b][first], prepend=np.uint64(0)), np.diff(np.append(first, b - a)).astype(np.uint32), member[a:b], size[a:b], code[entry[a] : entry[b]], times[entry[a] : entry[b]], more]
        yield int(cell[a]), squeeze(np.array([len(first), b - a, entry[b] - entry[a], len(more)], np.int64).tobytes() + b"".join(_planes(x) for x in data))


def _share_of(hashes: np.ndarray, cells: int) -> np.ndarray:
    return (((W.mix(hashes) >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)).astype(np.int64)


def _dealt(head_, hot_words: Table, hot_pairs: Table, cells: int, rare_cells: int):
    """Blobs by chunk and cell, first cells by word, then cells by context; and a row for the chunk itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = head_.value
        squeeze = zstandard.ZstdCompressor(level=1).compress
        task = TaskContext.get().partitionId()
        for nth, (ids, folds, hashes, lengths) in enumerate(_documents(batches)):
            name = f"{task}-{nth}"  # the same when the task runs again
            salt = W.mix(np.array([(task << 20) + nth], np.uint64))[0]
            word, inverse = np.unique(hashes, return_inverse=True)
            inverse = inverse.astype(np.int64)
            codes = np.repeat(np.arange(len(ids)) * 4 + np.array([2 if f == TEST else int(f == DELETED) for f in folds]), lengths)
            number = np.append(head.find(word), [0, head.rare])
            # contexts as places in number: a document's begin and any rare word are the last two
            before = np.empty(len(hashes), np.int64)
            before[1:] = inverse[:-1]
            before[np.cumsum(lengths) - lengths] = len(word)
            rare = number[before] == head.rare
            token, about, size, code, times = _kinds(inverse, np.where(rare, len(word) + 1, before), len(number), codes)
            token, context = word[token], number[about]
            hot = hot_words.find(token) >= 0
            pair = pair_keys(token, head.hash_of[context])
            to = np.where(hot, pair, token)
            # what follows rare words has its pairs elsewhere
            to = np.where((hot_pairs.find(pair) >= 0) | hot & (context == head.rare), W.mix(pair + salt), to)
            out = list(_blobs(_share_of(to, cells), token, context, token, np.zeros(len(token), bool), size, code, times))
            if rare.any():
                about, token, size, code, times = _kinds(before[rare], inverse[rare], len(number), codes[rare])
                out += _blobs(cells + _share_of(word[about], rare_cells), word[about], number[token], word[token], number[token] == head.rare, size, code, times)
            if any(x is None for x in ids):
                ids = [x if x is not None else np.iinfo(np.int64).min for x in ids]
            out.append((-1 - int(salt % np.uint64(cells)), squeeze(np.array([ids, lengths], np.int64).tobytes())))
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([name] * len(out)), pa.array([d for _, d in out], pa.binary())], names=["cell", "chunk", "data"])

    return run


def _planes(x: np.ndarray) -> bytes:
    """All first bytes, then all second ones, and so on: they compress better."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _from_planes(raw: bytes, kind: type, n: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).reshape(-1).view(kind)


def _opened(data: bytes) -> tuple[np.ndarray, ...]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    nw, nt, ne, nx = np.frombuffer(raw, np.int64, 4).tolist()
    out, at = [], 32
    for kind, n in ((np.uint64, nw), (np.uint32, nw), (np.uint32, nt), (np.uint32, nt), (np.uint16, ne), (np.uint32, ne), (np.uint64, nx)):
        size = np.dtype(kind).itemsize
        out.append(_from_planes(raw, kind, n, at))
        at += n * size
    return np.repeat(np.cumsum(out[0], dtype=np.uint64), out[1]), *out[2:]


class Cell:
    """All that a cell holds: its pairs with the counts of pair, context and word, and the documents of each chunk that has them."""

    def __init__(self, blobs: list[bytes], head: Head, hot_words: Table, hot_pairs: Table, by_context: bool):
        groups, members, sizes, codes, times, extra = zip(*map(_opened, blobs))
        self.code, self.times, self.chunk = np.concatenate(codes), np.concatenate(times).astype(np.int64), np.repeat(np.arange(len(blobs)), [len(x) for x in codes])
        group, member, size = np.concatenate(groups), np.concatenate(members).astype(np.int64), np.concatenate(sizes)
        other = head.hash_of[member]
        if by_context:
            other[member == head.rare] = np.concatenate(extra)
        kind, first, inverse = np.unique(pair_keys(other, group) if by_context else pair_keys(group, other), return_index=True, return_inverse=True)
        self.of = np.repeat(inverse, size)
        self.fold = self.code & 3
        self.pair = self._counts(self.of, len(kind))
        self.deleted = np.bincount(self.of, self.times * (self.fold == 1), len(kind))
        member, other = member[first], other[first]
        own, spot = np.unique(group[first], return_inverse=True)
        counts = self._counts(spot[self.of], len(own))
        #: Pairs all of whose counts are here.
        self.whole = member != head.rare
        self.token = other if by_context else group[first]
        if by_context:
            self.about, self.word = counts[spot], head.counts[member]
        else:
            hot = hot_pairs.find(kind)
            self.pair[hot >= 0] = hot_pairs.counts[hot[hot >= 0]]
            # a word's own count: from its entries here, or from the broadcast list
            hot = hot_words.find(own)
            counts[hot >= 0] = hot_words.counts[hot[hot >= 0]]
            self.about, self.word = head.counts[member], counts[spot]

    def _counts(self, of: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(of, self.times * (self.fold == k), n) for k in (0, 1)], 1).astype(np.int64)


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[str], list[bytes]]]:
    rows = ((c, n, d) for batch in batches for c, n, d in zip(*(x.to_pylist() for x in batch.columns[:3])))
    for cell, group in groupby(rows, key=lambda r: r[0]):
        group = list(group)
        yield cell, [r[1] for r in group], [r[2] for r in group]


def bucket(count: np.ndarray) -> np.ndarray:
    """Bit length."""
    return np.frexp(count.astype(np.float64))[1] * (count > 0)


GRID = "b long, s2 long, s1 long, n double, x2 double, x1 double"


def _shares(about: np.ndarray, pair: np.ndarray, word: np.ndarray, times: np.ndarray, totals: tuple[int, int, int]) -> pa.RecordBatch:
    """How often deleted tokens have which two estimates, by main counts: by steps of their logarithms, with their sums."""
    base = 1 / (totals[2] + 1)
    step = lambda x: np.where(x > 0, np.rint(np.log2(np.maximum(x, 1e-300) / base) * STEPS_AN_OCTAVE), ABSENT).astype(np.int64)
    two, one = pair / np.maximum(about, 1), word / max(totals[0], 1)
    kinds, inverse = np.unique(np.stack([bucket(about), step(two), step(one)], 1), axis=0, return_inverse=True)
    sums = [np.bincount(inverse.ravel(), times * x, len(kinds)) for x in (np.ones(len(times)), two, one)]
    return pa.RecordBatch.from_arrays([*(pa.array(kinds[:, k], pa.int64()) for k in range(3)), *(pa.array(x, pa.float64()) for x in sums)], names=[c.split()[0] for c in GRID.split(", ")])


def _deleted_shares(head_, totals, hot_words: Table, hot_pairs: Table, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, _, blobs in _by_cell(batches):
            if cell >= 0:
                x = Cell(blobs, head_.value, hot_words, hot_pairs, cell >= cells)
                some = np.flatnonzero((x.deleted > 0) & x.whole)
                yield _shares(x.about[some, 0], x.pair[some, 0], x.word[some, 0], x.deleted[some], totals)

    return run


LACKING = "word long, chunk string, code int, times long, about0 long, about1 long, pair0 long, pair1 long"


def _lacking(head_, hot_words: Table, hot_pairs: Table, cells: int):
    """What the cells by context hold of words whose own counts are not there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, names, blobs in _by_cell(batches):
            x = Cell(blobs, head_.value, hot_words, hot_pairs, True)
            at = np.flatnonzero(~x.whole[x.of])
            of = x.of[at]
            numbers = [x.times[at], x.about[of, 0], x.about[of, 1], x.pair[of, 0], x.pair[of, 1]]
            chunk = pa.array(names, pa.string()).take(pa.array(x.chunk[at]))
            out = pa.RecordBatch.from_arrays([pa.array(x.token[of].view(np.int64)), chunk, pa.array(x.code[at].astype(np.int32)), *map(pa.array, numbers)], names=[c.split()[0] for c in LACKING.split(", ")])
            for k in range(0, len(at), 1 << 16):
                yield out.slice(k, 1 << 16)

    return run


def _lacking_shares(totals):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, times, about, pair, word = (batch.column(c).to_numpy() for c in ("code", "times", "about0", "pair0", "word0"))
            some = np.flatnonzero((code & 3) == 1)
            yield _shares(about[some], pair[some], word[some], times[some], totals)

    return run


def learned(rows: list[tuple], vocabulary: int) -> np.ndarray:
    """(a, b, c) by bucket, of rows (bucket, tokens, sums of both estimates); a bucket without deleted tokens has the
    weights of all together."""
    data = np.array(rows or [(0, 1.0, 0.0, 0.0)], np.float64)
    share = np.concatenate([data[:, 2:] / data[:, 1:2], np.full((len(data), 1), 1 / (vocabulary + 1))], 1)

    def fit(some: np.ndarray) -> np.ndarray:
        weight, own, times = np.full(3, 1 / 3), share[some], data[some, 1:2]
        for _ in range(EM_ROUNDS):
            part = own * weight
            part /= part.sum(1, keepdims=True)
            last, weight = weight, (part * times).sum(0) + 1e-3
            weight /= weight.sum()
            if np.abs(weight - last).max() < STILL:
                break
        return weight

    out = np.tile(fit(np.ones(len(data), bool)), (64, 1))
    for b in np.unique(data[:, 0]).astype(int):
        out[b] = fit(data[:, 0] == b)
    out[0] = [0, *out[0, 1:] / out[0, 1:].sum()]  # a context never seen has no pairs
    return out


class Sums:
    """Sums by document, gathered from many cells and passed on by chunk."""

    def __init__(self):
        self.squeeze = zstandard.ZstdCompressor(level=1).compress
        self.held: list[tuple[np.ndarray, ...]] = []
        self.number: dict[str, int] = {}

    def add(self, names: list[str], chunk: np.ndarray, code: np.ndarray, *values: np.ndarray) -> Iterator[pa.RecordBatch]:
        spot = np.array([self.number.setdefault(n, len(self.number)) for n in names], np.int64)
        kinds, of = np.unique((spot[chunk] << 16) | (code >> 2).astype(np.int64), return_inverse=True)
        self.held.append((kinds, *(np.bincount(of, v, len(kinds)) for v in values)))
        if sum(len(h[0]) for h in self.held) > HELD_SUMS:
            yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        """What there is since the last time of each chunk."""
        if self.held:
            key, *values = (np.concatenate(x) for x in zip(*self.held))
            kinds, of = np.unique(key, return_inverse=True)
            parts = [np.bincount(of, v, len(kinds)) for v in values]
            cut = np.searchsorted(kinds >> 16, np.arange(len(self.number) + 1))
            out = []
            for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
                out.append(self.squeeze(np.array([j - i], np.int64).tobytes() + (kinds[i:j] & 0xFFFF).astype(np.uint16).tobytes() + _planes(parts[0][i:j].astype(np.uint32)) + _planes(parts[1][i:j]) + _planes(parts[2][i:j])))
            yield pa.RecordBatch.from_arrays([pa.array(list(self.number)), pa.array([False] * len(out)), pa.array(out, pa.binary())], names=["chunk", "whole", "data"])
            self.held.clear()
            self.number.clear()


def _logs(about: np.ndarray, pair: np.ndarray, word: np.ndarray, totals: tuple[int, int, int], weights: np.ndarray) -> np.ndarray:
    total, distinct = totals[0] + totals[1], totals[2]
    if not total:
        return np.zeros(len(word))
    mix = weights[bucket(about)]
    return np.log10(mix[:, 0] * pair / np.maximum(about, 1) + mix[:, 1] * word / total + mix[:, 2] / (distinct + 1))


def _scored(head_, totals, weights: np.ndarray, hot_words: Table, hot_pairs: Table, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, distinct = totals[0] + totals[1], totals[2]
        sums = Sums()
        for cell, names, blobs in _by_cell(batches):
            if cell < 0:
                data = [zstandard.ZstdDecompressor().decompress(b) for b in blobs]
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([True] * len(names)), pa.array(data, pa.binary())], names=["chunk", "whole", "data"])
                continue
            x = Cell(blobs, head_.value, hot_words, hot_pairs, cell >= cells)
            word = x.word.sum(1)
            score = np.where(x.whole, _logs(x.about.sum(1), x.pair.sum(1), word, totals, weights), 0)
            # words are counted and have their base scores where they are dealt by word
            known = (word > 0) & (cell < cells)
            base = np.log10((word + 1) / (total + distinct + 1)) if total and cell < cells else np.zeros(len(word))
            yield from sums.add(names, x.chunk, x.code, *(x.times * v[x.of] for v in (known, base, score)))
        yield from sums.rows()

    return run


def _lacking_scored(totals, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for batch in batches:
            code, times, *counts = (batch.column(c).to_numpy() for c in ("code", "times", "about0", "about1", "pair0", "pair1", "word0", "word1"))
            score = _logs(counts[0] + counts[1], counts[2] + counts[3], counts[4] + counts[5], totals, weights)
            chunk = batch.column("chunk").dictionary_encode()
            none = np.zeros(len(code))
            yield from sums.add(chunk.dictionary.to_pylist(), chunk.indices.to_numpy(), code, none, none, times * score)
        yield from sums.rows()

    return run


def _sum_chunk(group: pa.Table) -> pa.Table:
    whole = group.column("whole").to_pylist()
    data = group.column("data").to_pylist()
    ids, lengths = np.frombuffer(data[whole.index(True)], np.int64).reshape(2, -1)
    sums = np.zeros((3, len(ids)))
    for x, w in zip(data, whole):
        if not w:
            raw = zstandard.ZstdDecompressor().decompress(x)
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            docs = np.frombuffer(raw, np.uint16, n, 8).astype(np.int64)
            at = 8 + 2 * n
            for k, kind in enumerate((np.uint32, np.float64, np.float64)):
                sums[k, docs] += _from_planes(raw, kind, n, at)
                at += n * np.dtype(kind).itemsize
    missing = ids == np.iinfo(np.int64).min
    return pa.table({"id": pa.array(ids, pa.int64(), mask=missing), "n_tokens": pa.array(lengths), "n_known": pa.array(sums[0].astype(np.int64)), "base_score": pa.array(sums[1]), "score": pa.array(sums[2])})


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; ids are whole numbers."""
    sc = docs.sparkSession.sparkContext
    asked = docs.select(F.col(id_col).cast("long").alias("id"), F.pmod(F.coalesce(crc32_of_id(id_col), F.lit(0)), F.lit(FOLDS)).cast("int").alias("fold"), F.col(text_col).alias("text"))

    counted = asked.mapInArrow(_count, "kind int, key long, main long, deleted long").groupBy("kind", "key").agg(F.sum("main").alias("main"), F.sum("deleted").alias("deleted"))
    counted = written(counted, "words")
    freed(sc)
    of_words = counted.filter("kind = 0")
    n_main, n_deleted, distinct = (int(x or 0) for x in of_words.agg(F.sum("main"), F.sum("deleted"), F.count("*")).first())
    totals = (n_main, n_deleted, distinct)
    least = max(1, HOT_TOKENS, (n_main + n_deleted) * WORD_SHARE)
    hot_words = Table(of_words.filter(F.col("main") + F.col("deleted") >= least).collect())  # at most 1 / WORD_SHARE rows
    # counted in chunks where they are frequent, suspects have half of the share at least: at most 2 / PAIR_SHARE rows
    least_pair = max(1, HOT_TOKENS, (n_main + n_deleted) * PAIR_SHARE)
    suspects = counted.filter("kind = 1").filter(F.col("main") >= least_pair / 2).select("key").collect()
    keys = np.sort(np.array([r.key for r in suspects], np.int64).view(np.uint64))
    hot_pairs = Table([])
    if len(keys):
        rows = asked.mapInArrow(_count_only(keys), "key long, main long, deleted long").groupBy("key").agg(F.sum("main").alias("main"), F.sum("deleted").alias("deleted"))
        hot_pairs = Table(rows.filter(F.col("main") + F.col("deleted") >= least_pair).collect())

    total = n_main + n_deleted
    # how many words have which count: less than the root of twice all tokens
    of_count = of_words.groupBy((F.col("main") + F.col("deleted")).alias("n")).count().toArrow().to_pydict()
    fewest, room = max(of_count["n"], default=0) + 1, HEAD
    for n, times in sorted(zip(of_count["n"], of_count["count"]), reverse=True):
        room -= times
        if room < 0 and n < least:
            break
        fewest = n
    head = of_words.filter(F.col("main") + F.col("deleted") >= fewest).select("key", "main", "deleted").toArrow()  # at most HEAD rows, and the hot words
    starts = [int(x or 0) for x in counted.filter("kind = 2").agg(F.sum("main"), F.sum("deleted")).first()]
    counts = np.stack([head.column("main").to_numpy(), head.column("deleted").to_numpy()], 1)
    rare = total - int(counts.sum())
    head_ = sc.broadcast(Head(head.column("key").to_numpy().view(np.uint64), counts, starts))
    del head, counts
    freed(sc)

    partitions = max(1, -(-total // TOKENS_A_PARTITION))
    cells = partitions * CELLS_A_PARTITION
    # documents that are not counted have rare words as well
    rare_cells = max(1, -(-(rare + total // 16) // RARE_A_CELL))
    dealt = asked.mapInArrow(_dealt(head_, hot_words, hot_pairs, cells, rare_cells), "cell long, chunk string, data binary")
    dealt = checkpointed(dealt.repartition(partitions, "cell").sortWithinPartitions("cell"))
    freed(sc)
    lacking = dealt.filter(F.col("cell") >= cells).mapInArrow(_lacking(head_, hot_words, hot_pairs, cells), LACKING)
    own = of_words.select(F.col("key").alias("word"), F.col("main").alias("word0"), F.col("deleted").alias("word1"))
    lacking = written(lacking.join(own, "word", "left").fillna(0, ["word0", "word1"]), "lacking")
    drop_written(counted)
    freed(sc)
    shares = dealt.mapInArrow(_deleted_shares(head_, totals, hot_words, hot_pairs, cells), GRID).unionByName(lacking.mapInArrow(_lacking_shares(totals), GRID))
    grid = shares.groupBy("b", "s2", "s1").agg(F.sum("n"), F.sum("x2"), F.sum("x1")).collect()  # a bounded grid
    weights = learned([(r[0], *r[3:]) for r in grid], distinct)

    part = "chunk string, whole boolean, data binary"
    parts = dealt.mapInArrow(_scored(head_, totals, weights, hot_words, hot_pairs, cells), part).unionByName(lacking.mapInArrow(_lacking_scored(totals, weights), part))
    scores = parts.groupBy("chunk").applyInArrow(_sum_chunk, "id long, n_tokens long, n_known long, base_score double, score double")
    return scores.select(
        F.col("id").alias(id_col), (F.pmod(F.coalesce(crc32_of_id("id"), F.lit(0)), F.lit(FOLDS)) == TEST).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
