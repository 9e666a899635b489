r"""Benchmark decontamination by winnowing.

Words are `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of the text with A-Z lower-cased. A window is `window` consecutive words of
an item; an item of fewer, but not none, is one window. A document's word inside any occurrence of a window is hit.

Method: hash every k-gram of words (k = 5), keep the least hash of each run of window - k + 1 k-grams, join the kept
hashes of documents and items, and extend each match word by word to both sides. A span of `window` shared words has the
same least k-gram on both sides, so none is missed. Of several equal ones in a run a document keeps one and an item all:
the document's has its partner at the same place of the span, whichever it is; only an extension that reaches `window` words makes hits. Items with
fewer words have one k-gram, k being their length, which is looked up at every place of a document.

The items are the stated query set: they go to the tasks in blocks of at most `block_bytes` of text, one pass over
the documents for each block, so neither the driver nor a task holds more. Documents are never shuffled.

Defined cases: null text has no words, hits nothing and is not contaminated; items without words match nothing; a
null item id reads as ''; items that share an id count once, and so do repeated items; repeated documents give repeated
rows; empty tables work; texts are read whole, however long, and matches extended some PAIRS at a time, so a text that
repeats one word takes no more memory than another;
other columns stay inside the struct `row`, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import chunks, drop_written, written

GRAM = 5
FILTER_BITS = 22
#: Matches that are extended at once.
PAIRS = 1 << 20


def winnow(grams: np.ndarray, runs: np.ndarray, width: int, ties: bool) -> np.ndarray:
    """Places of the least k-gram of each run of width k-grams; runs: the run that starts here counts. Of several least
    ones in a run all are kept with ties, else the one whose place has the least remainder by width."""
    n = len(runs)
    if n <= 0:
        return np.empty(0, np.int64)
    least = grams[:n].copy()
    for j in range(1, width):
        np.minimum(least, grams[j : j + n], out=least)
    kept = np.zeros(len(grams), bool)
    if ties:
        for j in range(width):
            kept[j : j + n] |= runs & (grams[j : j + n] == least)
    else:
        rest = np.arange(len(grams)) % width
        best, place = np.full(n, width), np.zeros(n, np.int64)
        for j in range(width):
            better = (grams[j : j + n] == least) & (rest[j : j + n] < best)
            best = np.where(better, rest[j : j + n], best)
            place[better] = np.flatnonzero(better) + j
        kept[place[runs]] = True
    return np.flatnonzero(kept)


def owners(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


class Lists:
    """Lists of items: those of number i are items[first[i]:first[i + 1]], each once."""

    def __init__(self, number: np.ndarray, item: np.ndarray, n: int):
        pairs = np.unique(np.stack([number, item], 1), axis=0) if len(number) else np.empty((0, 2), np.int64)
        self.first, self.items = np.searchsorted(pairs[:, 0], np.arange(n + 1)), pairs[:, 1]

    def of(self, docs: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Distinct (doc, item) of (doc, number), some at a time."""
        out = np.empty((0, 2), np.int64)
        if len(docs):
            asked = np.unique(np.stack([docs, numbers], 1), axis=0)
            size = self.first[asked[:, 1] + 1] - self.first[asked[:, 1]]
            for a, b in slices(size):
                now = np.stack([np.repeat(asked[a:b, 0], size[a:b]), self.items[W.expand(self.first[asked[a:b, 1]], size[a:b])]], 1)
                out = np.unique(np.concatenate([out, now]), axis=0)
        return out


def slices(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begins and ends of runs whose sizes make about PAIRS together, or of single ones above."""
    total = np.cumsum(size)
    a = 0
    while a < len(size):
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + PAIRS, "right")))
        yield a, b
        a = b


class Lookup:
    """Sorted keys, each with a number; a bit table turns most absent keys away first."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        by = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[by], values[by]
        self.seen = np.zeros(1 << FILTER_BITS, bool)
        self.seen[self.keys >> np.uint64(64 - FILTER_BITS)] = True

    def pairs(self, keys: np.ndarray, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place, value) of every match, some at a time."""
        near = self.seen[keys >> np.uint64(64 - FILTER_BITS)]
        keys, places = keys[near], places[near]
        lo, hi = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, "right")
        some = hi > lo
        lo, size, places = lo[some], (hi - lo)[some], places[some]
        for a, b in slices(size):
            yield np.repeat(places[a:b], size[a:b]), self.values[W.expand(lo[a:b], size[a:b])]


class Items:
    """Winnowed index of a block of items. Places of items with the same words around them, as far as an extension may
    reach, are one passage, so a text that repeats itself or that many items hold is met once."""

    def __init__(self, ids: list[str], texts: list[bytes], window: int):
        self.ids, self.window = ids, window
        hashes, offsets, *_ = W.words(texts, W.ALNUM)
        counts = np.diff(offsets)
        owner = owners(offsets)
        # items stand apart by a word that no text has, so that no extension leaves its item
        gap = 2 * window
        self.words = np.full(len(hashes) + gap * (len(texts) + 1), W.stream(3, 1)[0], np.uint64)
        place = np.arange(len(hashes)) + gap * (owner + 1)
        self.words[place] = hashes
        grams = W.grams(hashes, GRAM)
        n = max(0, len(hashes) - window + 1)
        kept = winnow(grams, owner[:n] == owner[window - 1 : window - 1 + n], window - GRAM + 1, True)
        around = W.grams(self.words, 2 * window - GRAM)[place[kept] - (window - GRAM)]
        _, first, passage = np.unique(around, return_index=True, return_inverse=True)
        self.place = place[kept][first]
        self.long = Lookup(grams[kept][first], np.arange(len(first)))
        self.items = Lists(passage, owner[kept], len(first))
        self.short = {}
        for n in sorted(set(counts[(counts > 0) & (counts < window)].tolist())):
            of = np.flatnonzero(counts == n)
            keys, number = np.unique(W.grams(hashes, n)[offsets[of]], return_inverse=True)
            self.short[n] = (Lookup(keys, np.arange(len(keys))), Lists(number, of, len(keys)))

    def _extended(self, at: np.ndarray, passage: np.ndarray, hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
        """Begin, end, passage of the matches that reach the window."""
        window, total = self.window, len(hashes)
        q = self.place[passage]
        same = self.words[q] == hashes[at]
        for j in range(1, GRAM):
            same &= self.words[q + j] == hashes[at + j]
        at, q, passage = at[same], q[same], passage[same]
        reach = [np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)]
        for side, (begin, step) in enumerate(((0, -1), (GRAM - 1, 1))):
            going = np.ones(len(at), bool)
            for d in range(1, window - GRAM + 1):
                p = at + begin + step * d
                going &= (p >= 0) & (p < total)
                p = np.clip(p, 0, total - 1)
                going &= (owner[p] == owner[at]) & (hashes[p] == self.words[q + begin + step * d])
                reach[side] += going
        good = reach[0] + reach[1] + GRAM >= window
        return at[good] - reach[0][good], at[good] + GRAM + reach[1][good], passage[good]

    def hits(self, hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many hit spans begin less end at each word of some documents, and the distinct (document, item)."""
        window, total = self.window, len(hashes)
        edges = np.zeros(total + 1, np.int64)
        found = [np.empty((0, 2), np.int64)]
        n = total - window + 1
        if n > 0 and len(self.long.keys):
            grams = W.grams(hashes, GRAM)
            kept = winnow(grams, owner[:n] == owner[window - 1 :], window - GRAM + 1, False)
            for at, passage in self.long.pairs(grams[kept], kept):
                begin, end, passage = self._extended(at, passage, hashes, owner)
                np.add.at(edges, begin, 1)
                np.add.at(edges, end, -1)
                found.append(self.items.of(owner[begin], passage))
        for n, (lookup, lists) in self.short.items():
            m = total - n + 1
            if m > 0:
                inside = np.flatnonzero(owner[:m] == owner[n - 1 :])
                for at, number in lookup.pairs(W.grams(hashes, n)[inside], inside):
                    np.add.at(edges, at, 1)
                    np.add.at(edges, at + n, -1)
                    found.append(lists.of(owner[at], number))
        return edges, np.unique(np.concatenate(found), axis=0)


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list[str], list[bytes]]]:
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text")).filter("text is not null")
    items = items.distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    for k in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        rows = part.collect()
        yield [r.item for r in rows], [r.text.encode() for r in rows]


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, block_bytes: int = 16 << 20) -> DataFrame:
    """docs as struct `row`, with n_words, n_hit, spans (array of begin and end word) and items (ids, sorted as strings)."""
    sc = docs.sparkSession.sparkContext
    out = docs.select(F.struct("*").alias("row"), F.array().cast("array<array<long>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    schema = f"row {docs.schema.simpleString()}, n_words long, n_hit long, spans array<array<long>>, items array<string>"
    at = docs.columns.index(text_col)
    last = None
    for k, (ids, texts) in enumerate(_blocks(benchmark, item_id, item_text, block_bytes)):
        if k:
            before, last = last, written(out, "decontamination")
            out = last.select("row", "spans", "items")
            if before is not None:
                drop_written(before)
        # bounded: its text is at most block_bytes, or one item
        index = sc.broadcast(Items(ids, texts, window))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            index = index.value
            for batch in batches:
                flat = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), batch.column(0).field(at)], names=["row", "spans", "items", "text"])
                for part, texts in chunks([flat], "text"):
                    yield _scan(index, part, texts)

        out = out.mapInArrow(run, schema)
    return out


def _scan(index: Items, part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
    hashes, offsets, *_ = W.words(texts, W.ALNUM)
    edges, found = index.hits(hashes, owners(offsets))
    spans = [x or [] for x in part.column(1).to_pylist()]
    items = [x or [] for x in part.column(2).to_pylist()]
    touched = set(np.unique(found[:, 0]).tolist())
    for i, some in enumerate(spans):
        # what earlier blocks of items hit
        if some:
            touched.add(i)
            begin, end = (offsets[i] + np.array(some)).T
            np.add.at(edges, begin, 1)
            np.add.at(edges, end, -1)
    for d, x in found.tolist():
        items[d] = [*items[d], index.ids[x]]
    covered = np.cumsum(edges)[:-1] > 0
    n_hit = [0] * len(texts)
    for d in touched:
        own = covered[offsets[d] : offsets[d + 1]]
        spans[d] = np.flatnonzero(np.diff(own, prepend=False, append=False)).reshape(-1, 2).tolist()
        items[d] = sorted(set(items[d]))
        n_hit[d] = int(own.sum())
    return pa.RecordBatch.from_arrays(
        [part.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(n_hit, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(items, pa.list_(pa.string()))],
        names=["row", "n_words", "n_hit", "spans", "items"],
    )


def decontamination_report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One digest row per document."""
    found = contaminated_spans(docs.select(id_col, text_col), benchmark, text_col, **options)
    return found.select(
        F.col("row").getField(id_col).alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """docs without the contaminated ones."""
    return contaminated_spans(docs, benchmark, **options).filter("n_hit = 0").select("row.*")
