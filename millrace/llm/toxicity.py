r"""Toxicity scores from the nearest labelled examples.

Terms are words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` with A-Z lower-cased, and the first four, five and six bytes of longer
words. Examples are a sample of at most `examples` labelled rows, of which none has crc32(id) mod 5 = 0. The vocabulary
has all terms of theirs that separate their labels by a likelihood-ratio test (G >= 30); `vocabulary` may bound their
number. A term counts once for each document but, while fewer than 56 bits of a bitmap of 64 are set (some 130 contexts),
no more than it has distinct pairs of neighbours, so copies of one text lend a rare term no weight.

Method: documents and examples are TF-IDF vectors (root frequencies) over that vocabulary and one term that all words
share, with document frequencies from all documents. An
inverted index holds the examples in blocks with each term's largest weight in each block; blocks whose bound is under
the k-th cosine so far are passed over, so the k nearest are exact. They vote with weights that fall with distance, and
a logistic curve fitted to the examples' own leave-one-out votes makes the vote a probability. The nearest are the
evidence. Only the text goes into a score.

Defined cases: null text counts as empty; a text without terms of the vocabulary has the share of toxic labels among
such examples; of documents that share an id the one with the least text is the example; without labelled rows all scores are 0; a null id is not held out; null labels are left out, repeated ones
count as their largest; ties go by the examples' text; repeated rows give repeated rows; an empty table gives no rows;
other columns stay inside the struct `row`, whatever their names; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import words as W
from .common import chunks, crc32_of_id, drop_written, written

EXAMPLES, NEIGHBOURS, BLOCK = 8192, 24, 64
PREFIXES = (4, 5, 6)
LEAST_G, LEAST_CONTEXTS = 30.0, 8
FOLDS = 5


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(terms, texts, contexts) of every occurrence; a context is the hash of the word's neighbours."""
    hashes, offsets, starts, ends, low = W.words(texts, W.ALNUM)
    if not len(hashes):
        return hashes, np.empty(0, np.int64), hashes
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    near = np.concatenate([[np.uint64(0)], hashes, [np.uint64(0)]])
    context = W.mix(near[:-2] * np.uint64(3) + near[2:])
    parts = [(hashes, owner, context)]
    length = ends - starts
    for n in PREFIXES:
        some = np.flatnonzero(length > n)
        value = np.zeros(len(some), np.uint64)
        for k in range(n):
            value += (low[starts[some] + k].astype(np.uint64) + np.uint64(1)) * W.factors(n)[k]
        parts.append((W.mix(value + np.uint64(1000 + n)), owner[some], context[some]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _evidence_by_term(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contexts of each term, as 64 bits for each label, and its documents."""
    for part, texts in chunks(batches, "text"):
        toxic = np.array(part.column(1).to_pylist(), bool)
        term, owner, context = terms(texts)
        bit = np.uint64(1) << (context >> np.uint64(58))
        kinds, inverse = np.unique(term, return_inverse=True)
        bits = np.zeros((2, len(kinds)), np.uint64)
        for k in (0, 1):
            some = toxic[owner] == bool(k)
            np.bitwise_or.at(bits[k], inverse[some], bit[some])
        pairs = np.unique(inverse * len(texts) + owner)
        marked = toxic[pairs % len(texts)]
        n_toxic = np.bincount(pairs[marked] // len(texts), minlength=len(kinds))
        n_clean = np.bincount(pairs[~marked] // len(texts), minlength=len(kinds))
        columns = [kinds.view(np.int64), bits[0].view(np.int64), bits[1].view(np.int64), n_clean, n_toxic]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["term", "clean", "toxic", "n_clean", "n_toxic"])


class Vocabulary:
    def __init__(self, terms_: list[int]):
        self.keys = np.sort(np.array(terms_, np.int64).view(np.uint64))
        self.seen = np.zeros(1 << 16, bool)
        self.seen[self.keys >> np.uint64(48)] = True

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, times), in order, of the terms that are in the vocabulary."""
        term, owner, _ = terms(texts)
        if not len(self.keys):
            return (np.empty(0, np.int64),) * 3
        some = self.seen[term >> np.uint64(48)]
        term, owner = term[some], owner[some]
        at = np.minimum(np.searchsorted(self.keys, term), len(self.keys) - 1)
        hit = self.keys[at] == term
        key, times = np.unique(owner[hit] * len(self.keys) + at[hit], return_counts=True)
        return key // len(self.keys), key % len(self.keys), times

    def vectors(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(terms, times) of each text. The last term, after those of the vocabulary, stands for every word, so that a
        few finds in a long text weigh less; a text without finds has no terms."""
        text, term, times = self.counts(texts)
        cut = np.searchsorted(text, np.arange(1, len(texts)))
        every = np.diff(W.words(texts, W.ALNUM)[1]) if len(text) else np.zeros(len(texts), np.int64)
        out = []
        for t, n, all_ in zip(np.split(term, cut), np.split(times, cut), every.tolist()):
            out.append((np.append(t, len(self.keys)), np.append(n, all_)) if len(t) else (t, n))
        return out


class Vote(NamedTuple):
    share: float
    nearest: list[tuple[int, float]]


class Examples:
    """Block-max inverted index of the examples' unit vectors."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, k: int = NEIGHBOURS):
        # alike examples share blocks, so that bounds are tight
        order = sorted(range(len(vectors)), key=lambda i: (vectors[i][0][np.argmax(vectors[i][1])], len(vectors[i][0]), i))
        self.order, self.labels, self.k = np.array(order, np.int64), labels[order].astype(np.float64), k
        self.n = len(order)
        self.blocks = -(-self.n // BLOCK)
        rows = np.concatenate([np.full(len(vectors[e][0]), i) for i, e in enumerate(order)] or [np.empty(0, np.int64)]).astype(np.int64)
        cols = np.concatenate([vectors[e][0] for e in order] or [np.empty(0, np.int64)]).astype(np.int64)
        data = np.concatenate([vectors[e][1] for e in order] or [np.empty(0)])
        by = np.lexsort((rows, cols))
        self.rows, self.data, cols = rows[by], data[by], cols[by]
        top = int(cols[-1]) + 1 if len(cols) else 0
        self.first = np.searchsorted(cols, np.arange(top + 1))
        self.bound = np.zeros((top, self.blocks))
        np.maximum.at(self.bound, (cols, self.rows // BLOCK), self.data)

    def nearest(self, cols: np.ndarray, weights: np.ndarray, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the largest cosines above 0, and those cosines."""
        known = cols < len(self.bound)
        cols, weights = cols[known], weights[known]
        bound = weights @ self.bound[cols]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        scores = np.zeros(self.n)
        done, step, kth = 0, 4, 0.0
        while done < len(order) and (bound[order[done]] >= kth):
            now = order[done : done + step]
            now = now[bound[now] >= kth]
            wanted = np.zeros(self.blocks, bool)
            wanted[now] = True
            for c, w in zip(cols.tolist(), weights.tolist()):
                a, b = self.first[c], self.first[c + 1]
                rows = self.rows[a:b]
                some = wanted[rows // BLOCK]
                scores[rows[some]] += w * self.data[a:b][some]
            if without >= 0:
                scores[without] = 0
            done += step
            step *= 4
            if self.n > self.k:
                kth = float(np.partition(scores, -self.k)[-self.k])
        best = np.lexsort((self.order, -scores))[: self.k]
        best = best[scores[best] > 0]
        return best, np.minimum(scores[best], 1.0)

    def vote(self, cols: np.ndarray, weights: np.ndarray, prior: float, without: int = -1) -> Vote:
        best, cosine = self.nearest(cols, weights, without)
        weight = 1 / (1.05 - cosine)
        share = (float(weight @ self.labels[best]) + prior) / (float(weight.sum()) + 1)
        return Vote(share, [(int(self.order[i]), float(c)) for i, c in zip(best[:3], cosine[:3])])


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the probability of y given log odds x, by Newton's method, slightly held to (1, 0)."""
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        v = p * (1 - p)
        g = np.array([((p - y) * x).sum() + (a - 1), (p - y).sum() + b])
        h = np.array([[(v * x * x).sum() + 1, (v * x).sum()], [(v * x).sum(), v.sum() + 1]])
        d = np.linalg.solve(h, g)
        a, b = a - d[0], b - d[1]
    return (float(a), float(b)) if a > 0 else (1.0, 0.0)


def odds(p: float) -> float:
    return float(np.log(p) - np.log1p(-p))


class Model:
    def __init__(self, vocabulary: Vocabulary, idf: np.ndarray, rows: list):
        self.vocabulary, self.idf = vocabulary, idf
        vectors = [self.unit(np.array(r.cols, np.int64), np.array(r.times, np.float64)) for r in rows]
        labels = np.array([r.toxic for r in rows], np.int64)
        self.ids = [r.id for r in rows]
        self.prior = float((labels.sum() + 0.5) / (len(labels) + 1))
        bare = np.array([not len(v[0]) for v in vectors], bool)
        self.bare = float((labels[bare].sum() + self.prior) / (bare.sum() + 1))
        at = np.flatnonzero(~bare)
        self.ids = [self.ids[i] for i in at]
        self.examples = Examples([vectors[i] for i in at], labels[at])
        self.known: dict[bytes, tuple[float, list]] = {}
        self.curve = (1.0, 0.0)
        if len(at):
            place = np.empty(len(at), np.int64)
            place[self.examples.order] = np.arange(len(at))
            votes = np.array([odds(self.examples.vote(*vectors[i], self.prior, int(place[n])).share) for n, i in enumerate(at)])
            self.curve = logistic(votes, labels[at].astype(float))

    def unit(self, cols: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = np.sqrt(times) * self.idf[cols]
        return cols, w / np.sqrt(w @ w) if len(w) else w

    def score(self, cols: np.ndarray, times: np.ndarray) -> tuple[float, list]:
        if not len(cols) or not self.examples.n:
            return self.bare, []
        key = cols.astype(np.int32).tobytes() + times.astype(np.int32).tobytes()
        if key not in self.known:
            if len(self.known) > 1 << 16:
                self.known.clear()
            vote = self.examples.vote(*self.unit(cols, times.astype(float)), self.prior)
            p = 1 / (1 + np.exp(-(self.curve[0] * odds(vote.share) + self.curve[1])))
            self.known[key] = (float(p), [self.ids[i] for i, _ in vote.nearest])
        return self.known[key]


def _frequencies(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(len(vocabulary.keys), np.int64), 0
        for part, texts in chunks(batches, "text"):
            found += np.bincount(vocabulary.counts(texts)[1], minlength=len(found))
            rows += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(found)), -1)), pa.array(np.append(found, rows))], names=["term", "n"])

    return run


def _example_vectors(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "text"):
            cols, times = zip(*vocabulary.vectors(texts))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(cols, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64())), part.column(3)], names=["id", "toxic", "cols", "times", "tie"])

    return run


def fitted(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, examples: int, vocabulary: int | None) -> Model | None:
    clean = labels.filter(F.col(label_col).isNotNull() & (F.pmod(crc32_of_id(id_col), F.lit(FOLDS)) != 0)).groupBy(F.col(id_col).alias("__id")).agg(F.max(label_col).cast("int").alias("toxic"))
    known = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    # bounded: at most `examples` ids; those whose document is missing here go, of repeated ones the least text stays
    chosen = clean.orderBy(F.xxhash64("__id"), "__id").limit(examples)
    texts = known.join(F.broadcast(chosen), "__id").groupBy("__id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    # written: it is read three times
    sample = written(texts.select(F.col("__id").alias("id"), "toxic", "text", F.xxhash64("text").alias("tie")), "examples")
    counted = sample.mapInArrow(_evidence_by_term, "term long, clean long, toxic long, n_clean long, n_toxic long")
    counted = counted.groupBy("term").agg(F.bit_or("clean").alias("clean"), F.bit_or("toxic").alias("toxic"), F.sum("n_clean").alias("n_clean"), F.sum("n_toxic").alias("n_toxic"))
    n = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n:
        return None
    total = [n.get(0, 0), n.get(1, 0)]
    # documents, but no more than contexts; these are estimated by linear counting while their bits tell
    estimate = lambda c: F.when(F.bit_count(c) < 56, -64 * F.log(1 - F.bit_count(c) / 64))
    seen = lambda c: F.least(F.col(f"n_{c}").cast("double"), F.coalesce(estimate(c), F.col(f"n_{c}").cast("double")))
    both = F.col("a") + F.col("b")
    g = lambda x, k: F.when(F.col(x) > 0, F.col(x) * F.log(F.col(x) / both * (sum(total) / max(total[k], 1)))).otherwise(0.0)
    scored = counted.select("term", seen("clean").alias("a"), seen("toxic").alias("b")).filter(both >= LEAST_CONTEXTS).withColumn("g", 2 * (g("a", 0) + g("b", 1)))
    best = scored.filter(F.col("g") >= LEAST_G).orderBy(F.desc("g"), "term")
    best = (best if vocabulary is None else best.limit(vocabulary)).select("term").collect()
    words_ = Vocabulary([r.term for r in best])
    idf = np.ones(len(words_.keys) + 1)  # every document has words, so the last stays 1
    frequency = {r.term: r.n for r in known.select("text").mapInArrow(_frequencies(words_), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    for t in range(len(words_.keys)):
        idf[t] = np.log((1 + frequency[-1]) / (1 + frequency[t])) + 1
    rows = sample.select("id", "toxic", "text", "tie").mapInArrow(_example_vectors(words_), f"id {docs.schema[id_col].dataType.simpleString()}, toxic int, cols array<long>, times array<long>, tie long").collect()
    drop_written(sample)
    rows.sort(key=lambda r: (r.tie, r.cols, r.times, r.toxic))
    return Model(words_, idf, rows)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", examples: int = EXAMPLES, vocabulary: int | None = None) -> DataFrame:
    """docs as struct `row`, with score, predicted and evidence, the ids of the nearest examples."""
    model = fitted(docs, labels, id_col, text_col, label_col, examples, vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        flat = (pa.RecordBatch.from_arrays([b.column(0), b.column(0).field(at)], names=["row", "text"]) for b in batches)
        for part, texts in chunks(flat, "text"):
            if model is None:
                out = [(0.0, [])] * len(texts)
            else:
                out = [model.score(c, n) for c, n in model.vocabulary.vectors(texts)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([s for s, _ in out], pa.float64()), pa.array([e for _, e in out], pa.list_(to_arrow_type(kind)))], names=["row", "score", "evidence"])

    rows = docs.select(F.struct("*").alias("row"))
    scored = rows.mapInArrow(run, f"row {docs.schema.simpleString()}, score double, evidence array<{kind.simpleString()}>")
    return scored.select("row", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def toxicity_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    found = toxicity(docs.select(id_col, text_col), labels, id_col, text_col, **options)
    held = F.coalesce(F.pmod(crc32_of_id(id_col), F.lit(FOLDS)) == 0, F.lit(False))
    return found.select(F.col("row").getField(id_col).alias(id_col), "score", "predicted", "evidence").select(id_col, held.alias("held_out"), "score", "predicted", "evidence")


def not_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """docs without those predicted to be toxic."""
    return toxicity(docs, labels, **options).filter("predicted = 0").select("row.*")
