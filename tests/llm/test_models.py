import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from fixtures import ODD, docs, empty
from pyspark.sql import functions as F

from millrace.llm import lm_scoring as L
from millrace.llm import toxicity as T

SPACED = re.compile(rb"[^\x20\x09-\x0D]+")


def em(cells, vocabulary):
    """Mixture weights of (two, one, uniform) for cells {key: [tokens, sum of two, sum of one]}, by plain EM."""
    w = [1 / 3] * 3
    for _ in range(5000):
        took = [1e-3] * 3
        for n, two, one in cells.values():
            part = [w[0] * two / n, w[1] * one / n, w[2] / (vocabulary + 1)]
            for k in range(3):
                took[k] += n * part[k] / sum(part)
        last, w = w, [x / sum(took) for x in took]
        if max(abs(x - y) for x, y in zip(w, last)) < 1e-8:
            break
    return w


def model(rows):
    """{id: (tokens, known, base, score)} with dictionaries of words, and the number of training tokens."""
    texts = [(r.doc_id, [*SPACED.findall((r.text or "").encode().lower()), None]) for r in rows]
    fold = lambda i: (0 if i is None else zlib.crc32(str(i).encode())) % 7
    counts = {k: (collections.Counter(), collections.Counter(), collections.Counter()) for k in ("main", "deleted")}
    for i, w in texts:
        if fold(i) != 2:
            words, pairs, about = counts["deleted" if fold(i) == 3 else "main"]
            words.update(w)
            pairs.update(zip([False, *w[:-1]], w))
            about.update([False, *w[:-1]])
    (w0, p0, a0), (w1, p1, a1) = counts["main"], counts["deleted"]
    words, pairs, about = w0 + w1, p0 + p1, a0 + a1
    n, v = sum(words.values()), len(words)
    n0 = sum(w0.values())
    # estimates within a quarter of an octave are one, with their mean
    step = lambda x: round(math.log2(x * (v + 1)) * 4) if x > 0 else None
    cells = collections.defaultdict(lambda: collections.defaultdict(lambda: [0, 0.0, 0.0]))
    for (c, w), times in p1.items():
        two, one = p0[c, w] / max(a0[c], 1), w0[w] / max(n0, 1)
        for b in (a0[c].bit_length(), "all"):
            cell = cells[b][a0[c].bit_length(), step(two), step(one)]
            for k, x in enumerate((1, two, one)):
                cell[k] += times * x
    every = em(cells.pop("all", {0: [1.0, 0.0, 0.0]}), v)
    weights = {b: em(some, v) for b, some in cells.items()}
    none = weights.get(0, every)
    weights[0] = [0, none[1] / (none[1] + none[2]), none[2] / (none[1] + none[2])]
    out = {}
    for i, w in texts:
        base = sum(math.log10((words[x] + 1) / (n + v + 1)) for x in w) if n else 0.0
        score = 0.0
        for c, x in zip([False, *w[:-1]], w):
            a, b, u = weights.get(about[c].bit_length(), every)
            if n:
                score += math.log10(a * pairs[c, x] / max(about[c], 1) + b * words[x] / n + u / (v + 1))
        out[i] = (len(w), sum(words[x] > 0 for x in w), base, score)
    return out, n


def check_scores(table):
    want, n = model(table.collect())
    got = L.lm_scores(table).collect()
    assert len(got) == table.count()
    for r in got:
        tokens, known, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, n)
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score == pytest.approx(score, rel=1e-5, abs=1e-4)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2)
    return got


@pytest.mark.parametrize("tokens_a_partition,hot", [(2_000_000, 250_000), (3000, 300)])
def test_scores(spark, sf, monkeypatch, tokens_a_partition, hot):
    monkeypatch.setattr(L, "TOKENS_A_PARTITION", tokens_a_partition)
    monkeypatch.setattr(L, "HOT_TOKENS", hot)
    monkeypatch.setattr(L, "HELD_SUMS", 50)
    table = spark.read.parquet(f"{sf}/documents.parquet").unionByName(docs(spark, [*ODD, *["of the " * 500] * 20], 10**6)).repartition(3, "doc_id")
    got = check_scores(table)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("head,hot", [(1 << 20, 250_000), (5, 100)])
def test_scores_by_whole_contexts(spark, monkeypatch, head, hot):
    monkeypatch.setattr(L, "HEAD", head)
    monkeypatch.setattr(L, "RARE_A_CELL", 2000)
    monkeypatch.setattr(L, "TOKENS_A_PARTITION", 3000)
    monkeypatch.setattr(L, "HOT_TOKENS", hot)
    words = [f"w{i}" for i in range(6000)]
    begin = L.tokens([" ".join(words).encode()])[0][:-1] >> np.uint64(44)
    by = collections.defaultdict(list)
    for w, b in zip(words, begin.tolist()):
        by[b].append(w)
    alike = [some for some in by.values() if len(some) > 1]
    assert len(alike) > 5  # their hashes begin with the same 20 bits
    rng = random.Random(1)
    texts = [" ".join(f"{w} after{k}x{j}" for j, some in enumerate(alike) for k, w in enumerate(some) for _ in range(rng.randrange(4))) + f" {words[i]} {words[i + 1]} the" for i in range(300)]
    table = docs(spark, texts)
    want, n = model(table.collect())
    for r in L.lm_scores(table.repartition(3, "doc_id")).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (*want[r.doc_id][:2], n)
        assert (r.base_score, r.score) == pytest.approx(want[r.doc_id][2:], rel=1e-5, abs=1e-4)


def test_scores_edges(spark):
    assert L.lm_scores(empty(spark)).count() == 0
    check_scores(docs(spark, [None]).withColumn("doc_id", F.lit(None).cast("long")).withColumn("score", F.lit("x")))
    only_test = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    assert L.lm_scores(docs(spark, ["a b"], only_test)).first().score == 0


def test_block_max_is_exact():
    rng = np.random.default_rng(0)
    vectors = []
    for _ in range(700):
        cols = np.sort(rng.choice(60, rng.integers(1, 9), replace=False))
        w = rng.random(len(cols)) + 0.1
        vectors.append((cols, w / np.sqrt(w @ w)))
    labels = rng.integers(0, 2, 700)
    index = T.Examples(vectors, labels, 10)
    dense = np.zeros((700, 60))
    for i, (c, w) in enumerate(vectors):
        dense[i, c] = w
    for _ in range(200):
        cols = np.sort(rng.choice(60, rng.integers(1, 9), replace=False))
        w = rng.random(len(cols)) + 0.1
        q = w / np.sqrt(w @ w)
        best, cosine = index.nearest(cols, q)
        every = dense[:, cols] @ q
        want = np.sort(every[every > 0])[::-1][:10]
        assert np.allclose(cosine, want) and np.allclose(every[index.order[best]], want)


def labelled(spark, n=400):
    rng = random.Random(4)
    words = [a + b for a in "bcdfghjkl" for b in ("an", "or", "est", "il", "um")]
    texts, labels = [], []
    for i in range(n):
        toxic = i % 8 == 0
        w = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(["Vile.", "vermin", "nastify", "nastily", "nastiest"])
        texts.append(" ".join(w))
        labels.append((i, 0, int(toxic)))
    return docs(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(spark):
    table, labels = labelled(spark)
    got = {r.doc_id: r for r in T.toxicity_report(table, labels).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out for i in held) and sum(r.held_out for r in got.values()) == len(held)
    assert sum(got[i].predicted == int(i % 8 == 0) for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    toxic = [r for i, r in got.items() if i % 8 == 0 and r.predicted]
    assert all(e % 8 == 0 for r in toxic for e in r.evidence[:1])
    # labels of held-out rows, ids, languages and sources are no inputs
    other = labels.withColumn("toxic", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in T.toxicity_report(table.withColumn("lang", F.lit("zz")), other).collect()}
    assert again == {i: r.score for i, r in got.items()}
    clean = T.not_toxic(table, labels)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, r in got.items() if not r.predicted) and clean.columns == table.columns


def test_toxicity_edges(spark):
    table, labels = labelled(spark, 80)
    assert T.toxicity_report(empty(spark), labels).count() == 0
    assert {r.score for r in T.toxicity_report(docs(spark, ODD), labels.limit(0)).collect()} == {0.0}
    odd = docs(spark, ODD, 1000).withColumn("score", F.lit("x")).withColumn("evidence", F.lit(1))
    assert T.toxicity_report(odd.unionByName(odd), labels.unionByName(labels).withColumn("toxic", F.when(F.col("doc_id") > 5, F.col("toxic")))).count() == 2 * len(ODD)
    mixed = table.unionByName(docs(spark, ODD, 1000))
    assert T.toxicity_report(mixed, labels).count() == 80 + len(ODD)


def test_examples_are_bounded_by_ids(spark):
    """Documents that share an id are one example, the least text of them."""
    rows = [(i, f"text {i} number {k:03d}", "en", "s", 9) for i in range(12) for k in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(12)], "doc_id long, quality int, toxic int")
    model = T.fitted(table, labels, "doc_id", "text", "toxic", 4, None)
    assert len(model.ids) <= 4 and model.examples.n <= 4
    assert T.toxicity_report(table, labels, examples=4).count() == len(rows)
