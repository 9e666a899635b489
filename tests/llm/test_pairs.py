import collections
import hashlib
import random
import re

import pytest
from fixtures import ODD, docs, empty
from pyspark.sql import functions as F

from millrace.llm import decontamination as D
from millrace.llm import near_dedup as N
from millrace.llm.components import components

SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").encode().lower()


def groups(rows):
    """{id: (set size, component)} by comparing all pairs."""
    sets = {}
    for r in rows:
        w = SPACED.findall(lower(r.text))
        sets[r.doc_id] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    root = {k: k for k in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(s), find(k)) for k, s in sets.items()}


def near_copies(rng, n):
    """A text and copies with some words changed, chains of copies, and small sets near the threshold."""
    base = [rng.choice("abcdefgh") + str(rng.randrange(50)) for _ in range(150)]
    out = [" ".join(base)]
    for _ in range(n):
        some = list(base)
        for _ in range(rng.randrange(1, 9)):
            some[rng.randrange(len(some))] = str(rng.random())
        out.append(" ".join(some))
    for _ in range(n // 2):
        some = out[-1].split(" ")
        some[rng.randrange(len(some))] = str(rng.random())
        out.append(" ".join(some))
    return out


def check_groups(table):
    got = N.near_duplicates(table).collect()
    want = groups(table.collect())
    assert len(got) == table.count()
    for r in got:
        assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)


def test_near_duplicates(spark):
    rng = random.Random(7)
    texts = [*ODD, *ODD, *near_copies(rng, 60), *(" ".join(rng.choice("ab") for _ in range(rng.randrange(1, 14))) for _ in range(60))]
    rng.shuffle(texts)
    check_groups(docs(spark, texts).repartition(4))


def test_open_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 4)
    rng = random.Random(8)
    check_groups(docs(spark, [*near_copies(rng, 50), *near_copies(rng, 20)]))


def test_near_duplicates_edges(spark):
    assert N.near_duplicates(empty(spark)).count() == 0
    table = docs(spark, ["p q r s t u v"] * 2).withColumn("component_id", F.lit("x")).withColumn("n", F.lit(1))
    assert {r.component_id for r in N.near_duplicates(table).collect()} == {0}
    null = docs(spark, ["p q r s t u v"] * 3).withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    assert {(r.doc_id, r.component_id, r.kept) for r in N.near_duplicates(null).collect()} == {(None, None, True), (1, 1, True), (2, 1, False)}
    kept = N.one_of_each(docs(spark, ["p q r s t u v"] * 3).unionByName(docs(spark, ["", None], 9)))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 9, 10] and kept.columns == docs(spark, []).columns
    twice = docs(spark, ["p q r s t u v"] * 2).unionByName(docs(spark, ["p q r s t u v"] * 2))
    assert sorted((r.doc_id, r.component_id) for r in N.near_duplicates(twice).collect()) == [(0, 0), (0, 0), (1, 0), (1, 0)]


@pytest.mark.parametrize("at_once,passes", [(1, 9), (1, 1), (3, 4)])
def test_one_of_each_in_passes(spark, monkeypatch, at_once, passes):
    monkeypatch.setattr(N, "IDS_AT_ONCE", at_once)
    monkeypatch.setattr(N, "PASSES", passes)
    table = docs(spark, ["p q r s t u v"] * 4 + ["k l m n o", None, "k l m n o"])
    assert sorted(r.doc_id for r in N.one_of_each(table).collect()) == [0, 4, 5]


def test_recall_of_the_bands():
    """Pairs at and above the threshold share a band: all of 400, measured on random sets."""
    rng = random.Random(3)
    for k in range(400):
        n = rng.randrange(40, 400)
        both = [rng.getrandbits(64) for _ in range(-(-75 * 2 * n // 175))]
        one, two = (N.np.array(both + [rng.getrandbits(64) for _ in range(n - len(both))], N.np.uint64) for _ in "ab")
        assert set(N.bands(N.minima(one))) & set(N.bands(N.minima(two)))


def test_long_texts_are_whole(spark):
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(60_000))
    check_groups(docs(spark, [long, long + " and more", long[: len(long) // 2], "w1 w2 " * 30_000]))


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(5, 3), (3, 9), (7, 8), (8, 8)], []])
def test_components(spark, edges):
    rng = random.Random(1)
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {x: x for e in edges if e[0] != e[1] for x in e}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in root if find(x) != x}


def hits(table, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(lower(text))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add("" if item is None else str(item))
    out = {}
    for r in table.collect():
        w = ALNUM.findall(lower(r.text))
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if k := windows.get(tuple(w[i : i + n])):
                    found |= k
                    hit |= set(range(i, i + n))
        out[r.doc_id] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_decontamination(spark, block_bytes):
    rng = random.Random(2)
    words = lambda n: [rng.choice(["a", "b", "the", "Of", "é", "12"]) for _ in range(n)]
    items = [(i, " ".join(words(rng.choice([1, 3, 6, 9, 10, 12, 30])))) for i in range(25)] + [(25, None), (26, "..."), (None, "odd words of nobody"), (3, "another of the same id")]
    long = [t for _, t in items if t and len(t.split()) > 9]
    texts = list(ODD)
    for _ in range(60):
        at = rng.choice(long).split()
        a = rng.randrange(len(at))
        texts.append("-".join([*words(rng.randrange(9)), *at[a : a + rng.randrange(8, 14)], *words(rng.randrange(9))]))
    texts += ["odd words of nobody", "Odd! words, of nobody.", *long]
    table = docs(spark, texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in D.decontamination_report(table, bench, block_bytes=block_bytes).collect()}
    want = hits(table, items)
    assert got == want and any(x[4] for x in want.values()) and not all(x[4] for x in want.values())
    clean = D.decontaminated(table, bench, block_bytes=block_bytes)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(k for k, x in want.items() if not x[4]) and clean.columns == table.columns


def test_repeated_words_and_passages(spark):
    """Ties everywhere: one word, periods of two and three words, passages that many items share, and long texts."""
    items = [(1, "a " * 300), (2, "a b " * 40), (3, "x y z " * 30), (4, "q " + "a b " * 7), (5, "long passage of words that many items share here and there again " * 2)]
    items += [(10 + i, f"head{i} long passage of words that many items share here and there again tail{i}") for i in range(30)]
    texts = ["a " * 3000, "a " * 9, "a " * 10, "c " + "a b " * 5 + "c", "b " + "a b " * 4 + "a", "y z " + "x y z " * 200, "q a b a b a b a b a", "w " * 30 + "items share here and there again long passage of words", items[7][1], "v " * 20000 + "a " * 12]
    bench = spark.createDataFrame(items * 2, "item_id long, text string")
    table = docs(spark, texts)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in D.decontamination_report(table, bench).collect()}
    assert got == hits(table, items)


def test_matches_of_repeated_words_are_few():
    """20,000 times one word against 1,000 times the same: places meet passages, not places."""
    index = D.Items(["i"], [b"a " * 1000], 10)
    assert len(index.place) < 30
    hashes, offsets, *_ = D.W.words([b"a " * 20000], D.W.ALNUM)
    edges, found = index.hits(hashes, D.owners(offsets))
    assert edges.cumsum()[:-1].min() > 0 and found.tolist() == [[0, 0]]


def test_decontamination_edges(spark, sf):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    assert D.decontamination_report(empty(spark), bench).count() == 0
    assert D.decontamination_report(docs(spark, ["a"]), bench.limit(0)).first().contaminated is False
    clash = docs(spark, ["a b"]).withColumn("spans", F.lit(1)).withColumn("row", F.lit(2)).withColumn("items", F.lit("z"))
    assert D.decontaminated(clash, bench).columns == clash.columns
    table = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in D.decontamination_report(table, bench).collect()}
    assert got == hits(table, [(r.item_id, r.text) for r in bench.collect()])
