import collections
import zlib

import public_tokenizers
import pytest
from fixtures import ODD, docs, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import queries as Q
from millrace.llm.packing import WordIds, packed, plan
from millrace.llm.token_counts import TokenCounter, token_counts

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
byte_lib, word_lib = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
counter, coder = TokenCounter(BYTES), WordIds(WORDS)
PARTS = st.sampled_from([*"ab 's tlvedrm\n\t\r19½é中!?-_ćİ €²ªAI", chr(0x3000), chr(0x85), chr(0xA0), chr(0x10FFFF), "<|endoftext|>"]) | st.characters(codec="utf-8")
TEXTS = st.lists(PARTS, max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=5))
def test_counts_are_the_librarys(texts):
    assert counter.count(texts) == [len(x.ids) for x in byte_lib.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=5))
def test_ids_are_the_librarys(texts):
    assert [list(x) for x in coder.encode(texts)] == [x.ids for x in word_lib.encode_batch(texts, add_special_tokens=False)]


def test_token_counts(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet").unionByName(docs(spark, ODD, 10**6))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(table, BYTES).collect()}
    for r in table.collect():
        n = len(byte_lib.encode(r.text or "", add_special_tokens=False).ids)
        assert got[r.doc_id] == (len((r.text or "").encode()), n, n > 512)
    assert token_counts(empty(spark), BYTES).count() == 0
    clash = docs(spark, ["a b"]).withColumn("n_tokens", F.lit("x")).withColumn("id", F.lit(1))
    assert token_counts(clash, BYTES).first().n_tokens == 2


def check_packing(table, rows, limit=2048):
    texts = collections.Counter((r.doc_id, r.text) for r in table.collect())
    want = collections.Counter()
    for (doc, text), times in texts.items():
        ids = [*word_lib.encode(text or "", add_special_tokens=False).ids, 0]
        for k, start in enumerate(range(0, len(ids), limit)):
            part = ids[start : start + limit]
            want[doc, k, start, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))] += times
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(bins), -(-sum(r.length for r in rows) // limit)


def test_packing(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet").unionByName(docs(spark, ODD, 10**6)).repartition(3)
    bins, least = check_packing(table, packed(table, WORDS).collect())
    assert bins <= least + 1
    assert packed(empty(spark), WORDS).count() == 0
    check_packing(docs(spark, [None]), packed(docs(spark, [None]), WORDS).collect())


def best_possible(sizes, limit):
    """The least number of bins, by search."""
    sizes = sorted(sizes, reverse=True)
    best = len(sizes)

    def place(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(sizes):
            best = len(room)
            return
        for k in {r: k for k, r in enumerate(room) if r >= sizes[i]}.values():
            place(i + 1, [*room[:k], room[k] - sizes[i], *room[k + 1 :]])
        place(i + 1, [*room, limit - sizes[i]])

    place(0, [])
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_reduction_keeps_the_optimum(sizes):
    """What the reduction fixes leaves an instance that still needs as few bins."""
    placements, bins, fixed = plan(collections.Counter(sizes), 20)
    seen, fill = collections.Counter(), collections.defaultdict(list)
    for p in placements:
        seen[p.length] += p.count
        for i in range(p.count):
            fill[p.bin + i // p.each].append((p.offset + i % p.each * p.length, p.length))
    assert seen == collections.Counter(sizes) and sorted(fill) == list(range(bins))
    rest = []
    for b, parts in fill.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 20
        if b >= fixed:
            rest += [length for _, length in parts]
    best = best_possible(sizes, 20)
    assert fixed + (best_possible(rest, 20) if rest else 0) == best and bins <= best + 1


def test_registered():
    assert {"op1_best_fit_packing", "op7_token_counts"} <= set(Q.QUERIES)


@pytest.mark.parametrize("sizes", [{2048: 5}, {1: 5000}, {1024: 3, 1025: 2, 700: 9}, {}])
def test_plan_edges(sizes):
    _, bins, _ = plan(sizes, 2048)
    assert bins >= -(-sum(k * v for k, v in sizes.items()) // 2048)


def test_plans_do_not_grow_with_the_rows():
    """Counts a thousand times as large make a plan of the same order."""
    for sizes in ({700: 10**8}, {1024: 10**8, 1025: 10**8, 700: 10**8}, {k: 10**7 + k for k in range(1, 2049, 7)}):
        placements, bins, _ = plan(sizes, 2048)
        assert len(placements) <= 4 * 2048 and bins >= -(-sum(k * v for k, v in sizes.items()) // 2048)
