"""Pieces against the library."""

import hashlib
import random

import public_tokenizers
import sentencepiece
from fixtures import ODD, docs, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import pieces
from millrace.llm.pieces import CONTROL, PieceModel, encoded, lenient, piece_report

PATH = public_tokenizers.path("piece_bpe_32k.model")
model, library = PieceModel(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
SIGNS = st.sampled_from([*"abethinrso .,-_=<>/\n\t\r19é中▁", " " * 3, "the", "▁the", "<s>", "<0x0A>", "\x00", " ", "😀", "=-"]) | st.characters(codec="utf-8")


@settings(max_examples=500, deadline=None)
@given(st.lists(SIGNS, max_size=60).map("".join))
def test_ids_and_texts_are_the_librarys(text):
    ids = library.encode(text)
    assert model.encode(text) == ids
    assert model.encode_shown(text) == ",".join(map(str, ids))
    assert model.decode(ids) == library.decode(ids)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 300) | st.integers(0, 31999) | st.sampled_from([29871, 259]), max_size=20))
def test_any_ids_decode_as_in_the_library(ids):
    assert model.decode(ids) == library.decode(ids)


def test_compatibility_is_merging():
    """Neighbours are compatible exactly if merging the two together leaves them."""
    r = random.Random(3)
    some = [p for p in model.halves if len(p) < 9]
    pairs = [(r.choice(some), r.choice(some)) for _ in range(4000)] + [(p[:k], p[k:]) for p in some[:3000] for k in range(1, len(p)) if p[:k] in model.halves and p[k:] in model.halves]
    seen = {model.compatible(a, b): None for a, b in pairs}
    for a, b in pairs:
        assert model.compatible(a, b) == ([x[0] for x in model.merged(a + b)] == [a, b]), (a, b)
    assert set(seen) == {True, False}


def test_every_prefix_has_one_last_piece():
    text = "▁international▁tokenization"
    for end in range(1, len(text)):
        fits = []
        for k in range(end):
            piece, before = text[k:end], model.pieces_of(text[:k])
            if (piece in model.halves or len(piece) == 1) and (not before or model.compatible(before[-1], piece)):
                fits.append(piece)
        assert fits == [model.pieces_of(text[:end])[-1]]


def test_long_texts():
    for text in ("a" * 200_000, " " * 50_000, "ab" * 70_000, "\n" * 20_000, "=-" * 30_000, "the quick brown fox\n" * 20_000, "中😀" * 20_000):
        ids = library.encode(text)
        assert model.encode(text) == ids and model.decode(ids) == library.decode(ids)


def test_windows_and_generations(monkeypatch):
    monkeypatch.setattr(pieces, "WINDOW", 7)
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    own = PieceModel(PATH)
    for text in ("the quick brown fox, the lazy dog. " * 30, "internationalisation  of\n\n\n everything" * 9, " " * 40, "a" * 50, "", "x"):
        ids = library.encode(text)
        assert own.encode(text) == ids and own.encode_shown(text) == ",".join(map(str, ids))


def test_lenient():
    assert lenient(b"a\xffb\xe4\xb8") == "a�b��" and lenient(b"") == ""


def test_report(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet").unionByName(docs(spark, [*ODD, "▁▁ a", "x\n\n"], 10**6))
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for r in table.collect():
        ids = library.encode(r.text or "")
        want.append((r.doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    assert sorted(map(tuple, piece_report(table, PATH).collect())) == sorted(want)
    assert piece_report(empty(spark), PATH).count() == 0
    clash = docs(spark, ["a b", None]).withColumn("ids", F.lit("x")).withColumn("n_tokens", F.lit(1.5)).withColumn("id", F.lit(3))
    assert [r.ids for r in encoded(clash, PATH).orderBy("doc_id").collect()] == [",".join(map(str, library.encode("a b"))), ""]
    assert all(model.kinds[i] == CONTROL for i in (1, 2))
