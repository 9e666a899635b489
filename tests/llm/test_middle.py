"""Fill-in-middle against a plain reading of its contract."""

import hashlib
import random
import re

import numpy as np
import pytest
from fixtures import ODD, docs, empty
from pyspark.sql import functions as F

from millrace.llm import fill_in_middle as M

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plainly(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    assert "".join(tokens) == text
    n, digest = len(tokens), hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    x, y = sorted((a % (n + 1), b % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:x]), "".join(tokens[x:y]), "".join(tokens[y:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or c % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if d % 100 < 80:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(table, **options):
    want = sorted((plainly(r.doc_id, r.text) for r in table.collect()), key=repr)
    out = M.fill_in_middle(table, **options)
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out.collect()]
    assert sorted(got, key=repr) == want
    back = out.select(F.coalesce("text", F.lit("")).alias("t"), M.restored(F.col("output"), F.col("form")).alias("r"))
    assert back.where("t <> r").count() == 0
    return want


def made(seed, length):
    r = random.Random(seed)
    return "".join(r.choice([" ", "\n", "\x0b", "<", "P", "S", ">", "M", "a", "é", "中", "😀", "word"]) for _ in range(length))


def test_odd_texts(spark, sf):
    few = docs(spark, [*ODD, "<P", "<P>", "a<<S>", "a <M >", "<P<S>", "x <", " ", "\t\t", " a", "a ", "<P>\n"] * 5)
    forms = {x[2] for x in check(few)}
    assert forms == {"plain", "psm", "spm"}
    check(docs(spark, [made(k, 10 + 40 * k) for k in range(60)]))
    check(spark.read.parquet(f"{sf}/documents.parquet"))


@pytest.mark.parametrize("width", [1, 3, 700])
def test_giants_are_cut_alike(spark, monkeypatch, width):
    monkeypatch.setattr(M, "SLICE", width)
    table = docs(spark, [*(x for x in ODD if len(x or '') < 300), *(made(100 + k, 70) for k in range(12)), "a " * 60, " " * 90, "x" * 90, "<P" + "y " * 40, "<" * 60 + "S>" + "z" * 30])
    check(table.unionByName(table).unionByName(table.withColumn("doc_id", F.lit(None).cast("long"))), giant=50)


def test_long_text(spark):
    check(docs(spark, ["lorem ipsum\n" * 200_000, "x" * 3_000_000, " " * 1_000_000]))
    check(docs(spark, ["lorem ipsum\n" * 200_000, "é" * 3_000_000, " " * 1_000_000]), giant=1 << 20)


def test_no_rows_and_clashing_names(spark):
    assert M.fill_in_middle(empty(spark)).count() == 0
    table = docs(spark, ["a b c", None]).withColumn("form", F.lit("mine")).withColumn("extra", F.lit(7))
    out = M.fill_in_middle(table)
    assert out.columns.count("form") == 1 and {r.extra for r in out.collect()} == {7} and "mine" not in {r.form for r in out.collect()}
    assert M.fill_in_middle_report(table).count() == 2


def test_functions_compose_in_any_order():
    text = made(5, 4000).encode()
    data = np.frombuffer(text, np.uint8)
    blocks, many = M.AUTOMATON.blocks(data, np.array([len(data)]))
    left, counted = M.AUTOMATON.functions(blocks)
    whole, sums = M.AUTOMATON.composed(left, counted, np.zeros(len(left), np.int64))
    for state in range(M.AUTOMATON.states):
        at, total = state, 0
        for b in range(len(left)):
            at, total = left[b, at], total + counted[b, at]
            assert (whole[b, state], sums[b, state]) == (at, total)
    assert sums[-1, 0] % M.MARK == len(TOKEN.findall(text.decode()))


def test_small_texts_are_not_shuffled(spark, sf):
    plan = M.fill_in_middle_report(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
