import collections
import random
import re

import corpus_pipeline as C
import pytest
from fixtures import DOCS, ODD, docs
from test_models import labelled
from test_pairs import groups, hits, near_copies
from test_tokens import check_packing

from millrace.llm import toxicity as T

ITEMS = [(1, "this is a passage of the benchmark that nobody should have in a training text at all"), (2, "short item")]


def form(value):
    """The pattern of values of the same form."""
    return "".join("[a-z]" if c.islower() else r"\d" if c.isdigit() else re.escape(c) for c in value)


@pytest.fixture
def folder(spark, tmp_path):
    toxic, labels = labelled(spark, 400)
    rng = random.Random(9)
    more = [*ODD, *near_copies(rng, 12), "before " + ITEMS[0][1] + " after", "a short item here", "call +1 (375) 555-4393 or ann.b.3@x1.example.com", None]
    toxic.unionByName(docs(spark, more, 1000)).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages(spark, folder):
    """Each stage against a plain model of it, on what the one before kept."""
    now = spark.read.parquet(f"{folder}/documents.parquet")
    columns = now.columns
    for name, stage in C.STAGES:
        out = C.written(stage(spark, now, folder), name)
        before, after = now.collect(), out.collect()
        ids = collections.Counter(r.doc_id for r in after)
        if name == "toxicity":
            told = {r.doc_id: r.predicted for r in T.toxicity_report(now, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
            assert sorted(ids) == sorted(i for i, p in told.items() if not p) and sum(told.values()) > 30
        elif name == "near_dedup":
            assert sorted(ids) == sorted(i for i, (_, c) in groups(before).items() if c == i) and len(ids) < len(before)
        elif name == "decontamination":
            assert sorted(ids) == sorted(i for i, x in hits(now, ITEMS).items() if not x[4]) and len(ids) == len(before) - 2
        elif name == "pii":
            # which values are personal is known here; their pseudonyms have the same form and all else is as it was
            now_texts = {r.doc_id: r.text for r in after}
            for r in before:
                parts = re.split(r"(\+1 \(\d{3}\) \d{3}-\d{4}|[\w.]+(?=@))", r.text or "")
                new = re.fullmatch("".join(re.escape(x) if k % 2 == 0 else f"({form(x)})" for k, x in enumerate(parts)), now_texts[r.doc_id] or "", re.S)
                assert new and all(a != b for a, b in zip(new.groups(), parts[1::2])) and (r.text is None) == (now_texts[r.doc_id] is None)
            assert any("@" in (r.text or "") for r in before)
        else:
            bins, least = check_packing(now, after)
            assert bins <= least + 1
            continue
        assert out.columns == columns and all(n == 1 for n in ids.values())
        now = out


def test_run(spark, folder):
    rows = C.run(spark, folder).collect()
    assert rows and len(C.STAGES) == 5 and C.ORACLE_SQL is None
    again = C.run(spark, folder).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows) == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in again)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert set(entry.oracle_sql()) <= set(names)
