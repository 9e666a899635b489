"""Rows and columns against plain counting."""

import bz2
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.corpus import capped
from millrace.operators.positions import line_numbers, text_positions
from millrace.sources.wiki import wiki_pages


@pytest.mark.parametrize("width", [1, 7, 1 << 12])
def test_positions_of_texts(spark, width):
    r = random.Random(width)
    rows = [(f, k * 3, r.choice([None, "", "a", "\n", "ab\n", "x\ny", "é中\n\n", "word " * r.randrange(5)])) for f in ("p", None, "q") for k in range(120)]
    got = text_positions(spark.createDataFrame(rows, "file string, nth long, text string"), ["file"], "nth", "text", width).collect()
    want, so_far = {}, {}
    for f, k, text in rows:
        before = so_far.get(f, "")
        want[f, k] = before.count("\n"), len(before) - before.rfind("\n") - 1
        so_far[f] = before + (text or "")
    assert {(x.file, x.nth): (x.row, x.col) for x in got} == want and len(got) == len(rows)


def test_no_task_holds_a_capped_member(spark):
    df = spark.range(5000).select(F.when(F.col("id") >= 0, "m").alias("m"), F.col("id").alias("n"), F.lit("four").alias("t"))
    out = capped(df, ["m"], "n", "t", 7000, width=100)
    assert sorted(r.n for r in out.collect()) == list(range(1750))
    windows = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
    assert sum("__block" in x.rsplit("[", 2)[1] for x in windows) == len(windows) - 1


def dump(pages):
    return "<mediawiki>\n" + "".join(f"  {pad}<page>\n    <title>T{k}</title>\n    <ns>0</ns>\n    <id>{k}</id>\n    <revision>\n      <id>9{k}</id>\n      <text>{text}</text>\n    </revision>\n  </page>\n" for k, (pad, text) in pages.items()) + "</mediawiki>\n"


def test_places_of_pages(spark, tmp_path):
    pages = {k: (" " * (k % 4), "line\n" * (k % 9) + f"text {k}" + ("#REDIRECT" if k == 5 else "")) for k in range(1, 400)}
    (tmp_path / "a.xml").write_text(dump(pages))
    (tmp_path / "b.xml.bz2").write_bytes(bz2.compress(dump({7: ("\t", "seven")}).encode()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        assert line_numbers(spark, str(tmp_path / "a.xml"), "<page").groupBy(F.spark_partition_id()).count().count() > 1
        rows = {r.entity_id.rsplit("/", 1)[1]: r.position for r in wiki_pages(spark, str(tmp_path), "deu").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    lines = dump(pages).split("\n")
    at = {}
    for n, line in enumerate(lines):
        if "<page>" in line:
            at[len(at) + 1] = n, line.index("<page>")
    assert {k: (p.kind, p.row, p.col) for k, p in rows.items()} == {f"a.xml#{k}": ("file", *at[k]) for k in pages} | {"b.xml.bz2#7": ("file", 1, 3)}
    assert {r.position.kind for r in wiki_pages(spark, str(tmp_path), "deu", places=False).collect()} == {"directory"}


def test_broken_pages_have_a_place(spark, tmp_path):
    (tmp_path / "c.xml").write_text("<mediawiki>\n<page>\n<id>3</id>\n<revision><text>fine</text></revision>\n</page>\n <page>\n<id>4</id>\n<revision><text>a <b> c</text></revision>\n</page>\n<page>\n<id>5</id>\n<revision><text>after</text></revision>\n</page>\n</mediawiki>")
    rows = {r.entity_id[-2:]: r for r in wiki_pages(spark, str(tmp_path / "c.xml"), "deu").collect()}
    assert rows["#4"].error.kind == "XmlParserError" and (rows["#4"].position.row, rows["#4"].position.col) == (5, 1) and rows["#3"].error is None
    assert rows["#5"].content == "after" and rows["#5"].position.row == 9
