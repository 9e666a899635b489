"""Every registered query of the library against its SQL."""

import os

import duckdb
import pytest

from millrace import queries as Q
from millrace.operators import catalog


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf}/{f}'")
    return c


def plain(value):
    if isinstance(value, (list, tuple)):
        return [plain(x) for x in value]
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, duck, sf, name):
    df = Q.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = sorted(([plain(r[c]) for c in cols] for r in df.collect()), key=repr)
    if name in Q.ORACLE_SQL:
        r = duck.execute(Q.ORACLE_SQL[name])
        names = [x[0] for x in r.description]
        want = sorted(([plain(x[names.index(c)]) for c in cols] for x in r.fetchall()), key=repr)
        assert sorted(names) == cols and got == want
    assert got


def test_corpus_of_short_paragraphs(spark, tmp_path):
    spark.createDataFrame([(k, "A\nAll rights reserved", ("de", "en", "fr", "es")[k // 35]) for k in range(140)], "doc_id long, text string, lang string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    with duckdb.connect() as c:
        c.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
        want = sorted(c.execute(Q.ORACLE_SQL["corpus_from_sources"]).fetchall())
    got = sorted((r.line, r.n) for r in Q.corpus_from_sources(spark, str(tmp_path)).collect())
    assert got == want and dict(got)["A"] == 120


def test_filters_reach_the_scan(spark, sf):
    plan = Q.not_present(spark, sf).where("lang = 'en'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in plan and "text" not in plan


def test_small_scans_are_spread(spark, tmp_path, monkeypatch):
    from millrace.sources import tables

    spark.range(3000).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    cores = spark.sparkContext.defaultParallelism
    assert tables.table(spark, str(tmp_path), "t").groupBy(tables.F.spark_partition_id()).count().count() == cores or cores == 1
    monkeypatch.setattr(tables, "FEW", 5000)
    assert "Exchange" not in tables.table(spark, str(tmp_path), "t")._jdf.queryExecution().executedPlan().toString()


def test_words_are_made_once(spark, sf):
    plan = Q.corpus_union(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan or all("regexp_replace" not in x for x in plan.splitlines() if "Filter" in x)


def test_to_fetch(spark):
    books = spark.createDataFrame([(2, "German", "b"), (1, "German", "a"), (3, "French", "c"), (4, "German", "d")], "book_no long, lang string, title string")
    files = spark.createDataFrame([(1, "1/1.txt"), (2, "2/2.txt"), (3, "3/3.txt")], "book_no long, path string")
    have = spark.createDataFrame([("1.txt",)], "name string")
    assert [r.book_no for r in catalog.to_fetch(books, files, "German").collect()] == [1, 2]
    assert [r.book_no for r in catalog.to_fetch(books, files, "German", have).collect()] == [2]


def test_archive_links(spark):
    found = spark.createDataFrame([(0, "x/bg-en.tgz"), (1, "x/de-en.tgz"), (2, "x/readme")], "pos int, link string")
    assert sorted(r.lang for r in catalog.language_of_archives(found).collect()) == ["bg", "de", "en"]
    assert catalog.archive_link(found, "de").first().link == "x/de-en.tgz" and catalog.archive_link(found, "en").first().link == "x/de-en.tgz"
    with pytest.raises(Exception, match="no archive"):
        catalog.archive_link(found, "qq").collect()


def test_archive_links_of_all_languages(spark):
    found = spark.createDataFrame([(0, "x/bg-en.tgz"), (1, "x/de-en.tgz"), (2, "x/readme"), (3, "de-notes"), (4, "y/bg-en.tgz"), (5, "fr-en.txt"), (6, "a-é-b")], "pos int, link string")
    got = {r.lang: r.link for r in catalog.archive_links(found).collect()}
    assert got == {"bg": "x/bg-en.tgz", "de": "x/de-en.tgz", "en": "y/bg-en.tgz"}
    assert got == {lang: catalog.archive_link(found, lang).first().link for lang in got}
    assert catalog.archive_links(found.where("pos = 2")).count() == 0


def test_stale(spark):
    files = spark.sql("select 'a' as path, current_timestamp() - interval 3 days as modificationTime union all select 'b', current_timestamp()")
    assert [r.path for r in catalog.stale(files).collect()] == ["a"]


def test_crawled_links(spark):
    found = spark.createDataFrame([("a/b.ZIP",), ("DEU/",), ("FRA",), ("Deu/",), ("x.txt",)], "link string")
    assert [r.link for r in catalog.zip_links(found).collect()] == ["a/b.ZIP"]
    assert sorted(r.link for r in catalog.language_folders(found).collect()) == ["DEU/", "FRA"]
    assert catalog.language_folders(found, "fra").first().link == "FRA"
    with pytest.raises(Exception, match="no folder"):
        catalog.language_folders(found, "spa").collect()
    assert catalog.newest_dump("deu", "/d") == "/d/dewiki/latest/dewiki-latest-pages-articles.xml.bz2"
