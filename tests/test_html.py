"""Links against the standard library's reader of HTML, references against its joiner."""

import html as stdlib
import random
from urllib.parse import urldefrag, urljoin

from pyspark.sql import functions as F

from millrace.functions import html as H
from millrace.functions import text as T


def found(spark, pages, **options):
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, h string").select("i", H.links(F.col("h"), **options).alias("l")).orderBy("i").collect()
    return [r.l for r in rows]


def test_what_is_no_anchor(spark):
    pages = [
        '<!-- <a href="hidden"> --><a href="seen">', '<script>var x = "<a href=js>";</script><a href=1>', "<style><a href=css></style ><a href=2>", "<textarea><a href=3></textarea>", "<title><a href=4></title><a href=5>",
        '<img alt="<a href=\'no\'>"><a href=6>', "<!--><a href=7>-->", "<!-- a --!><a href=8>", "<!-- never closed <a href=9>", "<script src=x><a href=10>", "<! doctype <a href=11><a href=12>", "</ <a href=13><a href=14>", "<?php <a href=15> ?><a href=16>",
        "<a\nhref\n=\n17\n>", "<A HREF=18 HREF=19>", "<abbr href=20><a-b href=21>", "<a title=it's href=22><a title=\"a > b\" href=23>", "<a href=a/b/><a href = >", "<a href>", "<a x='href=24' href='25'/>", "a < b <a href=26", None, "",
        "<SCRIPT>x</scripty><a href=27></SCRIPT><a href=28>", "<scripty><a href=29>", "<a/href=30>", "<p<a href=31>", "<a\thref=\"line\nfeed\">",
    ]
    assert found(spark, pages) == [
        ["seen"], ["1"], ["2"], [], ["5"], ["6"], ["7"], ["8"], [], [], ["12"], ["14"], ["16"],
        ["17"], ["18", "19"], [], ["22", "23"], ["a/b/", ""], [], ["25"], [], None, [],
        ["28"], ["29"], ["30"], [], ["line\nfeed"],
    ]
    assert found(spark, ["<a href=1 href=2><a href=3>"], last=True) == [["2", "3"]]
    assert spark.sql("select 1").select(T.links(F.lit("<a href='x'>"))).first()[0] == ["x"]


def test_references(spark):
    values = ["x?a=1&amp;b=2", "&#38;&#x26;&#X26&#38", "&eacute;&Eacute;&notin;&not;&nosuch;", "&copy=1&copy", "&copyx", "&lt;&gt;&quot;&apos;&nbsp;&AMP;&amp", "&#0;&#xD800;&#x110000;&#99999999999999;&#128;&#x9F;", "&#x1F600;&#8364;", "a & b && c&", "&;&#;&#x;", "&amp;amp;", "&NotEqualTilde;", "&#00000000000038;"]
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", H.references_decoded(F.col("v")).alias("d")).orderBy("i").collect()
    assert [r.d for r in rows] == [
        "x?a=1&b=2", "&&&&", "éÉ∉¬&nosuch;", "&copy=1©", "&copyx", "<>\"'\xa0&&", "����€Ÿ", "😀€", "a & b && c&", "&;&#;&#x;", "&amp;", "≂̸", "&",
    ]
    named = [f"&{n}" for n in stdlib.entities.html5]
    rows = spark.createDataFrame([(n,) for n in named], "v string").select("v", H.references_decoded(F.col("v")).alias("d")).collect()
    assert all(r.d == stdlib.unescape(r.v) for r in rows) and len(rows) > 2000


def test_long_pages(spark):
    page = "<p title='" + "x" * 200_000 + "'>" + "<a href=z>" * 3000 + "<!--" + "<a href=y>" * 20_000 + "-->" + "<a " + "b " * 50_000 + "href=last>" + "<script>" + "<a href=q>" * 20_000
    assert found(spark, [page]) == [["z"] * 3000 + ["last"]]


def test_resolution(spark):
    r = random.Random(5)
    segments = ["a", "b.c", ".", "..", "", "g;x=1", "...", "..x"]
    bases = ["http://a/b/c/d;p?q", "http://h.example", "https://h.example/", "http://h/a/../b?x=/../y#f", "http://h/a//b/"]
    references = ["g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "g?y#s", ";x", "", ".", "./", "..", "../", "../g", "../..", "../../../g", "/./g", "/../g", "g.", ".g", "g/./h", "g;x=1/../y", "g?y/./x", "g#s/../x", "mailto:x@y", "https://o/p/../q", " g\n", "g\nh", "//o/./p?q#r", "x:y/../z"]
    references += ["/".join(r.choice(segments) for _ in range(r.randrange(1, 6))) for _ in range(150)]
    pairs = [(b, x) for b in bases for x in references if not x.startswith(("//", " ", "//o")) or x in ("//g", "//o/./p?q#r")]
    rows = spark.createDataFrame([(i, b, x) for i, (b, x) in enumerate(pairs)], "i int, b string, x string").select("i", H.resolved(F.col("b"), F.col("x")).alias("u")).orderBy("i").collect()
    for (b, x), row in zip(pairs, rows):
        # the joiner keeps dots where it joins nothing, and its reading of empty segments and odd schemes is its own
        if x in ("g\nh", "?y", "x:y/../z", "", "#s", "//o/./p?q#r") or "//" in x or "//" in b[8:] or x.startswith("https"):
            continue
        assert row.u == urldefrag(urljoin(b, x.strip()))[0], (b, x)
    plain = dict(zip(pairs, (r.u for r in rows)))
    assert plain["http://a/b/c/d;p?q", "?y"] == "http://a/b/c/d;p?y" and plain["http://a/b/c/d;p?q", "g\nh"] == "http://a/b/c/gh"
    assert plain["http://a/b/c/d;p?q", "https://o/p/../q"] == "https://o/q" and plain["http://a/b/c/d;p?q", "mailto:x@y"] == "mailto:x@y"
    assert plain["http://a/b/c/d;p?q", "//o/./p?q#r"] == "http://o/p?q" and plain["http://h/a/../b?x=/../y#f", ""] == "http://h/b?x=/../y" and plain["http://a/b/c/d;p?q", "x:y/../z"] == "x:y/../z"
    row = spark.sql("select 1").select(H.resolved(F.lit(None).cast("string"), F.lit("a")).alias("n"), H.resolved(F.lit("http://a/b"), F.lit(None).cast("string")).alias("m")).first()
    assert row.n is None and row.m is None


def test_reachable_pages(spark):
    from millrace.operators.crawl import link_graph, reachable

    pages = [
        ("http://h/a", "<a href=b><a href='/c#x'><a href=b>"), ("http://h/b#y", "<a href=a><a href=d/e><!-- <a href=z> -->"), ("http://h/c", "<a href=//o/p>"), ("http://h/d/e", "<a href=../f>"),
        ("http://h/f", "<a href=f><a href=a>"), ("http://h/z", "<a href=a>"), (None, "<a href=a>"), ("http://h/n", None),
    ]
    graph = link_graph(spark.createDataFrame(pages, "url string, html string"))
    seeds = spark.createDataFrame([("http://h/a",), ("http://h/a",), (None,)], "url string")
    out = reachable(graph, seeds)
    assert sorted(map(tuple, out.collect())) == [("http://h/a", 0), ("http://h/b", 1), ("http://h/c", 1), ("http://h/d/e", 2), ("http://h/f", 3), ("http://o/p", 2)]
    assert {r.url for r in reachable(graph, seeds, F.col("dst").startswith("http://h/"), 2).collect()} == {"http://h/a", "http://h/b", "http://h/c", "http://h/d/e"}
    assert reachable(graph, seeds.where("false")).count() == 0
