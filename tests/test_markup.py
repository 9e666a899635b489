import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import markup as M

WIKI = [
    ("Lima<ref>Census of 1993</ref>, Peru", "Lima, Peru"), ('she said <blockquote class="q">no more</blockquote> to it', "she said no more to it"), ("<blockquote></blockquote>", ""),
    ("above\n{| class=x\n! head\n|-\n| cell\n|}below", "above\nbelow"), ("sets {|x| : x in A|} of a line", "sets {|x| : x in A|} of a line"), ("if 3 < 7 and 9 > 2", "if 3 < 7 and 9 > 2"),
    ('one<ref name="k"/>two</ref>three', "onethree"), ("end<references/>of it", "end"), ("k<ref><em>m</em></ref>n", "k<e</em>n"), ("a<REF>b</REF>", "a<REF>b</REF>"),
    ("3<<4", "3<4"), ("<>", "<>"), ("p <}r> q", "p }<r> q"), ("{|\n{{x}}| seen\n|}y", " seen\n"), ("u<ref>v {| w</ref>x", "u wx"), ('see <a href="k">l</a>', 'see <a href="k">l</a>'),
    ("|{ odd\n| table\n|}", ""), ("{{stub}}\n{|\n|}\nrest", "{{stub}}\n\nrest"), ("", ""), ("|", "|"), ("{{a|b}}", "{{a|b}}"), ("x\n\n{|a|}{|b|}c", "x\n\nb|}c"),
]


@pytest.mark.parametrize("text,plain", WIKI)
def test_wikitext(text, plain):
    assert M.strip_wikitext(text) == (plain, None)


def test_wikitext_error_and_strict():
    assert M.strip_wikitext("no end <ref x") == (None, "text after opening <: ref x") and M.strip_wikitext("k<")[1] == "text after opening <: "
    assert M.strip_wikitext('one<ref name="k"/>two', True)[0] == "onetwo" and M.strip_wikitext("end<references/>of it", True)[0] == "endof it"
    assert M.strip_wikitext("k<ref><em>l</em><b>m</b></ref>n", True)[0] == "kn"


def test_wikitext_of_any_length():
    assert M.strip_wikitext("<ref>n</ref>m" * 50_000)[0] == "m" * 50_000 and M.strip_wikitext("<b" * 50_000)[0] is None
    assert M.strip_wikitext("{" * 100_000)[0] == "{" * 100_000


def test_deep_nesting():
    assert M.unformat(">" * 30_000 + " deep", "markdown", False)[1] in (None, "ErroneousStructure: nested too deeply")
    tree: list = [s("inner")]
    for _ in range(5000):
        tree = [{"t": "Emph", "c": tree}]
    assert M.blocks_text({"blocks": tree}) == ("inner", None)


def s(x):
    return {"t": "Str", "c": x}


def para(*c):
    return {"t": "Para", "c": list(c)}


SPACE = {"t": "Space"}
ATTR = ["", [], []]


def image(*words):
    return {"t": "Image", "c": [ATTR, [x for w in words for x in (s(w), SPACE)][:-1], ["u", ""]]}


TREES = [
    ([para(s("lone"))], "lone\n"), ([para({"t": "Emph", "c": [s("slanted")]})], "slanted\n"), ([para(s("k")), para(s("mn"))], "k mn\n"),
    ([para(s("re"), {"t": "Strong", "c": [s("think")]}, s("ing"))], "re think ing\n"),
    ([para(s("he1"), {"t": "Quoted", "c": [{"t": "DoubleQuote"}, [s("oh"), SPACE, s("no")]]}, s("said"))], "he1 oh no\nsaid\n"),
    ([{"t": "BlockQuote", "c": [para(s("cited"))]}, para(s("after"))], "cited\nafter\n"), ([para(s("CO"), {"t": "Subscript", "c": [s("2")]}, s("gas"))], "CO gas\n"),
    ([para(s("to"), {"t": "Note", "c": [para(s("aside"))]}, s("be"))], "to aside\nbe\n"), ([para(image("three", "cats", "asleep"))], "three cats asleep\n"), ([para(image("two", "cats"))], ""),
    ([{"t": "OrderedList", "c": [[1], [[para(s("first"))], [para(s("second"))]]]}], "first\nsecond\n"), ([{"t": "Header", "c": [1, ATTR, [s("top")]]}, {"t": "Header", "c": [2, ATTR, [s("sub")]]}], "top\nsub\n"),
    ([{"t": "Div", "c": [ATTR, [para(s("boxed"))]]}], "boxed\n"), ([{"t": "Table", "c": []}, {"t": "Null"}, {"t": "CodeBlock", "c": [ATTR, "x"]}], ""),
    ([para({"t": "Link", "c": [ATTR, [s("label")], ["u", ""]]})], "label\n"), ([para({"t": "Code", "c": [ATTR, "q"]}, s("rest"))], "rest\n"), ([para({"t": "Span", "c": [ATTR, [s("some"), SPACE, s("span")]]})], "some span\n"),
    ([{"t": "DefinitionList", "c": [[[s("term")], [[para(s("meaning"))]]]]}], "term meaning\n"), ([para({"t": "SmallCaps", "c": [s("caps")]}, SPACE, {"t": "Strikeout", "c": [s("gone")]})], "caps gone\n"),
    ([para({"t": "Superscript", "c": [s("2")]}, {"t": "Math", "c": [{}, "x"]}, {"t": "RawInline", "c": ["html", "y"]}, {"t": "Cite", "c": [[], [s("z")]]}, s("left"))], "left\n"),
    ([{"t": "BulletList", "c": [[para(s("one"))], [{"t": "Plain", "c": [s("two")]}]]}, {"t": "HorizontalRule"}, {"t": "RawBlock", "c": ["html", "<p>"]}], "one\ntwo\n"), ([para(s("x")), {"t": "LineBlock", "c": [[s("verse")]]}], "x "),
]


@pytest.mark.parametrize("blocks,text", TREES)
def test_trees(blocks, text):
    content, error = M.tree_text(json.dumps({"blocks": blocks}))
    assert error is None and content.replace(" \x07 ", "\n") == text


def test_bad_trees():
    assert M.tree_text("{")[1].startswith("JsonError")
    assert "blocks" in M.tree_text("[]")[1] and "unknown node" in M.tree_text('{"blocks": [{"t": "Figure"}]}')[1]
    quote = json.dumps({"blocks": [para({"t": "Quoted", "c": [{"t": "SingleQuote"}, [s("ab")]]})]})
    assert M.tree_text(quote)[1] and M.tree_text(quote, True) == ("ab \x07 ", None)


def test_a_first_context_of_one_character():
    for markup in ("markdown", "mediawiki"):
        assert M.unformat("A\n\nAll of it", markup, False)[0] == "A All of it \x07 "
        assert M.unformat("A\n\nAll of it", markup, True)[0] == "A \x07 All of it \x07 "


def test_readers():
    md = "# Head *x*\n\nSome **bold** text [link](http://a) ![a picture of cats](x.png) ![no](y)\n\n- a b\n- c d\n\n> quote\n\n```\ncode\n```\n1. one\n2. two\n\nSet\n===\n"
    content, _ = M.unformat(md, "markdown", False)
    assert [" ".join(x.split()) for x in content.split("\x07")] == ["Head x", "Some bold text link a picture of cats", "a b", "c d", "quote", "one", "two", "Set", ""]
    wiki = "== Head ==\nText '''bold''' [[a|b]] {{tmpl|{{x}}}} <ref>n</ref>.\n\n* i j\n* k l\n[[File:x.jpg|thumb|a long nice caption]]\n{|\n| cell\n|}\n[[Category:no]]"
    content, _ = M.unformat(wiki, "mediawiki", True)
    assert [" ".join(x.split()) for x in content.split("\x07")][:5] == ["Head", "Text bold b .", "i j", "k l", "a long nice caption"]


def test_columns(spark):
    df = spark.createDataFrame([("<ref>p</ref>q",), (None,), ("r<b",)], "x string")
    got = [(r.r.content, r.r.error) for r in df.select(M.wikitext(F.col("x")).alias("r")).collect()]
    assert got == [("q", None), (None, None), (None, "text after opening <: b")]


def test_results_do_not_wait_as_objects():
    import tracemalloc

    import pyarrow as pa

    texts = pa.array(["x" * 1_000_000] * 100 + [None, "k<"])
    tracemalloc.start()
    got = M._results(texts, M.strip_wikitext)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == 102 and got[99]["content"].as_py() == "x" * 1_000_000 and got[101]["error"].as_py() == "text after opening <: "
    assert got[100].as_py() == {"content": None, "error": None} and peak < 20_000_000


def test_plain_texts_are_not_searched_for_spans(monkeypatch):
    class Never:
        def finditer(self, text):
            raise AssertionError(text)

    assert [x["t"] for x in M._inline("a *b* c")] == ["Str", "Space", "Emph", "Space", "Str"]
    monkeypatch.setattr(M, "_INLINE", Never())
    assert M.unformat("# Head\n\nplain words (of a line), and more.", "markdown", False)[0] == "Head \x07 plain words (of a line), and more. \x07 "


def test_results_leave_the_worker_piece_by_piece(spark):
    import pyarrow as pa

    df = spark.range(42, numPartitions=1).select("id", F.expr("if(id = 40, null, repeat(chr(97 + cast(id % 26 as int)), if(id = 41, 0, 1000000)))").alias("x"))
    rows = df.select("id", "x", M._mapped(F.col("x"), lambda t: (t, str(pa.total_allocated_bytes()))).alias("r")).collect()
    assert [r.id for r in rows] == list(range(42)) and all(r.x == r.r.content for r in rows)
    held = [int(r.r.error) for r in rows if r.x is not None]
    assert rows[40].r == (None, None) and max(held) < 10_000_000  # of 40 MB of results in all
