import bz2
import io
import json
import logging
import os
import tarfile
import zipfile

import pytest

from millrace.operators import corpus
from millrace.plans.cli import main
from millrace.plans.config import ConfigError, read_config
from millrace.plans.pipeline import build
from millrace.sources.archives import memory_segments, parallel_texts, translation_memories, zip_members
from millrace.sources.files import lines, text_files
from millrace.sources.newspaper import newspapers
from millrace.sources.wiki import wiki_pages
from millrace.streaming.stream import corpus_stream


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("sources")
    books = root / "books"
    books.mkdir()
    (books / "1.txt").write_text("*** START OF x\n\nOne two.\n\nThree four.\n*** END OF x\n")
    (books / "2.txt").write_text("no marks")
    (books / "3.txt").write_bytes(b"\xff\xfe\xff")
    (books / "4.TXT").write_text("other case")
    (books / ".txt").write_text("no extension")
    news = root / "news"
    news.mkdir()
    (news / "a.json").write_text(json.dumps({"contentAsText": ["Der An", "fang war"]}))
    (news / "b.json").write_text("{}")
    (news / "c.json").write_text("{")
    page = "<page><title>{}</title><ns>0</ns><id>{}</id><revision><text>{}</text></revision></page>"
    wiki = "<mediawiki>" + page.format("A", 1, "Ein '''Text''' &lt;ref&gt;no&lt;/ref&gt; hier.") + page.format("B", 2, "#REDIRECT [[A]]") + page.format("C", 3, "") + "</mediawiki>"
    (root / "wiki.xml.bz2").write_bytes(bz2.compress(wiki.encode()))
    memory = root / "memory"
    memory.mkdir()
    unit = '<tu><tuv lang="EN-GB"><prop>x</prop><seg>first words</seg></tuv><tuv lang="DE-DE"><seg>erste <b>Worte</b></seg></tuv></tu>'
    with zipfile.ZipFile(memory / "v.zip", "w") as z:
        z.writestr("a.tmx", f'<?xml version="1.0" encoding="UTF-16"?><tmx><body>{unit}{unit}</body></tmx>'.encode("utf-16"))
        z.writestr("b.tmx", "<tmx><body>".encode("utf-16"))
        z.writestr("c.txt", b"other")
        z.writestr("d.tmx", b"\x00")
    (memory / "bad.zip").write_bytes(b"no zip")
    code = root / "code"
    code.mkdir()
    (code / "a.md").write_text("# Titre\n\nLe premier article.\n")
    tars = root / "tars"
    tars.mkdir()
    with tarfile.open(tars / "de-en.tgz", "w:gz") as t:
        for name, data in (("e.en", b"english"), ("e.de", "größer".encode())):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return root


def test_text_files(spark, tree):
    rows = {r.entity_id.rsplit("/", 1)[1]: r for r in text_files(spark, str(tree / "books"), "deu", "gutenberg").collect()}
    assert set(rows) == {"1.txt", "2.txt", "3.txt"}
    assert rows["3.txt"].error.kind == "IoError" and rows["3.txt"].content is None and rows["1.txt"].error is None


def test_newspapers(spark, tree):
    rows = {r.entity_id.rsplit("/", 1)[1]: r for r in newspapers(spark, str(tree / "news"), "deu").collect()}
    assert rows["a.json"].content == "Der Anfang war"
    assert rows["b.json"].error.kind == "ErroneousStructure" and rows["c.json"].error.kind == "JsonError"


def test_wiki(spark, tree):
    rows = wiki_pages(spark, str(tree / "wiki.xml.bz2"), "deu").collect()
    assert [r.content for r in rows] == ["Ein '''Text''' <ref>no</ref> hier."] and rows[0].position.path.endswith("wiki.xml.bz2")


def test_memories(spark, tree):
    segs = memory_segments(spark, str(tree / "memory"), "deu").collect()
    assert [r.text for r in segs if r.error is None] == ["erste Worte", "erste Worte"]
    assert {r.error_kind for r in segs if r.error} == {"IoError", "XmlParserError", "EncodingError"}
    rows = translation_memories(spark, str(tree / "memory"), "deu").where("error is null").collect()
    assert [r.content for r in rows] == ["erste Worte \x07 erste Worte \x07 \n"]
    assert translation_memories(spark, str(tree / "memory"), "deu", cap=5).where("error is null").first().content == "erste Worte \x07 \n"
    with pytest.raises(ValueError):
        memory_segments(spark, str(tree / "memory"), "qqq")


def test_parallel_texts(spark, tree):
    assert [(r.text, r.error) for r in parallel_texts(spark, str(tree / "tars"), "de").collect()] == [("größer", None)]
    bad = tree / "bad-tars"
    bad.mkdir()
    (bad / "a.tgz").write_bytes(b"no archive")
    with tarfile.open(bad / "b.tgz", "w:gz") as t:
        info = tarfile.TarInfo("x.de")
        info.size = 2
        t.addfile(info, io.BytesIO(b"\xff\xfe"))
    rows = parallel_texts(spark, str(bad), "de").collect()
    assert len(rows) == 2 and all(r.text is None and r.error for r in rows)


def config(tree, text):
    path = tree / "config.yaml"
    path.write_text(text)
    return str(path)


def test_pipeline(spark, tree, tmp_path):
    text = f"corpus:\n  deu:\n    wikipedia: {tree}/wiki.xml.bz2\n    gutenberg: {tree}/books\n    europeana: {tree}/news\n    dgt: {tree}/memory\n    stopwords: war, Der\n  fra:\n    codecivil: {tree}/code\n"
    read = read_config(config(tree, text))
    assert list(read) == ["deu", "fra"] and read["deu"].active() == "wikipedia, gutenberg, europeana, dgt"
    stats = {(r.lang, r.source): (r.entities_read, r.erroneous) for r in build(spark, read, str(tmp_path / "out"), ordered=True).collect()}
    assert stats == {("deu", "wikipedia"): (1, 0), ("deu", "gutenberg"): (3, 2), ("deu", "europeana"): (3, 2), ("deu", "dgt"): (4, 3), ("fra", "codecivil"): (1, 0)}
    got = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert got == sorted(["erste Worte", "erste Worte", "Anfang", "One two", "Three four", "Ein Text hier", "Titre", "Le premier article"])


@pytest.mark.parametrize("text,code", [("x: 1", 2), ("corpus: {xx: {}}", 24), ("corpus: {deu: {nosuch: a}}", 2), ("corpus: [", 2), ("corpus: {qqq: {}}", 24), ("corpus: {1: {}}", 24)])
def test_bad_configs(tree, text, code):
    with pytest.raises(ConfigError) as e:
        read_config(config(tree, text))
    assert e.value.exit_code == code


def test_command_line(tree, capsys):
    assert main(["--help"]) == 0 and main([]) == 1 and main([str(tree / "missing.yaml"), "out"]) == 1
    assert main([config(tree, "corpus: {xx: {}}"), "out"]) == 24


def test_any_language_and_messages(spark, tree, tmp_path):
    log = tmp_path / "run.log"
    handlers = f"handlers: {{f: {{class: logging.FileHandler, filename: {log}}}}}\n  root: {{level: INFO, handlers: [f]}}"
    assert main([config(tree, f"corpus:\n  yue:\n    gutenberg: {tree}/books\nlogging:\n  {handlers}\n"), str(tmp_path / "o")]) == 0
    assert "yue gutenberg: 3 entities, 2 erroneous" in log.read_text()
    logging.getLogger().handlers.clear()
    assert main([config(tree, "corpus: {yue: {}}\nlogging: {handlers: {f: {class: nothing.Here}}}"), "o"]) == 2
    assert main([config(tree, "corpus: {yue: {}}\nlogging: 3"), "o"]) == 2


def test_output_that_cannot_be_written(spark, tree, tmp_path):
    (tmp_path / "file").write_text("x")
    good = config(tree, f"corpus:\n  deu:\n    gutenberg: {tree}/books\n")
    assert main([good, str(tmp_path / "file")]) == 22 and main([good, str(tmp_path / "file" / "below")]) == 22
    assert sorted(os.listdir(tmp_path)) == ["file"] and (tmp_path / "file").read_text() == "x"


def test_counts_are_taken_while_writing(spark, tree, tmp_path):
    read = read_config(config(tree, f"corpus:\n  deu:\n    gutenberg: {tree}/books\n    europeana: {tree}/code\n"))
    assert [tuple(r) for r in build(spark, read, str(tmp_path / "o")).collect()] == [("deu", "gutenberg", 3, 2)]


def test_excluded_paths(spark, tree):
    found = text_files(spark, str(tree / "books"), "deu", "gutenberg", exclude="*/[12].txt").collect()
    assert [r.entity_id.rsplit("/", 1)[1] for r in found] == ["3.txt"]


def test_members_of_archives(spark, tree):
    rows = {(r.path.rsplit("/", 1)[1], r.member): r for r in zip_members(spark, str(tree / "memory")).collect()}
    assert set(rows) == {("v.zip", "a.tmx"), ("v.zip", "b.tmx"), ("v.zip", "c.txt"), ("v.zip", "d.tmx"), ("bad.zip", None)}
    assert bytes(rows["v.zip", "c.txt"].data) == b"other" and rows["bad.zip", None].error
    assert [r.member for r in zip_members(spark, str(tree / "memory"), ".TXT").collect() if r.member] == ["c.txt"]


def test_stream_equals_batch(spark, tree, tmp_path):
    batch = text_files(spark, str(tree / "books"), "deu", "gutenberg")
    corpus_stream(text_files(spark, str(tree / "books"), "deu", "gutenberg", stream=True), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    get = lambda df: sorted((r.entity_id, r.words) for r in df.select("entity_id", "words").collect())
    assert get(spark.read.parquet(str(tmp_path / "o"))) == get(corpus.to_corpus(batch)) != []


def test_index_lines(spark, tree):
    (tree / "index.lst").write_text(".:\na.txt\n")
    assert [(r.lnum, r.line) for r in lines(spark, str(tree / "index.lst")).collect()] == [(0, ".:"), (1, "a.txt"), (2, "")]


def test_archives_are_read_in_one_pass(spark, tmp_path):
    import zipfile

    from pyspark.sql import functions as F

    unit = '<tu><tuv lang="DE-01"><seg>eins</seg></tuv></tu>'
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        for k in range(3):
            z.writestr(f"m{k}.tmx", f"<tmx><body>{unit * (k + 1)}</body></tmx>".encode("utf-16"))
        z.writestr("odd.tmx", b"\xff\xfea")
    (tmp_path / "b.zip").write_bytes(b"no archive")
    asked = F.array(F.lit("deu"), F.lit("qqq"))
    found = memory_segments(spark, str(tmp_path), asked)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("zip_members") == 1
    got = sorted((r.asked, r.path.rsplit("/", 1)[1], r.member or "", r.seg_no, r.text or "", r.error_kind or "") for r in found.collect())
    segs = [("deu", "a.zip", f"m{k}.tmx", n, "eins", "") for k in range(3) for n in range(k + 1)]
    assert got == sorted([*segs, ("deu", "a.zip", "odd.tmx", 0, "", "EncodingError"), ("deu", "b.zip", "", 0, "", "IoError"), ("qqq", "a.zip", "", 0, "", "InvalidLanguageError"), ("qqq", "b.zip", "", 0, "", "InvalidLanguageError")])
