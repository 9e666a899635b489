"""What can't be read is kept, and everything that was read is accounted for."""

import json
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace import schema
from millrace.functions import text as T
from millrace.operators import corpus
from millrace.plans.cli import main
from millrace.plans.config import read_config
from millrace.plans.pipeline import AuditError, build


@pytest.fixture
def broken(tmp_path):
    """A good and a broken file of each source."""
    for d in ("books", "news", "code", "memory"):
        (tmp_path / d).mkdir()
    book = "*** START OF x\n" + "\n\n".join(f"p{k}" for k in range(10)) + "\n\nwords of a book\n*** END OF x\n"
    (tmp_path / "books" / "good.txt").write_text(book)
    (tmp_path / "books" / "bad.txt").write_bytes(b"\xff\xfe\xff")
    (tmp_path / "books" / "marks.txt").write_text("no marks")
    (tmp_path / "news" / "good.json").write_text('{"contentAsText": ["news of today"]}')
    (tmp_path / "news" / "bad.json").write_text("{")
    (tmp_path / "code" / "good.md").write_text("# Head\n\nfirst line here\n")
    (tmp_path / "code" / "bad.md").write_bytes(b"\xff")
    (tmp_path / "dump.xml").write_text("<mediawiki>\n<page>\n<id>1</id>\n<revision><text>wiki page</text></revision>\n</page>\n<page>\n<id>2</id>\n<revision><text>a <b> c</text></revision>\n</page>\n</mediawiki>")
    tmx = '<tmx><body><tu><tuv lang="DE-01"><seg>memory text</seg></tuv></tu></body></tmx>'
    with zipfile.ZipFile(tmp_path / "memory" / "v.zip", "w") as z:
        z.writestr("good.tmx", tmx.encode("utf-16"))
        z.writestr("odd.tmx", tmx.encode("utf-16") + b"x")
    (tmp_path / "memory" / "bad.zip").write_bytes(b"no archive")
    (tmp_path / "c.yaml").write_text(f"corpus:\n  deu:\n    wikipedia: {tmp_path}/dump.xml\n    gutenberg: {tmp_path}/books\n    europeana: {tmp_path}/news\n    codecivil: {tmp_path}/code\n    dgt: {tmp_path}/memory\n    stopwords: of, here\n")
    return tmp_path


STATS = {"wikipedia": (2, 1), "gutenberg": (3, 2), "europeana": (2, 1), "codecivil": (2, 1), "dgt": (3, 2)}


@pytest.mark.parametrize("ordered", [False, True])
def test_both_sinks(spark, broken, ordered):
    config = read_config(str(broken / "c.yaml"))
    counts = build(spark, config, str(broken / "out"), ordered=ordered)
    assert {r.source: (r.entities_read, r.erroneous) for r in counts.collect()} == STATS
    lines = sorted(r.value for r in spark.read.text(str(broken / "out")).collect())
    assert lines == ["Head", "first line", "memory text", "news today", "wiki page", "words a book"]
    kept = [json.loads(r.value) for r in spark.read.text(str(broken / "out.quarantine")).collect()]
    assert sorted(x["source"] for x in kept) == sorted(s for s, (_, n) in STATS.items() for _ in range(n))
    assert {x["error"]["kind"] for x in kept} == {"XmlParserError", "IoError", "ErroneousStructure", "JsonError", "EncodingError"}
    place = next(x for x in kept if x["source"] == "wikipedia")
    assert (place["position"]["row"], place["position"]["col"]) == (5, 0) and place["shown"].endswith("dump.xml: 5:0")
    assert not [p.name for p in broken.iterdir() if "staging" in p.name]


def test_command_line_writes_both(spark, broken):
    assert main([str(broken / "c.yaml"), str(broken / "o"), "--quarantine", str(broken / "q")]) == 0
    assert spark.read.text(str(broken / "q")).count() == 7 and spark.read.text(str(broken / "o")).count() == 6
    # again: both are replaced
    (broken / "books" / "bad.txt").unlink()
    assert main([str(broken / "c.yaml"), str(broken / "o"), "--quarantine", str(broken / "q")]) == 0
    assert spark.read.text(str(broken / "q")).count() == 6 and spark.read.text(str(broken / "o")).count() == 6


def test_audit(spark, broken, monkeypatch):
    from millrace.plans import pipeline

    monkeypatch.setattr(pipeline, "with_sinks", lambda e, s: corpus.with_sinks(e, s).where("sink <> 'quarantine' or not value like '%codecivil%'"))
    with pytest.raises(AuditError, match="7 entities can't be read, 6 are in"):
        build(spark, read_config(str(broken / "c.yaml")), str(broken / "out"))


def entities(spark, texts, langs):
    rows = [(lang, "s", str(k), text) for k, (text, lang) in enumerate(zip(texts, langs))]
    return spark.createDataFrame(rows, "lang string, source string, entity_id string, content string").withColumn("position", F.lit(None).cast(schema.POSITION)).withColumn("error", F.lit(None).cast(schema.ERROR))


def test_stop_words_as_data_are_the_written_out_ones(spark):
    r = random.Random(4)
    parts = ["ab", "a", "b'a", "Ab", "ab.", "(ab)", "\x07", "\n", " ", "…", "word", "ab ab", "1"]
    texts = [" ".join(r.choice(parts) for _ in range(r.randrange(12))) for _ in range(400)] + [None, "", "ab", "ab \x07", "\x07 ab", "ab \x07 a"]
    langs = [r.choice(["deu", "eng", None]) for _ in texts]
    stop = {"deu": ["ab", "a"], "eng": ["b'a", "word", "Ab"], "fra": ["1"]}
    df = entities(spark, texts, langs)
    words = T.text2words(F.col("content"))
    for lang, some in stop.items():
        words = F.when(F.col("lang") == lang, T.text2words(F.col("content"), some)).otherwise(words)
    want = {x.entity_id: x.w for x in df.select("entity_id", words.alias("w")).collect()}
    assert {x.entity_id: x.w for x in corpus.stopped_words(df, stop).select("entity_id", F.col("__words").alias("w")).collect()} == want


def test_plans_do_not_grow_with_stop_words(spark):
    df = entities(spark, ["w0x1 w1x1 other w1000x1"] * 2, ["l1", "l2"])
    many = {f"l{k}": [f"w{i}x{k}" for i in range(1000)] for k in range(200)}
    plan = lambda out: out._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert plan(corpus.to_corpus(df, many)) == plan(corpus.to_corpus(df, {"l1": ["w0x1"]}))
    assert [x.words for x in corpus.to_corpus(df, many).orderBy("lang").collect()] == ["other w1000x1\n", "w0x1 w1x1 other w1000x1\n"]


def test_parts_of_stop_words_stay_small(spark):
    many = spark.range(20_000).selectExpr("if(id % 10 = 0, 'eng', 'deu') as lang", "concat('w', id) as word")
    sets = {x.lang: x.stop for x in corpus.stop_sets(many).collect()}
    assert {lang: sum(map(len, stop)) for lang, stop in sets.items()} == {"eng": 2000, "deu": 18_000}
    assert all(max(map(len, stop)) < 16 for stop in sets.values())
