"""Plans that don't grow with the languages."""

import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.plans.config import ConfigError, LanguageConfig, read_config
from millrace.plans.pipeline import build, entities
from millrace.sources.files import languages_of


def test_longest_root_wins(spark):
    roots = {"file:/a": ["x"], "file:/a/b": ["y", "z"], "file:/a/b/c.txt": ["f"]}
    paths = ["file:/a/1.txt", "file:/a/b/2.txt", "file:/a/b/c.txt", "file:/a/bc/3.txt", "file:/other", None]
    rows = spark.createDataFrame([(k, p) for k, p in enumerate(paths)], "k int, p string").select("k", languages_of(F.col("p"), roots).alias("l")).orderBy("k").collect()
    assert [r.l for r in rows] == [["x"], ["y", "z"], ["f"], ["x"], None, None]


def codes(n):
    letters = "abcdefghijklmnop"
    return [a + b + c for a in letters for b in letters for c in letters][:n]


def folders(root, n):
    """So many languages with books and memories, one of them with a page; the memories of all in one folder."""
    config = {}
    (root / "m").mkdir()
    with zipfile.ZipFile(root / "m" / "v.zip", "w") as z:
        z.writestr("a.tmx", '<tmx><body><tu><tuv lang="DE"><seg>deutsch</seg></tuv><tuv lang="FR"><seg>francais</seg></tuv></tu></body></tmx>'.encode("utf-16"))
    for k, code in enumerate([*codes(n - 2), "deu", "fra"]):
        (root / code).mkdir()
        (root / code / f"{k}.md").write_text(f"# head {code}\n")
        config[code] = LanguageConfig({"codecivil": str(root / code), **({"dgt": str(root / "m")} if code in ("deu", "fra", "aaa") else {})}, ["head"] if k % 2 else [])
    return config


def nodes(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("\n")


def test_one_scan_for_all_languages(spark, tmp_path):
    (tmp_path / "few").mkdir()
    (tmp_path / "many").mkdir()
    few, many = folders(tmp_path / "few", 3), folders(tmp_path / "many", 300)
    assert nodes(entities(spark, few)) == nodes(entities(spark, many))
    stats = {(r.lang, r.source): (r.entities_read, r.erroneous) for r in build(spark, many, str(tmp_path / "out")).collect()}
    assert len(stats) == 303 and stats["deu", "dgt"] == (1, 0) and stats["aaa", "dgt"] == (1, 1) and stats["abc", "codecivil"] == (1, 0)
    lines = {r.value for r in spark.read.text(str(tmp_path / "out")).collect()}
    assert {"deutsch", "francais", "head aaa", "aab"} <= lines
    assert spark.read.text(str(tmp_path / "out.quarantine")).first().value.count("no two-letter code for language aaa") >= 1


def test_patterns_of_paths(spark, tmp_path):
    for name in ("a1", "a2", "b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.md").write_text("text\n")
    config = {"deu": LanguageConfig({"codecivil": f"{tmp_path}/a*"}), "fra": LanguageConfig({"codecivil": f"{tmp_path}/b"})}
    assert sorted(r.lang for r in entities(spark, config).collect()) == ["deu", "deu", "fra"]


def test_excluded_paths_of_a_configuration(spark, tmp_path):
    for name in ("deu/.git/a.md", "deu/b.md", "deu/draft-c.md", "fra/draft-d.md", "glob1/draft-e.md", "glob2/f.md"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("text\n")
    path = tmp_path / "c.yaml"
    path.write_text(f"corpus:\n  deu:\n    codecivil: {{path: {tmp_path}/deu, exclude: ['*/.git/*', '*/draft-*']}}\n  fra:\n    codecivil: {tmp_path}/fra\n  spa:\n    codecivil: {{path: '{tmp_path}/glob*', exclude: '*/draft-*'}}\n")
    config = read_config(str(path))
    assert config["deu"].excluded == {"codecivil": ["*/.git/*", "*/draft-*"]} and config["fra"].excluded == {}
    assert sorted((r.lang, r.entity_id.rsplit("/", 1)[1]) for r in entities(spark, config).collect()) == [("deu", "b.md"), ("fra", "draft-d.md"), ("spa", "f.md")]
    for bad in ("{exclude: x}", "{path: a, other: b}", "3"):
        path.write_text(f"corpus:\n  deu:\n    codecivil: {bad}\n")
        with pytest.raises(ConfigError):
            read_config(str(path))
