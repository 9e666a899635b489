"""Folders that tasks list and read, against Spark's own reader of files, which lists them in the driver."""

import os

import pytest

from millrace.plans.config import LanguageConfig
from millrace.plans.pipeline import build
from millrace.sources import folders
from millrace.sources.files import binary_files, text_files
from millrace.sources.newspaper import newspapers


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("folders")
    names = ["a.txt", "with space.txt", "100%25.txt", "größer.txt", "b.TXT", "c.md", ".txt", ".hidden.txt", "_hidden.txt", "_metadata.txt", "_k=v.txt", "sub/d.txt", "sub/deep/e.txt", "sub/_no/f.txt", "sub/.git/g.txt", "txt", "x.txt._COPYING_"]
    for k, name in enumerate(names):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(f"text {k} ".encode() * k)
    os.symlink(root / "sub" / "d.txt", root / "link.txt")
    os.symlink(root / "nowhere", root / "broken.txt")
    (root / "folder.txt").mkdir()
    return root


def rows(df):
    return sorted((r.path, r.modificationTime, r.length, bytes(r.content)) for r in df.select("path", "modificationTime", "length", "content").collect())


def sparks(spark, paths, recursive=False):
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", str(recursive).lower()).load(paths)


@pytest.mark.parametrize("recursive", [False, True])
def test_files_are_those_of_sparks_reader(spark, root, recursive):
    for paths in ([str(root)], [str(root), f"{root}/sub/"], [f"file:{root}/a.txt", f"{root}/sub/deep/e.txt"]):
        assert rows(folders.files_of(spark, paths, "txt", recursive).where("length > 0")) == rows(sparks(spark, paths, recursive)) != []
    both = [str(root / "sub"), str(root / "sub" / "d.txt")]
    if not recursive:  # a file that is asked for twice is there twice
        assert rows(folders.files_of(spark, both, "txt")) == rows(sparks(spark, both)) and folders.files_of(spark, both, "txt").count() == 2


def test_driver_holds_no_list_of_files(spark, tmp_path):
    for k in range(200):
        (tmp_path / f"{k}.txt").write_text(f"text {k}")
        (tmp_path / f"{k}.json").write_text(f'{{"contentAsText": ["text {k}"]}}')
    for found in (text_files(spark, str(tmp_path), "deu", "gutenberg"), newspapers(spark, str(tmp_path), "deu")):
        assert found.inputFiles() == []
        assert sorted(r.content for r in found.collect()) == sorted(f"text {k}" for k in range(200))


def test_tasks_grow_with_files_and_bytes(spark, tmp_path, monkeypatch):
    for k in range(100):
        (tmp_path / f"{k}.txt").write_bytes(b"x" * 1000)
    tasks = lambda: folders.files_of(spark, [str(tmp_path)], "txt").rdd.getNumPartitions()
    monkeypatch.setattr(folders, "FILES", 2)
    assert tasks() == max(50, min(100, 2 * spark.sparkContext.defaultParallelism))
    monkeypatch.setattr(folders, "BYTES", 1200)
    assert tasks() == max(84, min(100, 2 * spark.sparkContext.defaultParallelism))
    monkeypatch.setattr(folders, "FILES_AT_ONCE", 7)
    monkeypatch.setattr(folders, "AT_ONCE", 2500)
    assert folders.files_of(spark, [str(tmp_path)], "txt").count() == 100


def test_what_only_spark_reads(spark, tmp_path):
    (tmp_path / "k=1").mkdir()
    (tmp_path / "k=1" / "a.txt").write_text("a")
    (tmp_path / "b.txt").write_text("b")
    assert folders.files_of(spark, [str(tmp_path)], "txt") is None and rows(binary_files(spark, str(tmp_path), "txt")) == rows(sparks(spark, str(tmp_path)))
    assert folders.files_of(spark, [f"{tmp_path}/*"], "txt") is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        binary_files(spark, str(tmp_path / "missing"), "txt")


def test_name_that_is_no_text(spark, tmp_path):
    with open(os.path.join(os.fsencode(tmp_path), b"caf\xe9.txt"), "wb") as f:
        f.write(b"latin")
    assert [(r.path.rsplit("/", 1)[1], bytes(r.content)) for r in folders.files_of(spark, [str(tmp_path)], "txt").collect()] == [("caf�.txt", b"latin")]


def test_empty_files_are_entities(spark, tmp_path):
    """Spark's reader leaves them out, so an empty book was no error."""
    (tmp_path / "b.txt").write_text("")
    assert [tuple(r) for r in build(spark, {"deu": LanguageConfig({"gutenberg": str(tmp_path)})}, str(tmp_path / "out")).collect()] == [("deu", "gutenberg", 1, 1)]


def test_empty_folder(spark, tmp_path):
    assert text_files(spark, str(tmp_path), "deu", "gutenberg").collect() == []
