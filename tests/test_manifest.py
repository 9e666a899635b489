"""Incremental builds against full ones."""

import os

from pyspark.sql import functions as F

from millrace.operators.manifest import difference, file_manifest, part_of, rebuilt, row_manifest
from millrace.sources.files import text_files


def status(df):
    return {r.path.rsplit("/", 1)[-1]: r.status for r in df.collect()}


def test_difference(spark):
    frame = lambda rows: spark.createDataFrame(rows, "path string, digest string")
    old, new = frame([("a", "1"), ("b", "1"), ("c", None), ("d", None), ("e", "1")]), frame([("a", "1"), ("b", "2"), ("c", None), ("d", "1"), ("f", "1")])
    assert status(difference(old, new)) == {"a": "same", "b": "changed", "c": "same", "d": "changed", "e": "removed", "f": "new"}
    assert status(difference(old.where("false"), new.where("path = 'a'"))) == {"a": "new"} and difference(old.where("false"), new.where("false")).count() == 0
    rows = spark.createDataFrame([(1, "x", None), (2, None, "x")], "id long, t string, u string")
    assert row_manifest(rows, "id", "t", "u").select("digest").distinct().count() == 2


def test_an_updated_table_is_a_rebuilt_one(spark, tmp_path):
    folder, table, manifest = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "manifest")
    folder.mkdir()
    for k in range(40):
        (folder / f"{k}.txt").write_text(f"text {k}")
    every = lambda: text_files(spark, str(folder), "deu", "s").select(F.col("entity_id").alias("path"), "content")
    built = []

    def build(inputs):
        built.append(inputs.count())
        return every().join(inputs, "path", "left_semi").withColumn("words", F.upper("content"))

    def update():
        return status(rebuilt(spark, table, manifest, file_manifest(spark, str(folder), "*.txt"), build, parts=16))

    def check():
        got = sorted((r.path, r.words, r.part) for r in spark.read.parquet(table).collect())
        assert got == sorted((r.path, r.words, r.part) for r in every().withColumn("words", F.upper("content")).withColumn("part", part_of(F.col("path"), 16)).collect())

    def parts():
        return {d: sorted(os.listdir(f"{table}/{d}")) for d in os.listdir(table) if d.startswith("part=")}

    assert set(update().values()) == {"new"} and built == [40]
    check()
    before = parts()
    assert update() == {} and parts() == before and built == [40]
    (folder / "3.txt").write_text("other")
    (folder / "41.txt").write_text("text 41")
    (folder / "7.txt").unlink()
    os.utime(folder / "5.txt", (1, 1))  # a new time alone is no change
    assert update() == {"3.txt": "changed", "41.txt": "new", "7.txt": "removed"} and built == [40, 2]
    check()
    changed = {d for d in before if before[d] != parts().get(d)}
    assert 1 <= len(changed) <= 3
    for k in range(42):
        if k != 3:
            (folder / f"{k}.txt").unlink(missing_ok=True)
    update()
    check()
    assert len(parts()) == 1
    (folder / "3.txt").unlink()
    update()
    assert not parts()


def test_manifest_without_digests_reads_no_content(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    files = file_manifest(spark, str(tmp_path), digests=False)
    assert files.first().length == 1 and "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
