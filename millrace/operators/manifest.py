"""Incremental builds: what has changed between two snapshots of the inputs, and a rewrite of the parts it touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import delete, new_path, written

#: Parts of a table that is built incrementally; one is rewritten whole if something in it changes.
PARTS = 64


def file_manifest(spark: SparkSession, path: str, pattern: str = "*", digests: bool = True) -> DataFrame:
    """(path, length, modified, digest) of the files below a folder; without digests no content is read, and files are
    told apart by length and time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    digest = F.sha2("content", 256) if digests else F.concat_ws(":", "length", F.unix_micros("modificationTime"))
    return files.select("path", "length", F.col("modificationTime").alias("modified"), digest.alias("digest"))


def row_manifest(rows: DataFrame, key: str, *content: str) -> DataFrame:
    """(path, digest) of rows: the key as a path, a digest of the rest."""
    return rows.select(F.col(key).cast("string").alias("path"), F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256).alias("digest"))


def difference(old: DataFrame, new: DataFrame) -> DataFrame:
    """(path, status) of two manifests: new, changed, removed or same. A path stands once in each."""
    was = old.select(F.col("path").alias("old"), F.col("digest").alias("before"))
    now = new.select(F.col("path").alias("new"), F.col("digest").alias("after"))
    both = was.join(now, F.col("old") == F.col("new"), "full")
    status = F.when(F.col("old").isNull(), "new").when(F.col("new").isNull(), "removed").when(F.col("before").eqNullSafe(F.col("after")), "same").otherwise("changed")
    return both.select(F.coalesce("new", "old").alias("path"), status.alias("status"))


def part_of(path: Column, parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(path), F.lit(parts)).cast("int")


def rebuilt(spark: SparkSession, table: str, manifest: str, now: DataFrame, build: Callable[[DataFrame], DataFrame], parts: int = PARTS) -> DataFrame:
    """Brings a table up to date with its inputs, and returns (path, status) of those that are not the same.

    now: the manifest of the inputs; build: rows from inputs (path), each with the path it comes from. The table has rows
    of inputs in parts by path; only parts with a new, changed or removed input are rewritten: from their rows of inputs
    that stay, and rows built of those that are new or changed. The manifest is replaced last, so a run that dies is
    made good by the next one.
    """
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    files = jvm(table).getFileSystem(spark._jsc.hadoopConfiguration())
    known = files.exists(jvm(manifest))
    old = spark.read.schema("path string, digest string").parquet(manifest) if known else now.select("path", "digest").where("false")
    scratch = new_path(spark, "difference")
    changes = written(difference(old, now).where("status <> 'same'").withColumn("part", part_of(F.col("path"), parts)), f"{scratch}/changes")
    touched = changes.select("part").distinct()
    # at most as many as the table has parts
    numbers = sorted(r.part for r in touched.collect())
    if numbers:
        fresh = build(changes.where("status in ('new', 'changed')").select("path")).withColumn("part", part_of(F.col("path"), parts))
        if files.exists(jvm(table)):
            stay = spark.read.schema(fresh.schema).parquet(table).where(F.col("part").isin(numbers)).join(changes.select("path"), "path", "left_anti")
            fresh = fresh.unionByName(stay)
        # written apart first: a part is never read and replaced at once
        made = written(fresh.repartition("part"), f"{scratch}/rows")
        left = {r.part for r in made.select("part").distinct().collect()}
        made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(table)
        for number in set(numbers) - left:
            files.delete(jvm(f"{table}/part={number}"), True)
    if numbers or not known:
        snapshot = written(now.select("path", "digest"), f"{scratch}/manifest")
        snapshot.write.mode("overwrite").parquet(manifest)
    delete(spark, f"{scratch}/rows")
    return changes.select("path", "status")
