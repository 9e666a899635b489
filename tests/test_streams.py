"""Streams against the batch, with repeated entities and repeated batches."""

import shutil

import pytest
from pyspark.sql import functions as F

from millrace import schema
from millrace.operators import corpus
from millrace.streaming.stream import Progress, corpus_so_far, counted_stream, counts_so_far, told_apart


def some(spark, first, last):
    failed = F.when(F.col("id") % 5 == 0, F.struct(F.lit("IoError").alias("kind"), F.lit("bad").alias("message"), F.lit(None).cast("string").alias("lang")))
    rows = spark.range(first, last).select(
        F.when(F.col("id") % 2 == 0, "deu").otherwise("eng").alias("lang"), F.lit("s").alias("source"), F.col("id").cast("string").alias("entity_id"), F.lit(None).cast(schema.POSITION).alias("position"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("some words of "), F.col("id"))).alias("content"), failed.alias("error"),
    )
    return rows


def feed(spark, folder, *parts):
    for k, (first, last) in enumerate(parts):
        some(spark, first, last).coalesce(1).write.mode("append").parquet(str(folder))


def read(spark, folder):
    return spark.readStream.schema(schema.ENTITIES).option("maxFilesPerTrigger", 1).parquet(str(folder))


def totals(df):
    return {(r.lang, r.source): (r.entities_read, r.erroneous) for r in df.collect()}


def test_three_batches_one_repeated(spark, tmp_path):
    feed(spark, tmp_path / "in", (0, 40), (40, 90), (40, 90), (90, 100))
    progress = Progress(interval=50)
    spark.streams.addListener(progress)
    try:
        query = counted_stream(told_apart(read(spark, tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check"))
        query.awaitTermination()
        # more entities later, some of them known
        feed(spark, tmp_path / "in", (95, 130))
        counted_stream(told_apart(read(spark, tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
        spark.streams.removeListener(progress)
    batch = some(spark, 0, 130)
    assert totals(counts_so_far(spark, str(tmp_path / "out"))) == totals(corpus.run_stats(batch))
    get = lambda df: sorted((r.entity_id, r.words) for r in df.select("entity_id", "words").collect())
    assert get(corpus_so_far(spark, str(tmp_path / "out"))) == get(corpus.to_corpus(batch))
    assert spark.read.parquet(str(tmp_path / "out" / "quarantine")).count() == 26
    assert sum(progress.rows.values()) >= 185 and not progress.failed


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    """The checkpoint is lost after the batches were written: all are read again, and counted once."""
    feed(spark, tmp_path / "in", (0, 30), (30, 50))
    run = lambda name: counted_stream(read(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"), name).awaitTermination()
    run("a")
    once = totals(counts_so_far(spark, str(tmp_path / "out")))
    shutil.rmtree(tmp_path / "check")
    run("a")
    assert totals(counts_so_far(spark, str(tmp_path / "out"))) == once == totals(corpus.run_stats(some(spark, 0, 50)))
    shutil.rmtree(tmp_path / "check")
    run("b")
    assert {k: (2 * n, 2 * m) for k, (n, m) in once.items()} == totals(counts_so_far(spark, str(tmp_path / "out")))


def test_state_is_given_up_after_the_delay(spark, tmp_path):
    rows = some(spark, 0, 10).withColumn("at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out = told_apart(stream, "at", "1 hour")
    assert out.isStreaming and "DeduplicateWithinWatermark" in out._jdf.queryExecution().analyzed().toString()
    counted_stream(out.drop("at"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert sum(n for n, _ in totals(counts_so_far(spark, str(tmp_path / "out"))).values()) == 10


def test_failures_are_told(spark, tmp_path):
    feed(spark, tmp_path / "in", (0, 5))
    progress = Progress()
    spark.streams.addListener(progress)
    try:
        bad = read(spark, tmp_path / "in").withColumn("content", F.when(F.col("entity_id") == "3", F.raise_error(F.lit("boom"))).otherwise(F.col("content")))
        with pytest.raises(Exception, match="boom"):
            counted_stream(bad, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    finally:
        spark.streams.removeListener(progress)
    assert any("boom" in x for x in progress.failed.values())
