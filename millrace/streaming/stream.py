"""Operators over streams: row-local ones as in batch, counts that survive runs, entities told apart by state, progress."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.corpus import quarantine, run_stats, to_corpus

log = logging.getLogger("millrace")

#: Entities between two messages.
INTERVAL = 500
COUNTS = "lang string, source string, entities_read long, erroneous long, run string, batch long"


def corpus_stream(entities: DataFrame, output: str, checkpoint: str, stopwords: dict[str, list[str]] | None = None) -> StreamingQuery:
    """Appends the corpus of a stream of entities to a table, and stops when all that is there is read."""
    out = to_corpus(entities, stopwords)
    return out.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).partitionBy("lang", "source").trigger(availableNow=True).start()


def streamed(rows: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Appends a stream of rows to a table, and stops when all that is there is read."""
    return rows.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def told_apart(entities: DataFrame, event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """A stream's entities, each once: state keeps the language, source and id of those that were seen.

    event_time: a time of each entity; then state is given up for those that are older than the delay, else it grows with
    the number of entities.
    """
    keys = ["lang", "source", "entity_id"]
    if event_time is None:
        return entities.dropDuplicates(keys)
    return entities.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def counted_stream(entities: DataFrame, output: str, checkpoint: str, run: str = "run", stopwords: dict[str, list[str]] | None = None) -> StreamingQuery:
    """Writes the corpus, what can't be read and the counts of each batch below output, and stops when all is read.

    A batch has folders of its own, named by run and batch, and replaces them: one that is repeated after a failure, or
    whose checkpoint is older than its output, is never counted twice. run tells streams apart that share an output.
    """

    def each(batch: DataFrame, number: int) -> None:
        here = lambda part: f"{output}/{part}/run={run}/batch={number}"
        batch.persist()
        try:
            to_corpus(batch, stopwords).write.mode("overwrite").parquet(here("corpus"))
            quarantine(batch).write.mode("overwrite").parquet(here("quarantine"))
            # last, and in one file that appears at once: what is counted has been written
            run_stats(batch).coalesce(1).write.mode("overwrite").parquet(here("counts"))
        finally:
            batch.unpersist()

    return entities.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_so_far(spark: SparkSession, output: str) -> DataFrame:
    """Entities read and erroneous ones of each language and source, over all batches of all runs."""
    every = spark.read.schema(COUNTS).parquet(f"{output}/counts")
    return every.groupBy("lang", "source").agg(F.sum("entities_read").alias("entities_read"), F.sum("erroneous").alias("erroneous"))


class Progress(StreamingQueryListener):
    """Says how far a stream is: once for each so many entities, and at its end. rows: of each query, by id."""

    def __init__(self, interval: int = INTERVAL):
        self.interval, self.rows, self.failed, self.ended = interval, {}, {}, set()

    def onQueryStarted(self, event) -> None:
        self.rows.setdefault(str(event.id), 0)  # a query that is started again goes on

    def onQueryProgress(self, event) -> None:
        p = event.progress
        before = self.rows.get(str(p.id), 0)
        now = self.rows[str(p.id)] = before + p.numInputRows
        if now // self.interval > before // self.interval:
            log.info("stream %s: %d entities, batch %d", p.name or p.id, now, p.batchId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.id))
        if event.exception:
            self.failed[str(event.id)] = event.exception
            log.error("stream %s: %s", event.id, event.exception.splitlines()[0])


def corpus_so_far(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema("lang string, source string, entity_id string, words string, run string, batch long").parquet(f"{output}/corpus")
