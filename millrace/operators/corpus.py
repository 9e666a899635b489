"""Operators that put entities together into a corpus."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .scan import WIDTH, running_sums


def union_all(sources: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, sources)


def accepted(entities: DataFrame) -> DataFrame:
    return entities.where("error is null")


def quarantine(entities: DataFrame) -> DataFrame:
    return entities.where("error is not null")


def run_stats(entities: DataFrame) -> DataFrame:
    """Entities read and erroneous ones of each language and source."""
    return entities.groupBy("lang", "source").agg(F.count("*").alias("entities_read"), F.count_if(F.col("error").isNotNull()).alias("erroneous"))


#: Words in a part of a set of stop words, on average: a word is looked up among so many, however large the set is.
STOP_PART = 2
#: Characters of stop words that are sent to all tasks; beyond that they meet the entities in a join by language.
STOP_BOUND = 1 << 26


def stop_sets(stopwords: DataFrame) -> DataFrame:
    """(lang, stop) from (lang, word): each language's set, in parts by hash, as many as its words ask for."""
    words = stopwords.where("lang is not null and word is not null").select("lang", "word").distinct()
    sizes = words.groupBy("lang").agg(F.ceil(F.count("*") / STOP_PART).cast("int").alias("parts"))
    parts = words.join(sizes, "lang").groupBy("lang", _part("word", F.col("parts")).alias("part")).agg(F.collect_list("word").alias("words"))
    every = sizes.select("lang", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(parts, ["lang", "part"], "left")
    part = F.struct("part", F.coalesce("words", F.array().cast("array<string>")).alias("words"))
    return every.groupBy("lang").agg(F.sort_array(F.collect_list(part))["words"].alias("stop"))


def _part(word: Column | str, parts: Column) -> Column:
    return F.pmod(F.xxhash64(word), parts).cast("int")


def is_stopword(word: Column, stop: Column) -> Column:
    return F.array_contains(F.get(stop, _part(word, F.size(stop))), word)


def stopped_words(entities: DataFrame, stopwords: dict[str, list[str]] | DataFrame | None = None) -> DataFrame:
    """entities with __words; stop words by language are data, so plans don't grow with them: (lang, word), or words by language."""
    if not isinstance(stopwords, DataFrame):
        pairs = [(lang, word) for lang, some in (stopwords or {}).items() for word in some]
        if not pairs:
            return entities.withColumn("__words", T.text2words(F.col("content")))
        stopwords = entities.sparkSession.createDataFrame(pairs, "lang string, word string")
        small = sum(len(word) for _, word in pairs) < STOP_BOUND
    else:
        small = (stopwords.agg(F.sum(F.length("word"))).first()[0] or 0) < STOP_BOUND
    sets = stop_sets(stopwords)
    joined = entities.join(F.broadcast(sets) if small else sets, "lang", "left")
    return joined.withColumn("__words", T.text2words_but(F.col("content"), is_stopword, F.col("stop"))).drop("stop")


def to_corpus(entities: DataFrame, stopwords: dict[str, list[str]] | DataFrame | None = None) -> DataFrame:
    """Words of the accepted entities; stop words by language, empty texts go."""
    found = stopped_words(accepted(entities), stopwords)
    # a filter on the words would be computed below the projection, all over again; a generator is not moved
    kept = F.filter(F.array("__words"), lambda w: w != "")
    return found.select("lang", "source", "entity_id", F.explode(kept).alias("words"))


def to_contexts(corpus: DataFrame, *keys: str) -> DataFrame:
    """One row per line of a corpus, with its tokens."""
    lines = corpus.select(*keys, F.posexplode(T.contexts(F.col("words"))).alias("line_no", "line"))
    return lines.withColumn("tokens", F.when(F.col("line") == "", F.array().cast("array<string>")).otherwise(F.split("line", " ")))


def without_stopwords(words: DataFrame, stopwords: DataFrame, word: str = "word") -> DataFrame:
    """For long lists of stop words: an anti join, which Spark broadcasts where the list is small."""
    return words.join(stopwords.select(F.col(word).alias("__w")), words[word] == F.col("__w"), "left_anti")


def capped(segments: DataFrame, member: list[str], order: str, text: str, cap: int, width: int = WIDTH) -> DataFrame:
    """Segments of each member until their text has reached the cap; the one that reaches it stays. No task holds a member."""
    size = F.coalesce(F.octet_length(text), F.lit(0))
    return running_sums(segments, member, order, {"__upto": size}, width=width).where(F.col("__upto") - size < cap).drop("__upto")


def write_text(corpus: DataFrame, path: str, mode: str = "overwrite", ordered: bool = False) -> None:
    """One context per line. ordered: by language, source, entity and line, at the price of a range shuffle."""
    lines = to_contexts(corpus, "lang", "source", "entity_id")
    if ordered:
        lines = lines.orderBy("lang", "source", "entity_id", "line_no")
    lines.select(F.col("line").alias("value")).write.mode(mode).text(path)


def quarantined(entities: DataFrame) -> Column:
    """What can't be read, as a line of JSON: where it comes from, its error and the error's text."""
    shown = T.error_text(F.col("error"), F.col("position")).alias("shown")
    return F.to_json(F.struct("lang", "source", "entity_id", "position", "error", "content", shown))


def with_sinks(entities: DataFrame, stopwords: dict[str, list[str]] | None = None) -> DataFrame:
    """(sink, value): the corpus' lines, and those of the quarantine, from one pass over the entities."""
    words = stopped_words(entities, stopwords)
    lines = F.transform(T.contexts(F.col("__words")), lambda x: F.struct(F.lit("corpus").alias("sink"), x.alias("value")))
    bad = F.array(F.struct(F.lit("quarantine").alias("sink"), quarantined(entities).alias("value")))
    return words.select(F.explode(F.when(F.col("error").isNull(), F.coalesce(lines, F.array().cast("array<struct<sink string, value string>>"))).otherwise(bad)).alias("x")).select("x.*")


def write_table(corpus: DataFrame, path: str, mode: str = "overwrite") -> None:
    corpus.write.mode(mode).partitionBy("lang", "source").parquet(path)
