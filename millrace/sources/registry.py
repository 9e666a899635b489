"""The sources by name: how they are read and which markup their texts have."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.markup import unformatted
from ..functions.text import book_text
from .archives import translation_memories
from .files import languages_of, text_files
from .newspaper import newspapers
from .wiki import wiki_pages


@dataclass(frozen=True)
class SourceSpec:
    """A source: reader(spark, path, lang) gives entities; preprocess and markup say how their text is freed of its format.

    path may be a list of paths; lang is null then, as languages follow from paths, unless the reader asks_languages: it
    gets them as a column of path, an array.
    """

    name: str
    reader: Callable[[SparkSession, str | list[str], str | Column | None], DataFrame]
    preprocess: Callable[[Column], Column] | None = None
    markup: str | None = None
    asks_languages: bool = False

    def entities(self, spark: SparkSession, roots: dict[str, list[str]]) -> DataFrame:
        """Entities of all languages from one scan: roots (full addresses) with the languages that lie there."""
        paths = sorted(roots)
        if self.asks_languages:
            return self.reader(spark, paths, languages_of(address(F.col("path")), roots))
        found = self.reader(spark, paths, None)
        return found.withColumn("lang", F.explode(languages_of(F.col("position.path"), roots)))

    def plain(self, entities: DataFrame, strict: bool = False) -> DataFrame:
        """The entities with plain texts; what can't be read gets an error."""
        if self.preprocess is not None:
            entities = _apply(entities, self.preprocess(F.col("content")))
        if self.markup is not None:
            entities = _apply(entities, unformatted(F.col("content"), self.markup, strict))
        return entities


def _apply(entities: DataFrame, result: Column) -> DataFrame:
    new = F.struct(F.lit(schema.STRUCTURE).alias("kind"), F.col("__r.error").alias("message"), F.lit(None).cast("string").alias("lang"))
    out = entities.withColumn("__r", result)
    return out.withColumn("error", F.coalesce("error", F.when(F.col("__r.error").isNotNull(), new))).withColumn("content", F.col("__r.content")).drop("__r")


def address(path: Column) -> Column:
    """A path of this machine as the address that Spark gives its files."""
    return F.when(path.startswith("/"), F.concat(F.lit("file:"), path)).otherwise(path)


REGISTRY: dict[str, SourceSpec] = {}


def register(spec: SourceSpec) -> None:
    REGISTRY[spec.name] = spec


#: In the order in which a language's sources are read.
for _spec in (
    SourceSpec("wikipedia", wiki_pages, markup="mediawiki"),
    SourceSpec("gutenberg", lambda s, p, lang: text_files(s, p, lang, "gutenberg"), preprocess=book_text, markup="markdown"),
    SourceSpec("europeana", newspapers),
    SourceSpec("codecivil", lambda s, p, lang: text_files(s, p, lang, "codecivil", "md"), markup="markdown"),
    SourceSpec("dgt", translation_memories, asks_languages=True),
):
    register(_spec)
