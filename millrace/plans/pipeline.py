"""From configured sources to a corpus."""

from __future__ import annotations

import fnmatch
import logging
import re
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.corpus import quarantine, quarantined, run_stats, to_corpus, union_all, with_sinks, write_text
from ..sources.folders import full_address
from ..sources.registry import REGISTRY
from .config import ConfigError, LanguageConfig

log = logging.getLogger("millrace")


GLOB = re.compile(r"[*?\[{]")


def entities(spark: SparkSession, config: dict[str, LanguageConfig], strict: bool = False) -> DataFrame:
    """Entities of all languages and sources with plain texts: one scan for each source that is configured, however many
    languages have it. Patterns of paths have a scan of their own."""
    roots: dict[str, dict[str, list[str]]] = {}
    found = []
    for lang, given in config.items():
        log.info("%s: %s", lang, given.active())
        for name, path in given.sources.items():
            if GLOB.search(path):
                found.append(REGISTRY[name].plain(left_in(REGISTRY[name].reader(spark, path, lang), name, {lang: given}), strict))
            else:
                roots.setdefault(name, {}).setdefault(full_address(spark, path), []).append(lang)
    found += [REGISTRY[name].plain(left_in(REGISTRY[name].entities(spark, some), name, config), strict) for name, some in roots.items()]
    if not found:
        raise ConfigError("no source is configured", 2)
    return union_all(found)


def left_in(entities: DataFrame, name: str, config: dict[str, LanguageConfig]) -> DataFrame:
    """Entities of a source without those whose path a pattern of their language excludes."""
    out = [(lang, fnmatch.translate(p)) for lang, given in config.items() for p in given.excluded.get(name, [])]
    if not out:
        return entities
    path = F.col("position.path")
    return entities.where(~reduce(Column.__or__, (F.coalesce((F.col("lang") == lang) & path.rlike(f"^{pattern}"), F.lit(False)) for lang, pattern in out)))


def corpus(spark: SparkSession, config: dict[str, LanguageConfig], strict: bool = False) -> DataFrame:
    return to_corpus(entities(spark, config, strict), {lang: c.stopwords for lang, c in config.items() if c.stopwords})


def is_writable(spark: SparkSession, output: str) -> bool:
    """Whether a folder can be made at this path, or written where there is one: tried with an empty file beside it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(output)
    probe = spark._jvm.org.apache.hadoop.fs.Path(f"{output.rstrip('/')}.probe-{uuid.uuid4().hex}")
    try:
        files = target.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(target) and not files.getFileStatus(target).isDirectory():
            return False
        files.create(probe).close()
        files.delete(probe, False)
    except Py4JJavaError:
        return False
    return True


class AuditError(Exception):
    """What was written doesn't add up to what was read."""


def _moved(spark: SparkSession, source: str, target: str) -> None:
    """A written folder takes the place of another; an empty one where nothing was written."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(path(target), True)
    if not files.exists(path(source)):
        files.mkdirs(path(target))
    elif not files.rename(path(source), path(target)):
        raise AuditError(f"can't move what was written to {target}")


def build(spark: SparkSession, config: dict[str, LanguageConfig], output: str, strict: bool = False, ordered: bool = False, bad: str | None = None) -> DataFrame:
    """Writes the corpus as text lines to output, and what can't be read as JSON lines to bad (output.quarantine); the
    counts of each language and source that has entities.

    One pass: lines of both kinds are written to one folder by their sink, and its parts moved to their places. Counts
    are taken while that is written, in its last stage, whose tasks count once, and held against the quarantine's lines.
    ordered: not so, as a range shuffle reads the sources again to sample its bounds, and so do tasks that are repeated
    before it; corpus, quarantine and counts are then taken apart.
    """
    every = entities(spark, config, strict)
    stopwords = {lang: c.stopwords for lang, c in config.items() if c.stopwords}
    bad = bad or f"{output.rstrip('/')}.quarantine"
    if ordered:
        write_text(to_corpus(every, stopwords), output, ordered=True)
        quarantine(every).select(quarantined(every).alias("value")).write.mode("overwrite").text(bad)
        counts = run_stats(every)
    else:
        keys = [(lang, name) for lang, given in config.items() for name in given.sources]
        taken = []
        for k, (lang, name) in enumerate(keys):
            here = (F.col("lang") == lang) & (F.col("source") == name)
            taken += [F.count_if(here).alias(f"read_{k}"), F.count_if(here & F.col("error").isNotNull()).alias(f"failed_{k}")]
        seen = Observation()
        staging = f"{output.rstrip('/')}.staging-{uuid.uuid4().hex}"
        # two files are open at once instead of a sort by sink, which would not keep the lines' order
        was = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "4")
        try:
            with_sinks(every.observe(seen, *taken), stopwords).write.partitionBy("sink").text(staging)
        finally:
            spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", was)
        _moved(spark, f"{staging}/sink=corpus", output)
        _moved(spark, f"{staging}/sink=quarantine", bad)
        path = spark._jvm.org.apache.hadoop.fs.Path(staging)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        found = seen.get
        rows = [(*key, found.get(f"read_{k}", 0), found.get(f"failed_{k}", 0)) for k, key in enumerate(keys)]
        counts = spark.createDataFrame([r for r in rows if r[2]], "lang string, source string, entities_read long, erroneous long")
    failed = counts.agg(F.coalesce(F.sum("erroneous"), F.lit(0))).first()[0]
    kept = spark.read.schema("value string").text(bad).count()
    if failed != kept:
        raise AuditError(f"{failed} entities can't be read, {kept} are in {bad}")
    return counts
