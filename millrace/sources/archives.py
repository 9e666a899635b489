"""Archives: translation memories in zip files, parallel texts in tar files.

A zip file's members are rows, read in ranges; a tar file is one row. Segments leave in batches.
"""

from __future__ import annotations

import io
import tarfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.encoding import utf16_text
from ..functions.text import BREAK, ISO_639
from .files import binary_files, entities, position
from .zipped import zip_members

SEGMENTS = "path string, asked string, member string, seg_no long, lang string, text string, error_kind string, error string"
COLUMNS = pa.schema([("path", pa.string()), ("asked", pa.string()), ("member", pa.string()), ("seg_no", pa.int64()), ("lang", pa.string()), ("text", pa.string()), ("error_kind", pa.string()), ("error", pa.string())])
#: Segments that leave a task at once, of any number of members.
SEGMENTS_AT_ONCE = 4096
LANG = ("lang", "{http://www.w3.org/XML/1998/namespace}lang")


def segments(text: str, prefix: str) -> Iterator[tuple]:
    """(seg_no, lang, text, error kind, error) of each segment whose language begins with the prefix."""
    n = 0
    # the declaration still names the old encoding
    if text.lstrip().startswith("<?xml"):
        text = text[text.index("?>") + 2 :]
    try:
        for _, unit in ET.iterparse(io.StringIO(text)):
            if unit.tag.rpartition("}")[2] != "tuv":
                continue
            lang = next((unit.get(a) for a in LANG if unit.get(a)), "")
            if lang.startswith(prefix):
                for seg in unit.iter():
                    if seg.tag.rpartition("}")[2] == "seg":
                        yield n, lang, "".join(seg.itertext()), None, None
                        n += 1
            unit.clear()
    except (ET.ParseError, ValueError) as e:
        yield n, None, None, schema.XML, str(e)


def memory_segments(spark: SparkSession, path: str | list[str], lang: str | Column | None, only_tmx: bool = True) -> DataFrame:
    """Segments of all translation memories of folders in a language (ISO 639-3; none: in all; a column: the array of those
    that are asked of a path). asked: that language."""
    if isinstance(lang, str) and lang not in ISO_639:
        raise ValueError(f"no two-letter code for language {lang}")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for row in zip(*batch.columns):  # one member at a time becomes Python's
                file, asked, member, text, kind, error = (x.as_py() for x in row)
                if kind is not None:
                    yield file, asked, member, 0, None, None, kind, error
                else:
                    for s in segments(text, ISO_639[asked].upper() if asked else ""):
                        yield file, asked, member, *s

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = found(batches)
        while some := list(islice(rows, SEGMENTS_AT_ONCE)):
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*some), COLUMNS)], schema=COLUMNS)

    members = zip_members(spark, path, ".tmx" if only_tmx else "").withColumn("u", utf16_text(F.col("data"))).drop("data")
    members = members.withColumn("asked", F.explode(lang) if isinstance(lang, Column) else F.lit(lang).cast("string"))
    # an archive has one error for a language without a code: that of its first member, or of itself
    known = F.col("asked").isNull() | F.col("asked").isin(*ISO_639)
    members = members.where(known | F.coalesce(F.col("nth") == 0, F.lit(True)))
    kind = F.when(~known, schema.LANGUAGE).when(F.col("u.text").isNotNull(), None).when(F.col("error").isNotNull() & F.col("member").isNull(), schema.IO).otherwise(schema.ENCODING)
    message = F.when(known, F.coalesce("error", "u.error")).otherwise(F.concat(F.lit("no two-letter code for language "), "asked"))
    # what is read and what is not leaves in one pass over the archives
    rows = members.select("path", "asked", F.when(known, F.col("member")).alias("member"), F.when(known, F.col("u.text")).alias("text"), kind.alias("error_kind"), message.alias("error"))
    return rows.mapInArrow(run, SEGMENTS)


def translation_memories(spark: SparkSession, path: str | list[str], lang: str | Column, source: str = "dgt", cap: int | None = None) -> DataFrame:
    """One entity per member with text: its segments with context breaks; an error row for what can't be read."""
    rows = memory_segments(spark, path, lang)
    if cap is not None:
        from ..operators.corpus import capped

        rows = capped(rows.where("error is null"), ["path", "asked", "member"], "seg_no", "text", cap).unionByName(rows.where("error is not null"))
    # a member with text and an error has a row for each; one pass over the archives
    segment = F.collect_list(F.when(F.col("error").isNull(), F.struct("seg_no", "text")))
    failed = F.struct(F.col("error_kind").alias("kind"), F.col("error").alias("message"), F.when(F.col("error_kind") == schema.LANGUAGE, F.col("asked")).alias("lang"))
    members = rows.groupBy("path", "asked", "member").agg(F.array_sort(segment).alias("s"), F.collect_list(F.when(F.col("error").isNotNull(), failed)).alias("errors"))
    text = F.array_join(F.transform("s", lambda s: F.concat(s["text"], F.lit(f" {BREAK} "))), "")
    members = members.withColumn("text", text).withColumn("text", F.when(F.col("text").endswith("\n"), F.col("text")).otherwise(F.concat("text", F.lit("\n"))))
    good = F.when(F.size("s") > 0, F.array(F.struct(F.col("text").alias("content"), F.lit(None).cast(schema.ERROR).alias("error")))).otherwise(F.array())
    bad = F.transform("errors", lambda e: F.struct(F.lit(None).cast("string").alias("content"), e.cast(schema.ERROR).alias("error")))
    out = members.select("path", "asked", "member", F.explode(F.concat(good, bad)).alias("x"))
    return entities(out.select(F.concat_ws("#", "path", "member").alias("entity_id"), position(F.col("path")).alias("position"), "x.content", "x.error", "asked"), F.col("asked"), source)


def parallel_texts(spark: SparkSession, path: str, lang: str) -> DataFrame:
    """(path, text, error): the first member of each tar file whose name ends in the language; an error for a file or a
    member that can't be read."""

    def read(data: bytes) -> tuple[str | None, str | None] | None:
        try:
            with tarfile.open(fileobj=io.BytesIO(data)) as archive:
                member = next((m for m in archive if m.isfile() and m.name.endswith(f".{lang}")), None)
                return member and (archive.extractfile(member).read().decode("utf-8"), None)
        except (tarfile.TarError, OSError, EOFError, ValueError) as e:
            return None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, data in zip(batch["path"], batch["content"]):
                if found := read(bytes(data)):
                    yield pd.DataFrame([(file, *found)], columns=["path", "text", "error"], dtype=object)

    return binary_files(spark, path, "tgz").select("path", "content").mapInPandas(run, "path string, text string, error string")
