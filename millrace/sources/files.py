"""Text files, one entity each."""

from __future__ import annotations

import fnmatch
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from .folders import files_of


def position(path: Column, row: Column | None = None, col: Column | None = None) -> Column:
    kind = "directory" if row is None else "file"
    row, col = (F.lit(None) if x is None else x for x in (row, col))
    return F.struct(F.lit(kind).alias("kind"), path.alias("path"), row.cast("long").alias("row"), col.cast("long").alias("col"))


def error(kind: str, message: Column | str, when: Column) -> Column:
    message = F.lit(message) if isinstance(message, str) else message
    return F.when(when, F.struct(F.lit(kind).alias("kind"), message.alias("message"), F.lit(None).cast("string").alias("lang")))


def entities(rows: DataFrame, lang: str | Column | None, source: str) -> DataFrame:
    """rows (entity_id, position, content, error) with their language and source."""
    return rows.select((lang if isinstance(lang, Column) else F.lit(lang).cast("string")).alias("lang"), F.lit(source).alias("source"), "entity_id", "position", "content", "error")


def binary_files(spark: SparkSession, path: str | list[str], extension: str, recursive: bool = False, stream: bool = False, exclude: str | None = None) -> DataFrame:
    """Files with this extension, its case as given; a file that is called like the extension alone has none.

    exclude: a pattern of paths to leave out, such as `*/.git/*`.
    """
    files = None if stream else files_of(spark, [path] if isinstance(path, str) else path, extension, recursive)
    if files is None:
        reader = spark.readStream.schema("path string, modificationTime timestamp, length long, content binary") if stream else spark.read
        files = reader.format("binaryFile").option("pathGlobFilter", f"*.{extension}").option("recursiveFileLookup", str(recursive).lower()).load(path)
    files = files.where(~F.col("path").endswith(f"/.{extension}"))
    return files if exclude is None else files.where(~F.col("path").rlike("^" + fnmatch.translate(exclude)))


def text_files(spark: SparkSession, path: str | list[str], lang: str | None, source: str, extension: str = "txt", recursive: bool = False, stream: bool = False, exclude: str | None = None) -> DataFrame:
    """Whole files as entities; a file that is not UTF-8 has an error."""
    files = binary_files(spark, path, extension, recursive, stream, exclude)
    text = F.try_validate_utf8(F.col("content").cast("string"))
    rows = files.select(F.col("path").alias("entity_id"), position(F.col("path")).alias("position"), text.alias("content"))
    return entities(rows.withColumn("error", error(schema.IO, "the file is not UTF-8", F.col("content").isNull())), lang, source)


def languages_of(path: Column, roots: dict[str, list[str]]) -> Column:
    """The languages whose sources lie in the longest of the roots (full addresses of files or folders) that hold a path.

    The roots are one literal and the path's own folders are looked up in it, so plans don't grow with them.
    """
    table = F.from_json(F.lit(json.dumps(roots)), "map<string, array<string>>")
    parts = F.split(path, "/", -1)
    folders = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    found = F.filter(F.transform(folders, lambda f: F.try_element_at(table, f)), lambda x: x.isNotNull())
    return F.get(found, F.lit(0))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, lnum, line) of index files, numbered from 0."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return whole.select("path", F.posexplode(F.split("value", "\r?\n", -1)).alias("lnum", "line"))
