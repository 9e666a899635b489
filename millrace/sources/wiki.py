"""Encyclopedia dumps: XML, compressed or not."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.text import is_redirect
from ..operators.positions import line_numbers
from ..operators.scan import running_sums
from .files import entities, error, position

PAGE = "title string, ns long, id long, revision struct<text: string>, _corrupt_record string"


#: Lines that begin a page, or hold an id: the first one in a page is its own.
MARK = r"<page[\s>]|<page$|<id>"


def page_places(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, id, row, col) of the pages of dumps, from 0; of several pages in one line only the first has a place."""
    marks = line_numbers(spark, path, MARK)
    begins = F.col("line").rlike(r"<page(?:[\s>]|$)")
    numbered = running_sums(marks.withColumn("begins", begins), ["path"], "row", {"nth": F.when(begins, 1).otherwise(0)})
    pages = numbered.where("nth > 0").groupBy("path", "nth").agg(
        F.min_by(F.struct("row", "col"), F.when(F.col("begins"), F.col("row"))).alias("at"),
        F.min_by(F.regexp_extract("line", r"<id>\s*(\d+)", 1), F.when(F.col("line").contains("<id>"), F.col("row"))).alias("id"),
    )
    return pages.where("id <> ''").groupBy("path", F.col("id").cast("long").alias("id")).agg(F.min("at").alias("at")).select("path", "id", "at.row", "at.col")


def wiki_pages(spark: SparkSession, path: str | list[str], lang: str | None, source: str = "wikipedia", places: bool = True) -> DataFrame:
    """Articles as entities, without redirects and empty texts; records that are no XML have an error.

    places: row and column of each page, at the price of a join with the places by id.
    """
    # the newer parser takes the rest of a file for one broken record
    reader = spark.read.format("xml").option("rowTag", "page").option("mode", "PERMISSIVE").option("useLegacyXMLParser", "true")
    pages = reader.schema(PAGE).load(path)
    text = F.col("revision.text")
    broken = F.col("_corrupt_record").isNotNull()
    number = F.coalesce(F.col("id"), F.regexp_extract("_corrupt_record", r"<id>\s*(\d+)", 1).try_cast("long"))
    rows = pages.where(broken | (F.length(text) > 0) & ~is_redirect(text)).select(
        F.col("_metadata.file_path").alias("path"),
        number.alias("id"),
        "title",
        F.when(~broken, text).alias("content"),
        error(schema.XML, "the page is not well-formed", broken).alias("error"),
    )
    if places:
        rows = rows.join(page_places(spark, path), ["path", "id"], "left")
    else:
        rows = rows.withColumns({"row": F.lit(None), "col": F.lit(None)})
    at = F.when(F.col("row").isNull(), position(F.col("path"))).otherwise(position(F.col("path"), F.col("row"), F.col("col")))
    return entities(rows.select(F.concat_ws("#", "path", F.coalesce(F.col("id").cast("string"), "title")).alias("entity_id"), at.alias("position"), "content", "error"), lang, source)
