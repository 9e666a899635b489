"""Digitised newspapers: a JSON object for each file, its pages in an array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from .files import binary_files, entities, error, position


def page_text(data: Column) -> Column:
    """The items of contentAsText, joined without anything between."""
    return F.array_join(F.try_variant_get(F.try_parse_json(data), "$.contentAsText", "array<string>"), "")


def newspapers(spark: SparkSession, path: str | list[str], lang: str | None, source: str = "europeana", stream: bool = False) -> DataFrame:
    files = binary_files(spark, path, "json", stream=stream)
    data = F.try_validate_utf8(F.col("content").cast("string"))
    rows = files.select(F.col("path").alias("entity_id"), position(F.col("path")).alias("position"), data.alias("data"))
    parsed = F.try_parse_json("data")
    rows = rows.withColumn("content", page_text(F.col("data"))).withColumn(
        "error",
        F.coalesce(
            error(schema.IO, "the file is not UTF-8", F.col("data").isNull()),
            error(schema.JSON, "the file is not JSON", parsed.isNull()),
            error(schema.STRUCTURE, "expected an object with an array contentAsText", F.col("content").isNull()),
        ),
    )
    return entities(rows, lang, source)
