"""Where texts lie in a file: rows and columns from sums over its parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scan import WIDTH, running_sums


def text_positions(parts: DataFrame, keys: list[str], order: str, text: str, width: int = WIDTH) -> DataFrame:
    """parts with row and col (from 0, in characters) of the beginning of each text in the concatenation of its file.

    keys: what tells files apart; order: an integer, one for each text of a file. Null texts are empty. Rows are line
    ends before a text. A row's column is what the text with the row's first character has of it, and what the texts
    have that begin in the same row: sums both, so no task holds a file, but all texts that begin in one row share a
    group, which again is summed by blocks.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    ends = F.length(value) - F.length(F.replace(value, F.lit("\n"), F.lit("")))
    rest = F.length(F.substring_index(value, "\n", -1))
    known = parts.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col(order).alias("__o"), ends.cast("long").alias("__ends"), rest.cast("long").alias("__rest"))
    names = [f"__k{i}" for i in range(len(keys))]
    rows = running_sums(known, names, "__o", {"__through": F.col("__ends")}, width=width).withColumn("__row", F.col("__through") - F.col("__ends"))
    # all texts of a row but the last are within it, so their rests are their lengths
    within = running_sums(rows, [*names, "__row"], "__o", {"__upto": F.col("__rest")}, width=width)
    key = F.struct(*names, "__row") if names else F.struct("__row")
    begun = rows.where("__ends > 0").select(F.struct(*names, F.col("__through").alias("__row")).alias("__key"), F.col("__rest").alias("__before"))
    placed = within.withColumn("__key", key).join(begun, "__key", "left")
    found = placed.select(F.struct(*names, "__o").alias("__at"), F.col("__row").alias("row"), (F.col("__upto") - F.col("__rest") + F.coalesce("__before", F.lit(0))).alias("col"))
    here = parts.withColumn("__at", F.struct(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col(order).alias("__o")))
    return here.drop("row", "col").join(found, "__at").drop("__at")


def line_numbers(spark, path: str, pattern: str) -> DataFrame:
    """(path, row, col, line) of the lines of text files that match: rows from the lines of the blocks before, and those before
    in the same block; col: where the match begins. Files are split, and only matching lines are kept."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"), "value")
    blocks = lines.groupBy("path", "block").agg(F.count("*").alias("lines"), F.min("nth").alias("first"))
    before = running_sums(blocks, ["path"], "block", {"upto": F.col("lines")}, width=1 << 40).select("path", "block", "first", (F.col("upto") - F.col("lines")).alias("before"))
    hits = lines.where(F.col("value").rlike(pattern))
    at = F.length(F.col("value")) - F.length(F.regexp_replace("value", rf"(?s)\A.*?(?={pattern})", ""))
    return hits.join(before, ["path", "block"]).select("path", (F.col("before") + F.col("nth") - F.col("first")).alias("row"), at.cast("long").alias("col"), F.col("value").alias("line"))
