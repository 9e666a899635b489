"""Index files of a book collection as tables, and what follows from them.

Lines come as (path, lnum, line). An index is one file, so windows are partitioned by path and ordered by line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ISO_639

#: The marks and patterns of the two index formats.
TABLE_BEGIN, TABLE_END, LIST_END = "TITLE and AUTHOR", "ETEXT NO.", "<==End of GUTINDEX.ALL"
LANGUAGE = r"(?U)\[Language: (\w+?)\]"
TITLE = r"^(.*?)(?:[\s]+|\)|\])(\d+)[A-Z]?$"
FILE = r"^(\d+)(-[0-9]|-[a-z])?(\.[a-z]+)$"
DEFAULT_LANGUAGE = "English"


def _clean(lines: DataFrame) -> DataFrame:
    return lines.select("path", "lnum", F.regexp_replace(F.replace("line", F.lit("\xa0"), F.lit(" ")), r"\s+\z", "").alias("line"))


def content_lines(lines: DataFrame) -> DataFrame:
    """Lines after the table's heading and before its end, of each path."""
    every = Window.partitionBy("path")
    heading = F.col("line").startswith(TABLE_BEGIN) & F.col("line").endswith(TABLE_END)
    marked = _clean(lines).withColumn("begin", F.min(F.when(heading, F.col("lnum"))).over(every))
    end = F.min(F.when(F.col("line").startswith(LIST_END) & (F.col("lnum") >= F.col("begin")), F.col("lnum"))).over(every)
    return marked.withColumn("end", end).where("lnum >= begin and (end is null or lnum < end)").drop("begin", "end")


def book_catalog(lines: DataFrame) -> DataFrame:
    """(book_no, lang, title): a title line, and the language of the attribute lines after it.

    A title that is followed by another without a language between is in the default language; one before a blank line or
    the end is lost. The last entry of a number wins.
    """
    inside = content_lines(lines)
    so_far = Window.partitionBy("path").orderBy("lnum").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blank = F.trim("line") == ""
    attribute = F.col("line").rlike(r"^[\s\[]")
    rows = inside.withColumn("grp", F.sum(blank.cast("int")).over(so_far)).where(~blank)
    rows = rows.withColumn("lang", F.when(attribute, F.nullif(F.regexp_extract("line", LANGUAGE, 1), F.lit("")))).withColumn("is_title", ~attribute & F.col("line").rlike(TITLE))
    rows = rows.where("is_title or lang is not null")
    after = Window.partitionBy("path", "grp").orderBy("lnum")
    rows = rows.withColumn("next_no", F.lead("lnum").over(after)).withColumn("next_lang", F.lead("lang").over(after))
    books = rows.where("is_title and next_no is not null").select(
        F.regexp_extract("line", TITLE, 2).cast("long").alias("book_no"),
        F.regexp_extract("line", TITLE, 1).alias("title"),
        F.coalesce("next_lang", F.lit(DEFAULT_LANGUAGE)).alias("lang"),
        "path", "next_no",
    ).where("title <> ''")
    last = books.groupBy("book_no").agg(F.max_by(F.struct("lang", "title"), F.struct("path", "next_no")).alias("b"))
    return last.select("book_no", "b.lang", "b.title")


def file_catalog(lines: DataFrame) -> DataFrame:
    """(book_no, path) from a recursive listing: the first file of a number, or the last whose name ends in -8."""
    clean = lines.select("path", "lnum", F.regexp_replace("line", r"\s+\z", "").alias("line"))
    so_far = Window.partitionBy("path").orderBy("lnum").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_dir = F.col("line").startswith("./") & F.col("line").endswith(":")
    folder = F.when(is_dir, F.expr("substring(line, 3, length(line) - 3)"))
    rows = clean.withColumn("grp", F.sum((F.col("line") == "").cast("int")).over(so_far)).withColumn("folder", folder)
    in_group = Window.partitionBy("path", "grp").orderBy("lnum").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("old", F.sum(F.coalesce(F.col("folder").endswith("old"), F.lit(False)).cast("int")).over(in_group)).where("old = 0 and line <> ''")
    rows = rows.withColumn("dir", F.last("folder", ignorenulls=True).over(so_far))
    found = F.regexp_extract("line", FILE, 1)
    files = rows.where(F.col("folder").isNull() & F.col("line").endswith(".txt") & (found != "")).select(
        found.cast("long").alias("book_no"), F.concat_ws("/", "dir", "line").alias("file"), "dir",
        F.regexp_extract("line", FILE, 2).alias("suffix"), F.struct("path", "lnum").alias("at"),
    )
    best = files.groupBy("book_no").agg(
        F.max_by("file", F.when(F.col("suffix") == "-8", F.col("at"))).alias("utf8"),
        F.min_by("file", F.when(F.col("dir").isNotNull(), F.col("at"))).alias("first"),
    )
    return best.select("book_no", F.coalesce("utf8", "first").alias("path")).where("path is not null")


def to_fetch(books: DataFrame, files: DataFrame, lang: str | None = None, present: DataFrame | None = None) -> DataFrame:
    """Books of a language (none: of all) with their paths, without those that are present (name) already, by number."""
    out = (books if lang is None else books.where(F.col("lang") == lang)).join(files, "book_no").withColumn("name", F.element_at(F.split("path", "/"), -1))
    if present is not None:
        out = out.join(present.select("name"), "name", "left_anti")
    return out.orderBy("book_no")


def availability(wanted: DataFrame, known: DataFrame, key: str, *by: str) -> DataFrame:
    """How many of the wanted rows are known, and how many are not."""
    hit = known.select(key).distinct().withColumn("__hit", F.lit(True))
    return wanted.join(hit, key, "left").groupBy(*by).agg(F.count_if(F.col("__hit").isNotNull()).alias("found"), F.count_if(F.col("__hit").isNull()).alias("missed"))


def stale(files: DataFrame, days: int = 2) -> DataFrame:
    """Rows (path, modificationTime) that are older than so many days."""
    return files.where(F.col("modificationTime") < F.current_timestamp() - F.make_dt_interval(F.lit(days)))


def language_of_archives(links: DataFrame) -> DataFrame:
    """(lang) of archive links like xx-yy.tgz, and en, which all of them share."""
    found = links.select(F.regexp_extract("link", r"(\w{2})-\w{2}\.tgz", 1).alias("lang")).where("lang <> ''").distinct()
    return found.unionByName(links.sparkSession.sql("select 'en' as lang")).distinct()


def archive_link(links: DataFrame, lang: str) -> DataFrame:
    """(link): the first (pos, link) whose archive has the language; for en the last; an error if there is none."""
    some = links.where(F.col("link").rlike(r"\w{2}-\w{2}\.tgz") if lang == "en" else F.col("link").contains(f"{lang}-"))
    pick = F.max_by if lang == "en" else F.min_by
    return some.agg(pick("link", "pos").alias("link")).select(F.coalesce("link", F.raise_error(F.lit(f"no archive for language {lang}"))).alias("link"))


def archive_links(links: DataFrame) -> DataFrame:
    """(lang, link): archive_link of every language of language_of_archives, in one pass over the links (pos, link)."""
    archive = F.col("link").rlike(r"\w{2}-\w{2}\.tgz")
    # a link counts for each pair of letters before a hyphen in it, and an archive for English besides
    pairs = F.array_distinct(F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.length("link") - 2, F.lit(1))), lambda i: F.substring(F.col("link"), i, F.lit(3)).rlike(r"\w\w-")), lambda i: F.substring(F.col("link"), i, F.lit(2))))
    named = F.when(archive, F.regexp_extract("link", r"(\w{2})-\w{2}\.tgz", 1))
    rows = links.withColumn("named", named).select("pos", "link", "named", F.explode(F.array_union(F.filter(pairs, lambda p: p != "en"), F.when(archive, F.array(F.lit("en"))).otherwise(F.array().cast("array<string>")))).alias("lang"))
    best = rows.groupBy("lang").agg(F.min_by("link", "pos").alias("first"), F.max_by("link", "pos").alias("last"), F.bool_or((F.col("named") == F.col("lang")) | (F.col("lang") == "en")).alias("asked"))
    return best.where("asked").select("lang", F.when(F.col("lang") == "en", F.col("last")).otherwise(F.col("first")).alias("link"))


def zip_links(links: DataFrame) -> DataFrame:
    """Links to zip files, whatever the case of their ending."""
    return links.where(F.lower("link").endswith(".zip"))


def language_folders(links: DataFrame, lang: str | None = None) -> DataFrame:
    """Links to folders that are called by a three-letter language in capitals; lang: only that one, whatever its case.

    An error if a language is asked for and there is none.
    """
    found = links.where(F.col("link").rlike("^[A-Z]{3}/?$"))
    if lang is None:
        return found
    hit = found.where(F.lower(F.regexp_replace("link", "/$", "")) == lang.lower())
    missing = F.raise_error(F.lit(f"no folder for language {lang}"))
    one = hit.agg(F.min("link").alias("link"))
    return one.select(F.coalesce("link", missing).alias("link"))


def newest_dump(lang: str, base: str = "dumps") -> str:
    """Where the newest dump of an encyclopedia lies under a folder of dumps, by ISO 639-3 code, which
    stands for itself where there is no shorter one."""
    code = ISO_639.get(lang, lang)
    return f"{base}/{code}wiki/latest/{code}wiki-latest-pages-articles.xml.bz2"
