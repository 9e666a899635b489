"""Following links: the pages that can be reached from some others, and how far away they are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import links, resolved
from ..sources.scratch import delete, new_path, written


def link_graph(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst), each once: pages and the addresses that their anchors give, both without fragments."""
    here = resolved(F.col(url), F.lit(""))
    found = pages.select(here.alias("src"), F.explode(links(F.col(html))).alias("link"))
    return found.select("src", resolved(F.col("src"), F.col("link")).alias("dst")).where("src is not null and dst is not null").distinct()


def reachable(graph: DataFrame, seeds: DataFrame, follow: Column | None = None, most: int | None = None) -> DataFrame:
    """(url, depth): seeds (url) and what links (src, dst) lead to from there, by the least number of links.

    follow: which addresses (column dst) are followed at all; most: how many links at most. Rounds are as many as the
    farthest page is away. Each follows the links of the pages that the last one found, and of no others; what was found
    before is only looked up. Neither pages nor links pass through the driver.
    """
    spark = graph.sparkSession
    edges_path, seen_path = new_path(spark, "links"), new_path(spark, "reached")
    edges = written(graph.where(follow) if follow is not None else graph, edges_path)
    frontier = written(seeds.select("url").where("url is not null").distinct(), f"{seen_path}/depth=0")
    depth = 0
    while not frontier.isEmpty() and depth != most:
        depth += 1
        found = frontier.join(edges, frontier["url"] == edges["src"]).select(F.col("dst").alias("url")).distinct()
        seen = spark.read.schema("url string, depth int").parquet(seen_path)
        frontier = written(found.join(seen, "url", "left_anti"), f"{seen_path}/depth={depth}")
    delete(spark, edges_path)
    return spark.read.schema("url string, depth int").parquet(seen_path)
