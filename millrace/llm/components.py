"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least of itself and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (u, v) that is not the least one that it reaches itself: component is.

    A hub's edges are spread by skewed-join splitting and its minimum is summed up by task first; each round is
    written, and the round before it deleted. The rounds grow with the logarithm of the longest chain.
    """
    now = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
    sign = _sign(now)
    while sign[0]:
        last, before = sign, now
        now = written(small_star(large_star(before)), "stars")
        drop_written(before)
        sign = _sign(now)
        if last == sign:
            break
    out = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    out._millrace_path = now._millrace_path
    return out
