"""Running sums in groups of any size: sums of blocks, a scan of the blocks, and carries joined back.

No task holds a group: its rows are dealt in blocks of the order's values, each block is scanned by itself, and the sums
of the blocks before it, which are scanned the same way, are added. Spark's own window keeps a group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values of the order in one block, and scans of blocks above the rows'; the last one takes a group's blocks at once.
WIDTH, LEVELS = 1 << 12, 2


def running_sums(df: DataFrame, keys: list[str], order: str, sums: dict[str, Column], ties: list[str] = (), width: int = WIDTH, levels: int = LEVELS) -> DataFrame:
    """df with the sums, each over the rows of its group up to and with it, by an integer order, null first.

    ties: further columns that order rows of one value. Rows of equal value share a block. Null keys are a group, null
    values count nothing; columns that are called like a sum are replaced.
    """
    key = F.struct(*(F.col(k) for k in keys)) if keys else F.struct(F.lit(0).alias("all"))
    # equality of structs holds for null fields too, so one plain equi-join finds every group's carry
    dealt = df.withColumns({"__key": key, "__block": F.coalesce(F.expr(f"(`{order}` - pmod(`{order}`, {width})) div {width}"), F.lit(-(1 << 62)))})
    named = {f"__sum{levels}_{i}": F.coalesce(value, F.lit(0)) for i, value in enumerate(sums.values())}
    by = [F.col(order).asc_nulls_first(), *ties]
    if levels == 0:
        upto = Window.partitionBy("__key").orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return dealt.withColumns({name: F.sum(value).over(upto) for name, value in zip(sums, named.values())}).drop("__key", "__block")
    upto = Window.partitionBy("__key", "__block").orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = dealt.withColumns({name: F.sum(value).over(upto) for name, value in named.items()})
    of_block = dealt.select("__key", "__block", *(value.alias(name) for name, value in named.items())).groupBy("__key", "__block").agg(*(F.sum(n).alias(n) for n in named), F.lit(1).alias("__one"))
    of_block = of_block.select(F.col("__key").alias("k"), F.col("__block").alias("b"), *named, "__one")
    through = running_sums(of_block, ["k"], "b", {**{f"__upto{levels}_{i}": F.col(n) for i, n in enumerate(named)}, "__nth": F.col("__one")}, width=width, levels=levels - 1)
    # a group's first block carries nothing, and most groups have no other
    carries = through.where("__nth > 1").select(F.col("k").alias("__key"), F.col("b").alias("__block"), *((F.col(f"__upto{levels}_{i}") - F.col(n)).alias(f"__carry{levels}_{i}") for i, n in enumerate(named)))
    out = scanned.join(carries, ["__key", "__block"], "left")
    total = {name: F.col(f"__sum{levels}_{i}") + F.coalesce(F.col(f"__carry{levels}_{i}"), F.lit(0)) for i, name in enumerate(sums)}
    return out.select(*(F.col(c) for c in df.columns if c not in sums), *(value.alias(name) for name, value in total.items()))
