import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.scan import running_sums


@pytest.mark.parametrize("width, levels", [(1, 1), (3, 2), (4, 0), (1 << 12, 2)])
def test_running_sums(spark, width, levels):
    r = random.Random(width)
    rows = [(r.choice([None, "a", "b", "c"]), r.choice([None, *range(-20, 40)]), k, r.choice([None, 1, 5, 9])) for k in range(400)]
    df = spark.createDataFrame(rows, "k string, o long, t int, v long")
    got = running_sums(df, ["k"], "o", {"s": F.col("v"), "n": F.lit(1)}, ["t"], width, levels).collect()
    want, seen = {}, {}
    for k, o, t, v in sorted(rows, key=lambda x: (x[1] is not None, x[1] or 0, x[2])):
        s, n = seen.get(k, (0, 0))
        seen[k] = want[t] = s + (v or 0), n + 1
    assert {x.t: (x.s, x.n) for x in got} == want and got[0].__fields__ == ["k", "o", "t", "v", "s", "n"]


def test_no_keys_and_no_rows(spark):
    df = spark.range(10).withColumn("s", F.lit("old"))
    assert [r.s for r in running_sums(df, [], "id", {"s": F.col("id")}, width=2).orderBy("id").collect()] == [0, 1, 3, 6, 10, 15, 21, 28, 36, 45]
    assert running_sums(df.where("id < 0"), [], "id", {"s": F.col("id")}).count() == 0


def test_no_task_holds_a_group(spark):
    """One group of all rows is dealt to blocks: its widest window partition has a block's rows."""
    df = spark.range(20_000).select(F.when(F.col("id") >= 0, "one").alias("k"), F.col("id").alias("o"))
    out = running_sums(df, ["k"], "o", {"n": F.lit(1)}, width=500)
    assert out.where("n <> o + 1").count() == 0
    # every window but the last, which has a row for some of the blocks, is dealt by block
    windows = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
    assert len(windows) == 3 and sum("__block" in x.rsplit("[", 2)[1] for x in windows) == 2
    assert out.groupBy(F.spark_partition_id()).count().count() > 1
