"""Tables in Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows under which a table is read as it is.
FEW = 2000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """df, dealt to all cores if it is a small scan whose row groups leave some without work: a Parquet file is split only
    between these. A scan of more splits than that is left alone without a look."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.rdd().getNumPartitions() > 2 * cores:
        return df
    rows = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    if sum(rows) < FEW or len(rows) >= cores:
        return df
    # shuffled rows come in any order; by the first column, an id, a task that runs again finds them as it did before
    return df.repartition(cores).sortWithinPartitions(df.columns[0])
