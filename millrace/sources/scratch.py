"""Scratch tables of loops: written where driver and executors both reach them, so that a lost executor loses none."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only where that is unset and all runs in one process, as in tests, a temporary folder."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: scratch tables need a folder that driver and executors share")
        folder = getattr(sc, "_millrace_scratch", None)
        if folder is None:
            folder = sc._millrace_scratch = tempfile.mkdtemp(prefix="millrace-scratch-")
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
