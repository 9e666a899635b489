"""What the training-data operators share: inputs, scratch tables and chunked Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table  # noqa: F401

#: Bytes of text that one vectorised step holds; its arrays take some forty times as much.
CHUNK_BYTES = 1 << 18


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; only where that is unset and all run in one
    process, as in tests, a temporary one. A cluster must name its folder."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: scratch tables need a folder that driver and executors share")
        folder = getattr(sc, "_millrace_shared", None)
        if folder is None:
            folder = sc._millrace_shared = tempfile.mkdtemp(prefix="millrace-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage, and a lost executor loses none of it.

    The folder belongs to the run that made it; deployments expire it as they expire checkpoints.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._millrace_path = path
    return out


def drop_written(*tables: DataFrame) -> None:
    """Deletes scratch tables that nothing will read again."""
    for df in tables:
        path = getattr(df, "_millrace_path", None)
        if path:
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def checkpointed(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def freed(sc) -> None:
    """Lets Spark's cleaner delete the shuffle files of frames that nothing holds any more; else they stay until the
    driver happens to collect its garbage."""
    gc.collect()
    sc._jvm.System.gc()


def released() -> None:
    """Gives memory that a finished step has freed back to the system, so that waiting Python workers hold little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def chunks(batches: Iterator[pa.RecordBatch], column: str, budget: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with at most budget bytes of text, or one row, and their texts; null reads as empty."""
    for batch in batches:
        texts = [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]
        begin = size = 0
        for i, text in enumerate(texts):
            if i > begin and size + len(text) > budget:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, size = i, 0
            size += len(text)
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]
    released()


def crc32_of_id(column: str = "doc_id"):
    """crc32 of the id's decimal text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
