"""Files of folders as rows: tasks list the folders and read the files, so that the driver holds no list of them, however
many there are. Spark's own reader keeps a status and a part of a plan for each file in the driver.

Which files count is as Spark has it: hidden ones don't, links do. Paths are those that Arrow opens, as in zipped.py.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache
from math import ceil

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .zipped import opened

#: Files, and bytes, that one task reads; files and bytes that leave it at once.
FILES, BYTES, FILES_AT_ONCE, AT_ONCE = 1 << 12, 128 << 20, 1 << 10, 4 << 20
GLOB = re.compile(r"[*?\[{\\]")
FOUND = pa.schema([("root", pa.string()), ("name", pa.binary()), ("modified", pa.int64())])
READ = pa.schema([("path", pa.string()), ("modified", pa.int64()), ("content", pa.binary())])


def full_address(spark: SparkSession, path: str) -> str:
    """A path with its scheme, as files are called that are read from it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def is_hidden(name: bytes) -> bool:
    """Whether Spark's readers pass over a name."""
    return name.startswith(b"_") and b"=" not in name or name.startswith(b".") or name.endswith(b"._COPYING_")


def below(root: str) -> Iterator[tuple[bytes, int, int]]:
    """(name within the root, bytes, modified in ms) of the files of a folder and of those in it, one by one; of a file its
    own, with no name. Another store than this machine's folders gives its list at once, to a task."""
    files, inner = opened(root)
    at = files.get_file_info(inner)
    if at.is_file:
        if not is_hidden(os.fsencode(at.base_name)):
            yield b"", at.size, (at.mtime_ns or 0) // 10**6
    elif isinstance(files, fs.LocalFileSystem):
        folders = [b""]
        while folders:
            folder = folders.pop()
            with os.scandir(os.path.join(os.fsencode(inner), folder)) as found:
                for x in found:
                    if is_hidden(x.name):
                        continue
                    if x.is_dir():
                        folders.append(os.path.join(folder, x.name))
                    elif x.is_file():
                        yield os.path.join(folder, x.name), (s := x.stat()).st_size, s.st_mtime_ns // 10**6
    else:
        for x in files.get_file_info(fs.FileSelector(inner, recursive=True)):
            name = x.path[len(inner.rstrip("/")) + 1 :].encode()
            if x.is_file and not any(map(is_hidden, name.split(b"/"))):
                yield name, x.size, (x.mtime_ns or 0) // 10**6


def is_asked(root: str, name: bytes, ending: bytes, recursive: bool) -> bool:
    return (name or os.fsencode(root)).endswith(ending) and (recursive or b"/" not in name)


def opens(root: str) -> bool:
    """Whether Arrow finds a path."""
    try:
        files, inner = opened(root)
        return files.get_file_info(inner).type in (fs.FileType.File, fs.FileType.Directory)
    except (pa.ArrowException, OSError, ValueError):
        return False


def files_of(spark: SparkSession, paths: list[str], extension: str, recursive: bool = False) -> DataFrame | None:
    """(path, modificationTime, length, content) of the files with this extension in folders, or of such files themselves.

    None where only Spark's own reader does: for patterns, paths that Arrow doesn't open, and folders of partitions (a=b).
    The folders are listed twice: to tell how many tasks are needed, and to read their files.
    """
    if any(map(GLOB.search, paths)):
        return None
    roots = [full_address(spark, p) for p in paths]
    if not roots or not all(map(opens, roots)):
        return None
    ending = os.fsencode(f".{extension}")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = size = dealt = 0
        for batch in batches:
            for root in batch.column(0).to_pylist():
                for name, length, _ in below(root):
                    dealt += not recursive and b"=" in os.path.dirname(name)
                    if is_asked(root, name, ending, recursive):
                        files, size = files + 1, size + length
        yield pa.RecordBatch.from_pylist([{"files": files, "size": size, "dealt": dealt}])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for root in batch.column(0).to_pylist():
                for name, _, modified in below(root):
                    if is_asked(root, name, ending, recursive):
                        rows.append({"root": root, "name": name, "modified": modified})
                    if len(rows) == FILES_AT_ONCE:
                        yield pa.RecordBatch.from_pylist(rows, FOUND)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, FOUND)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, rows, held = cache(opened), [], 0
        for batch in batches:
            for root, name, modified in zip(*(c.to_pylist() for c in batch.columns)):
                files, inner = store(root)
                place = os.path.join(os.fsencode(inner), name) if name else os.fsencode(inner)
                with open(place, "rb") if isinstance(files, fs.LocalFileSystem) else files.open_input_file(os.fsdecode(place)) as f:
                    data = f.read()
                if rows and (held + len(data) > AT_ONCE or len(rows) == FILES_AT_ONCE):
                    yield pa.RecordBatch.from_pylist(rows, READ)
                    rows, held = [], 0
                shown = f"{root.rstrip('/')}/{name.decode('utf-8', 'replace')}" if name else root
                rows.append({"path": shown, "modified": modified, "content": data})
                held += len(data)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, READ)

    given = spark.createDataFrame([(r,) for r in roots], "root string")
    n = given.mapInArrow(counted, "files long, size long, dealt long").agg(F.sum("files").alias("files"), F.sum("size").alias("size"), F.sum("dealt").alias("dealt")).first()
    if n.dealt:
        return None
    cores = spark.sparkContext.defaultParallelism
    tasks = max(1, min(n.files, 2 * cores), ceil(n.files / FILES), min(n.files, ceil(n.size / BYTES)))
    # by the name's hash: a task that runs again finds its files, in whatever order a folder is listed
    found = given.mapInArrow(listed, "root string, name binary, modified long")
    if recursive:  # a root may lie in another one
        found = found.withColumn("place", F.concat(F.col("root").cast("binary"), F.lit(b"/"), "name")).dropDuplicates(["place"]).drop("place")
    return found.repartition(tasks, "root", "name").mapInArrow(read, "path string, modified long, content binary").select("path", F.timestamp_millis("modified").alias("modificationTime"), F.length("content").cast("long").alias("length"), "content")
