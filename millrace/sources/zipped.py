"""Members of zip archives as rows, one task for a range of members: archives of any size are read in parallel.

A data source for Spark: its planner reads only the directories at the archives' ends, and each task the bytes of its
members. Paths are those that Arrow opens (local, hdfs, s3, gs).
"""

from __future__ import annotations

import io
import json
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, member string, nth long, data binary, error string"
ARROW = pa.schema([("path", pa.string()), ("member", pa.string()), ("nth", pa.int64()), ("data", pa.binary()), ("error", pa.string())])
#: Compressed bytes of the members of one task, bytes of the members that leave a task at once, archives looked at at once.
RANGE, AT_ONCE, THREADS = 64 << 20, 16 << 20, 16
LOCAL_HEADER = struct.Struct("<4s5H3L2H")


def opened(path: str) -> tuple[fs.FileSystem, str]:
    path = re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def archives(path: str) -> list[str]:
    """The path itself, or the zip files of a folder."""
    files, inner = opened(path)
    prefix = path[: len(path) - len(inner)] if "://" in path and path.endswith(inner) else ""
    if files.get_file_info(inner).type == fs.FileType.Directory:
        return sorted(prefix + x.path for x in files.get_file_info(fs.FileSelector(inner)) if x.is_file and x.base_name.endswith(".zip") and x.base_name != ".zip")
    return [path]


@dataclass
class Member:
    name: str
    nth: int
    begin: int
    packed: int
    size: int
    method: int
    crc: int
    secret: bool


@dataclass
class Range(InputPartition):
    path: str
    members: list[Member]
    error: str | None = None


def ranges(path: str, suffix: str, size: int) -> list[Range]:
    """Members whose names end so, whatever the case, in ranges of so many compressed bytes, or a single larger one."""
    files, inner = opened(path)
    try:
        # small files are read whole: the reader of directories seeks before their beginning, which Arrow's files refuse
        with files.open_input_file(inner) as f, zipfile.ZipFile(f if f.size() > 1 << 12 else io.BytesIO(f.read())) as archive:
            infos = [x for x in archive.infolist() if not x.is_dir() and x.filename.lower().endswith(suffix.lower())]
    except (zipfile.BadZipFile, OSError, ValueError, NotImplementedError) as e:
        return [Range(path, [], f"{type(e).__name__}: {e}")]
    out: list[Range] = []
    held = size
    for nth, x in enumerate(infos):
        if held >= size:
            out.append(Range(path, []))
            held = 0
        out[-1].members.append(Member(x.filename, nth, x.header_offset, x.compress_size, x.file_size, x.compress_type, x.CRC, bool(x.flag_bits & 1)))
        held += x.compress_size
    return out


def member_bytes(f, member: Member) -> bytes:
    """What a member holds; ValueError if that can't be told."""
    if member.secret:
        raise ValueError("the member is encrypted")
    f.seek(member.begin)
    head = f.read(LOCAL_HEADER.size)
    if len(head) < LOCAL_HEADER.size or head[:4] != b"PK\x03\x04":
        raise ValueError("no member begins where the directory says")
    name, extra = LOCAL_HEADER.unpack(head)[-2:]
    f.seek(member.begin + LOCAL_HEADER.size + name + extra)
    data = f.read(member.packed)
    if member.method == zipfile.ZIP_DEFLATED:
        unpacker = zlib.decompressobj(-15)
        # a member that holds more than its directory says is not unpacked any further
        data = unpacker.decompress(data, member.size + 1)
    elif member.method != zipfile.ZIP_STORED:
        raise ValueError(f"compression method {member.method} is not known")
    if len(data) != member.size or zlib.crc32(data) != member.crc:
        raise ValueError("size or checksum don't hold")
    return data


class ZipReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.suffix, self.size = options.get("suffix", ""), int(options.get("rangebytes", RANGE))

    def partitions(self) -> list[Range]:
        with ThreadPoolExecutor(THREADS) as pool:
            files = sorted({x for some in pool.map(archives, self.paths) for x in some})
            found = list(pool.map(lambda p: ranges(p, self.suffix, self.size), files))
        return [r for some in found for r in some] or [Range(self.paths[0], [])]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition.error:
            yield pa.RecordBatch.from_pylist([{"path": partition.path, "error": partition.error}], ARROW)
        if not partition.members:
            return
        files, inner = opened(partition.path)
        rows, held = [], 0
        with files.open_input_file(inner) as f:
            for m in partition.members:
                row = {"path": partition.path, "member": m.name, "nth": m.nth}
                try:
                    row["data"] = member_bytes(f, m)
                except (ValueError, OSError, zlib.error) as e:
                    row["error"] = f"{type(e).__name__}: {e}"
                if rows and held + m.size > AT_ONCE:
                    yield pa.RecordBatch.from_pylist(rows, ARROW)
                    rows, held = [], 0
                rows.append(row)
                held += m.size
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)


class ZipSource(DataSource):
    """format("zip_members"): options path (or paths, as JSON), suffix, rangeBytes."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ZipReader:
        return ZipReader(self.options)


def zip_members(spark: SparkSession, path: str | list[str], suffix: str = "", range_bytes: int = RANGE) -> DataFrame:
    """(path, member, nth, data, error): the members of zip files, or of those of folders, whose names end so; an error for
    an archive or a member that can't be read."""
    spark.dataSource.register(ZipSource)
    paths = [path] if isinstance(path, str) else path
    return spark.read.format("zip_members").option("suffix", suffix).option("rangeBytes", str(range_bytes)).option("paths", json.dumps(paths)).load()


def written_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Writes (member, data) rows as zip files to a folder, one for each partition; (path, members) of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, inner = opened(folder)
        files.create_dir(inner, recursive=True)
        name, many = f"{inner.rstrip('/')}/part-{TaskContext.get().partitionId():06d}.zip", 0
        # a task that runs again writes the same file
        with files.open_output_stream(name) as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as archive:
            for batch in batches:
                for member, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    archive.writestr(zipfile.ZipInfo(member), data, zipfile.ZIP_DEFLATED)
                    many += 1
        yield pa.RecordBatch.from_pylist([{"path": name, "members": many}])

    return rows.select("member", "data").mapInArrow(run, "path string, members long")
