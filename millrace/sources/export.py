"""Rows as files of their own."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .zipped import opened


def written_files(rows: DataFrame, folder: str) -> DataFrame:
    """Writes (name, data) rows as files below a folder, whose names may have folders too; (files) of each partition.

    A task that runs again writes the same files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, inner = opened(folder)
        many, made = 0, set()
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                path = f"{inner.rstrip('/')}/{name}"
                parent = path.rpartition("/")[0]
                if parent not in made:
                    files.create_dir(parent, recursive=True)
                    made.add(parent)
                with files.open_output_stream(path) as f:
                    f.write(data or b"")
                many += 1
        yield pa.RecordBatch.from_pylist([{"files": many}])

    return rows.select("name", "data").mapInArrow(run, "files long")
