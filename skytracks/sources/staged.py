"""A sink that takes a load once: every task stages one file, and a commit on the driver makes all of them count.

``rows.write.format("staged_loads").option("path", folder).option("load", name).mode("append").save()``. A load whose
name the folder already has appends nothing, so a repeated run changes nothing; a task that is repeated or lost leaves a
staged file that no load names. ``overwrite`` starts the folder's list of loads anew. The folder may be on any file system that Arrow knows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType


@dataclass
class StagedFile(WriterCommitMessage):
    """What a task tells the commit: its file, if it had rows."""

    file: str | None
    rows: int


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def committed(path: str) -> list[dict]:
    """The folder's loads, each with its name and files, in the order of their commits."""
    files, base = _opened(path.rstrip("/"))
    found = files.get_file_info(fs.FileSelector(f"{base}/_loads", allow_not_found=True))
    loads = []
    for info in sorted((info for info in found if info.path.endswith(".json")), key=lambda info: info.path):
        with files.open_input_stream(info.path) as stream:
            loads.append(json.loads(stream.read()))
    return loads


class StagedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, load: str, overwrite: bool):
        self.path, self.load, self.overwrite = path.rstrip("/"), load, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, base = _opened(self.path)
        name, rows, writer = f"staged/{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    files.create_dir(f"{base}/staged", recursive=True)
                    writer = pq.ParquetWriter(f"{base}/{name}", batch.schema, filesystem=files)
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return StagedFile(name if rows else None, rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files, base = _opened(self.path)
        staged = [message for message in messages if message is not None and message.file is not None]
        before = committed(self.path)
        if any(entry["load"] == self.load for entry in before) and not self.overwrite:
            self._drop(staged)
            return
        if self.overwrite:
            files.delete_dir_contents(f"{base}/_loads", missing_dir_ok=True)
            before = []
        entry = {"load": self.load, "files": [message.file for message in staged], "rows": sum(m.rows for m in staged)}
        files.create_dir(f"{base}/_loads", recursive=True)
        # Written beside and renamed: a reader sees all of a load or nothing of it.
        temporary = f"{base}/_loads/.{uuid.uuid4().hex}"
        with files.open_output_stream(temporary) as stream:
            stream.write(json.dumps(entry).encode())
        files.move(temporary, f"{base}/_loads/{len(before):09d}.json")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._drop([message for message in messages if message is not None and message.file is not None])

    def _drop(self, staged: list[StagedFile]) -> None:
        files, base = _opened(self.path)
        for message in staged:
            files.delete_file(f"{base}/{message.file}")


class StagedLoads(DataSource):
    @classmethod
    def name(cls) -> str:
        return "staged_loads"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return StagedWriter(self.options["path"], self.options["load"], overwrite)


def read_loads(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all loads that the folder has taken."""
    names = [f"{path.rstrip('/')}/{name}" for entry in committed(path) for name in entry["files"]]
    return spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)
