"""Token ids in Arrow files of equal-length sequences, read back at any place without copying.

A file is Arrow's stream format with a footer, so that a reader can go to any batch. It has two columns,
``ids`` and ``mask``, both fixed-size lists of ``LENGTH``; all batches but the last have ``BATCH_ROWS`` rows. The
ids of a shard's documents, in order, fill its rows one after the other; the mask is false only in the rest of the
last row. Where a document starts and ends is in a second file beside the first, since the end id may occur in texts.

Documents are sorted into shards by ranges of doc_id. Each attempt of a task writes files with names of their own and
only the files of the attempt that Spark commits are in the manifest, so lost or repeated tasks leave no trace.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytracks.llm.bpe import text_encoder
from skytracks.llm.tables import stored
from skytracks.llm.textbytes import chunks, text_bytes
from skytracks.session import fresh_dir

LENGTH = 2048
BATCH_ROWS = 64
END_ID = 0


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    """A file system that every executor can reach, and the path on it."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


class SequenceWriter:
    """Fills fixed-size rows with ids as they come and writes whole batches."""

    def __init__(self, uri: str, vocabulary: int, length: int = LENGTH, batch_rows: int = BATCH_ROWS):
        kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
        self.kind, self.length, self.size = kind, length, length * batch_rows
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        system, path = _place(uri)
        self.sink = system.open_output_stream(path)
        self.writer = ipc.new_file(self.sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.held = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids.astype(self.kind.to_pandas_dtype()))
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= self.size:
            flat = np.concatenate(self.waiting)
            whole = len(flat) // self.size * self.size
            for at in range(0, whole, self.size):
                self._write(flat[at : at + self.size])
            self.waiting, self.held = [flat[whole:]], len(flat) - whole

    def _write(self, ids: np.ndarray) -> None:
        rows = -(-len(ids) // self.length)
        padded = np.zeros(rows * self.length, ids.dtype)
        padded[: len(ids)] = ids
        mask = np.arange(len(padded)) < len(ids)
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(values), self.length) for values in (padded, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.held:
            self._write(np.concatenate(self.waiting))
        self.writer.close()
        self.sink.close()


class SequenceReader:
    """Ids at any place of a file. Local files are mapped, so that a row is a view of the file."""

    def __init__(self, uri: str):
        system, path = _place(uri)
        local = isinstance(system, fs.LocalFileSystem)
        self.source = pa.memory_map(path) if local else system.open_input_file(path)
        self.file = ipc.open_file(self.source)
        self.length = self.file.schema.field("ids").type.list_size
        self.at, self.batch = -1, None
        self.rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 1

    def _ids_of(self, number: int) -> np.ndarray:
        if number != self.at:
            self.at, self.batch = number, self.file.get_batch(number)
        return self.batch.column("ids").flatten().to_numpy(zero_copy_only=True)

    def mask_of(self, row: int) -> np.ndarray:
        number, inside = divmod(row, self.rows)
        return self.file.get_batch(number).column("mask")[inside].values.to_numpy(zero_copy_only=False)

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from place ``start`` of the shard."""
        size, parts = self.rows * self.length, []
        while count:
            number, inside = divmod(start, size)
            part = self._ids_of(number)[inside : inside + count]
            parts.append(part)
            start, count = start + len(part), count - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint16)


def write_ids(docs: DataFrame, path: str, directory: str, shards: int | None = None) -> DataFrame:
    """Write all documents' ids and return the stored manifest: shard, ids_file, index_file, documents, tokens.

    Order: doc_id, nulls first, then text. A document is its ids by the tokenizers library and then id 0; null text
    counts as empty. Repeated rows are documents of their own; other columns are ignored; no documents, no files. A
    hot doc_id is spread over shards by its texts.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange(shards, "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, index = text_encoder(path), None, []
        shard = TaskContext.get().partitionId()
        name = f"{directory}/shard-{shard:06d}-{uuid.uuid4().hex}"
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                ids, counts = encoder(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                ids = np.insert(ids, np.cumsum(counts), END_ID)
                if writer is None:
                    system, place = _place(directory)
                    system.create_dir(place, recursive=True)
                    writer = SequenceWriter(f"{name}.arrow", len(encoder.library.sizes))
                sizes = counts + 1
                starts = writer.total + np.cumsum(sizes) - sizes
                columns = [batch.column(0).slice(a, b - a), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())]
                index.append(pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens"]))
                writer.add(ids)
        if writer is None:
            return
        writer.close()
        table = pa.Table.from_batches(index)
        system, place = _place(f"{name}.index.arrow")
        with system.open_output_stream(place) as sink, ipc.new_file(sink, table.schema) as out:
            out.write_table(table)
        row = {"shard": shard, "ids_file": f"{name}.arrow", "index_file": f"{name}.index.arrow"}
        row |= {"documents": table.num_rows, "tokens": writer.total}
        yield pa.RecordBatch.from_pylist([row], schema=manifest)

    manifest = pa.schema(
        [("shard", pa.int32()), ("ids_file", pa.string()), ("index_file", pa.string())]
        + [("documents", pa.int64()), ("tokens", pa.int64())]
    )
    return stored(
        ordered.mapInArrow(run, "shard int, ids_file string, index_file string, documents long, tokens long"), "manifest"
    )


def read_documents(manifest: DataFrame, id_type: str = "bigint", with_ids: bool = False) -> DataFrame:
    """Per document, read from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (and ids)."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = manifest.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    each = starts.select("before", "ids_file", "index_file").repartition(
        int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "ids_file"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (row for batch in batches for row in batch.to_pylist()):
            reader = SequenceReader(row["ids_file"])
            system, place = _place(row["index_file"])
            with system.open_input_file(place) as source:
                index = ipc.open_file(source).read_all()
            for part in index.to_batches(max_chunksize=2048):
                starts, sizes = part.column("start").to_numpy(), part.column("n_tokens").to_numpy()
                found = [reader.ids(*span).astype("<u4") for span in zip(starts.tolist(), sizes.tolist(), strict=True)]
                columns = [
                    part.column("doc_id"),
                    pa.array(starts + row["before"], pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array([zlib.crc32(ids.tobytes()) for ids in found], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([ids.astype(np.int32) for ids in found], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    names = [field.split()[0] for field in schema.split(", ")]
    return each.mapInArrow(run, schema)


def written_and_read(docs: DataFrame, path: str) -> DataFrame:
    """All of ``docs`` through files in a new folder of the shared directory."""
    manifest = write_ids(docs, path, fresh_dir(docs.sparkSession, "token_files"))
    return read_documents(manifest, docs.schema["doc_id"].dataType.simpleString())
