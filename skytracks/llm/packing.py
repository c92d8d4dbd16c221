"""Packing of token pieces into sequences by the sum-of-squares rule.

A piece goes where the sum, over all residual gaps, of the squared number of open sequences with
that gap becomes smallest; of equal places the one with the smallest gap left. Pieces come longest first
and a new sequence is opened only where no open one has room, which on real lengths comes within a sequence or
two a block of the least possible number.

Only lengths matter for the rule, so a document is tokenised where it is read and only its pieces' lengths
travel. Pieces are dealt by a hash into blocks of about ``BLOCK_PIECES``; a block is packed in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytracks.llm.bpe import text_encoder
from skytracks.llm.tables import stored
from skytracks.llm.textbytes import chunks, text_bytes

CAPACITY = 2048
END_ID = 0
NO_PLACE = 1 << 60
# Pieces packed together: bounds a task's memory and work; a table of any size has as many blocks as it needs.
BLOCK_PIECES = 50_000


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The sequence (from 0) of each piece, taken in the given order. Lengths are 1 to ``capacity``."""
    counts = np.zeros(capacity + 1, np.int64)  # open sequences by gap; a full one is not open
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    placed = np.empty(len(lengths), np.int64)
    used = 0
    for at, length in enumerate(lengths.tolist()):
        # Change of the sum when a sequence goes from gap g (length .. capacity - 1) to g - length.
        there = counts[length:capacity]
        change = 2 * (counts[: capacity - length] - there) + 2
        change[:1] -= 1 + 2 * counts[0]  # a sequence that becomes full adds nothing
        change[there == 0] = NO_PLACE
        left = int(np.argmin(change)) if len(change) else 0
        if len(change) and change[left] < NO_PLACE:
            number = waiting[left + length].pop()
            counts[left + length] -= 1
        else:
            left, number, used = capacity - length, used, used + 1
        if left:
            waiting[left].append(number)
            counts[left] += 1
        placed[at] = number
    return placed


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every document's pieces.

    A document is its ids and then id 0, so that null and empty texts have one piece of one id. Documents of more
    than ``capacity`` ids are cut from the end, so that only the first piece is shorter. Repeated rows are documents
    of their own. A task holds about ``textbytes.CHUNK_BYTES`` of text at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(path)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                ids, counts = encoder(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                ids = np.insert(ids, np.cumsum(counts), END_ID)
                sizes = counts + 1
                number = -(-sizes // capacity)
                owner = np.repeat(np.arange(b - a), number)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
                first = sizes - (number - 1) * capacity
                start = np.where(piece == 0, 0, first[owner] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[owner], capacity)
                little = memoryview(ids.astype("<u4")).cast("B")
                cuts = np.concatenate([[0], np.cumsum(length)]).tolist()
                crc = [zlib.crc32(little[4 * x : 4 * y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
                columns = [
                    batch.column(0).slice(a, b - a).take(pa.array(owner)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    names = [field.split()[0] for field in schema.split(", ")]
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def placed(cut: DataFrame, capacity: int = CAPACITY, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """``cut`` (rows of ``pieces``, stored) with sequence_id and offset. Reads its number of rows first."""
    count = cut.count()
    blocks = max(1, -(-count // block_pieces))

    def pack(table: pa.Table) -> pa.Table:
        keys = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]
        table = table.sort_by(keys)
        lengths = table.column("length").to_numpy()
        numbers = sum_of_squares(lengths, capacity)
        order = np.argsort(numbers, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        opens = np.flatnonzero(np.diff(numbers[order], prepend=-1))
        offset = np.empty(len(lengths), np.int64)
        offset[order] = before - np.repeat(before[opens], np.diff(np.append(opens, len(order))))
        block = table.column("__block").to_numpy()
        # Blocks hold far fewer than 2**32 sequences each.
        ids = (block.astype(np.int64) << 32) + numbers
        return (
            table.drop_columns(["__block"])
            .append_column("sequence_id", pa.array(ids, pa.int64()))
            .append_column("offset", pa.array(offset, pa.int64()))
        )

    # The number of a stored row goes in, so that equal rows spread over the blocks like any others.
    content = ("doc_id", "piece", "length", "ids_crc32")
    dealt = cut.withColumn("__block", F.pmod(F.xxhash64(*content, F.monotonically_increasing_id()), F.lit(blocks)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return dealt.groupBy("__block").applyInArrow(pack, schema)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return placed(stored(pieces(docs, path, capacity), "pieces"), capacity)


def sequences(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, and the doc_ids in their order."""
    cut = stored(pieces(docs, path, capacity, with_ids=True), "pieces")
    rows = placed(cut, capacity).groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("parts")  # at most capacity pieces
    )
    return rows.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
