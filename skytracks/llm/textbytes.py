"""Texts of an Arrow batch as one byte array, and hashes of its slices. Used inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that a task works on at a time (one longer text is taken alone): a bound on memory, not on input.
CHUNK_BYTES = 2 << 20

_RANDOM = np.random.default_rng(20240115)
_BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _powers_of(base: int, count: int) -> np.ndarray:
    known = _powers[base]
    while len(known) < count:
        step = np.uint64(pow(base, len(known), 1 << 64))
        known = np.concatenate([known, known * step])
    _powers[base] = known
    return known[:count]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


class SliceHashes:
    """64-bit hashes of any slices of one byte array, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * _powers_of(_BASE, len(data)), out=self.sums[1:])
        self.inverse = _powers_of(_INVERSE, len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def of_width(self, width: int) -> np.ndarray:
        """Hashes of all slices of ``width`` bytes, by start."""
        raw = (self.sums[width:] - self.sums[:-width]) * self.inverse[: len(self.sums) - width]
        return mixed(raw)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, null as empty, and the offsets of the texts (one more than texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together hold about ``size`` bytes; a longer text is a range of its own."""
    first, count = 0, len(offsets) - 1
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), count)
        yield first, last
        first = last


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``starts[i] .. starts[i] + lengths[i]``, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
