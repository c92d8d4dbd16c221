"""Byte-level BPE inside tasks: cutting texts where tokens cannot cross, and coding each distinct slice once."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd

from skytracks.llm.textbytes import SliceHashes, ranges

# Distinct slices whose ids a worker remembers. A full memory starts anew: speed depends on it, ids do not.
REMEMBERED = 400_000


class SliceCoder:
    """Ids of many slices of a byte array; ``code`` is asked once per distinct slice while it is remembered.

    ``code(slices, free)`` gets distinct slices as bytes, and which of them stand between two safe cuts;
    it returns an order of the slices, their ids in that order, and the number of ids of each.
    Slices are told apart by a 64-bit hash; callers compare the bytes that the ids stand for.
    """

    def __init__(self, code: Callable[[list[bytes], np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]], remembered: int = REMEMBERED):
        self.code, self.remembered = code, remembered
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begins = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _learn(self, keys: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        if self.used + len(ids) > len(self.pool):
            grown = np.zeros(2 * (self.used + len(ids)), np.uint32)
            grown[: self.used] = self.pool[: self.used]
            self.pool = grown
        self.pool[self.used : self.used + len(ids)] = ids
        begins = self.used + np.cumsum(counts) - counts
        self.used += len(ids)
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, at, keys[order])
        self.begins = np.insert(self.begins, at, begins[order])
        self.counts = np.insert(self.counts, at, counts[order])

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids in order, and how many each slice has."""
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        # A slice that is not free is kept apart from a free one of the same bytes.
        hashes = SliceHashes(data).of(starts, ends) ^ (~free).astype(np.uint64)
        codes, distinct = pd.factorize(hashes)
        if len(self.keys) + len(distinct) > self.remembered:
            self._forget()
        at = np.searchsorted(self.keys, distinct)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == distinct[known]
        if not known.all():
            # Distinct values are numbered as they first appear.
            first = np.flatnonzero(np.diff(np.maximum.accumulate(codes), prepend=-1))
            new = first[~known]
            blob = data.tobytes()
            slices = [blob[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
            order, ids, counts = self.code(slices, free[new])
            self._learn(distinct[~known][order], ids, counts)
            at = np.searchsorted(self.keys, distinct)
        each = at[codes]
        counts = self.counts[each]
        return self.pool[ranges(self.begins[each], counts)], counts


def space_cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slices that no token of the pattern crosses: starts, ends, and whether both ends are such cuts.

    A cut lies before a space that stands alone between two characters that are not white space. Bytes
    that may belong to white space beyond ASCII count as white space here, which only makes slices longer.
    """
    count = len(data)
    inside = np.zeros(count + 1, bool)
    if count > 4:
        before, after = data[2:-2], data[4:]
        wide = (before >= 0x80) & ((data[1:-3] == 0xC2) | np.isin(data[:-4], (0xE1, 0xE2, 0xE3)))
        solid = (before > 0x20) & ~wide & (after > 0x20) & ~np.isin(after, (0xC2, 0xE1, 0xE2, 0xE3))
        inside[3:-2] = solid & (data[3:-1] == 0x20)
    edges = np.zeros(count + 1, bool)
    edges[offsets] = True
    inside[offsets] = False
    # No cut next to an edge either: what stands there belongs to another text.
    inside[np.minimum(offsets + 1, count)] = False
    starts = np.flatnonzero(inside | edges)
    if not len(starts):
        return starts, starts, np.zeros(0, bool)
    starts, ends = starts[:-1], starts[1:]
    return starts, ends, inside[starts] & inside[ends]


class LibraryCoder:
    """Ids by the tokenizers library, with many slices joined into one text for each call."""

    def __init__(self, path: str, joined: int = 256):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        # In a byte-level vocabulary each character of a token stands for one byte.
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.sizes[number] = len(token)
        self.joined = joined

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(found.ids, np.uint32) for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __call__(self, slices: list[bytes], free: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        alone, rest = np.flatnonzero(~free), np.flatnonzero(free)
        ids = self._encode([slices[i].decode() for i in alone.tolist()])
        counts = [np.array([len(part) for part in ids], np.int64)]
        for at in range(0, len(rest), self.joined * self.joined):
            block = [slices[i] for i in rest[at : at + self.joined * self.joined].tolist()]
            texts = [b"".join(block[i : i + self.joined]).decode() for i in range(0, len(block), self.joined)]
            found = np.concatenate(self._encode(texts))
            # No token crosses the joints, so the ids of a slice end where its bytes do.
            ends = np.cumsum([len(piece) for piece in block])
            cuts = np.searchsorted(np.cumsum(self.sizes[found]), ends, "left") + 1
            ids.append(found)
            counts.append(np.diff(cuts, prepend=0))
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        return np.concatenate([alone, rest]), flat, np.concatenate(counts)


class TextEncoder:
    """Ids of whole texts by the tokenizers library. Equal slices are encoded once."""

    def __init__(self, path: str):
        self.library = LibraryCoder(path)
        self.coder = SliceCoder(self.library)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has."""
        starts, ends, free = space_cuts(data, offsets)
        ids, counts = self.coder.ids(data, starts, ends, free)
        before = np.concatenate([[0], np.cumsum(counts)])
        # Texts without bytes have no slice; a text's slices start at or after its offset.
        at = before[np.searchsorted(starts, offsets, "left")] if len(starts) else np.zeros(len(offsets), np.int64)
        per_text = np.diff(at)
        sizes = np.concatenate([[0], np.cumsum(self.library.sizes[ids])])
        wrong = np.flatnonzero(sizes[at[1:]] - sizes[at[:-1]] != np.diff(offsets))
        if not len(wrong):
            return ids, per_text
        # Ids that stand for another number of bytes mean two slices of one hash: those texts are encoded whole.
        parts = np.split(ids, at[1:-1])
        for text in wrong.tolist():
            parts[text] = self.library._encode([data[offsets[text] : offsets[text + 1]].tobytes().decode()])[0]
        return np.concatenate(parts), np.array([len(part) for part in parts])


@lru_cache(maxsize=2)
def text_encoder(path: str) -> TextEncoder:
    """One encoder per worker process, reused by its tasks."""
    return TextEncoder(path)


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
