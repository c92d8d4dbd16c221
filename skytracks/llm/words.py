"""Words and five-word shingles of many texts as arrays of hashes. Used inside tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from skytracks.llm.textbytes import SliceHashes, mixed

SHINGLE = 5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = np.random.default_rng(5).integers(1, 2**62, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@dataclass
class Words:
    """Words of texts: byte places, hashes of the words in lower case (A-Z only), and where each text's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    firsts: np.ndarray  # one more than texts

    @property
    def texts(self) -> int:
        return len(self.firsts) - 1

    def shingles(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all shingles in order, and where each text's shingles begin.

        The shingle at place i is words i to i + 4. A text of one to four words has one shingle, all its words.
        """
        counts = np.diff(self.firsts)
        sizes = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
        begins = np.concatenate([[0], np.cumsum(sizes)])
        padded = np.concatenate([self.hashes, np.zeros(SHINGLE, np.uint64)])
        total = len(self.hashes)
        at = np.arange(begins[-1]) + np.repeat(self.firsts[:-1] - begins[:-1], sizes)
        whole = np.zeros(total, np.uint64)
        for step in range(SHINGLE):
            whole += padded[step : step + total] * _ODD[step]
        found = whole[at]
        for text in np.flatnonzero((counts > 0) & (counts < SHINGLE)).tolist():
            words = self.hashes[self.firsts[text] : self.firsts[text + 1]]
            found[begins[text]] = np.sum(words * _ODD[: len(words)], dtype=np.uint64)
        return mixed(found), begins


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words are maximal runs of bytes other than space and 0x09 to 0x0D; none crosses texts."""
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], solid[:-1]]) if len(data) else solid
    after = np.concatenate([solid[1:], [False]]) if len(data) else solid
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    hashes = SliceHashes(_LOWER[data]).of(starts, ends)
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets, "left"))
