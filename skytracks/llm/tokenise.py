"""Pieces, encoding and decoding of texts by byte-level BPE whose words are found by a scan of transition functions.

The pattern's words are found without a regular expression. Code points become classes through an
array. Each class is a function from state to state (in a word of letters, digits or other signs, in
white space, after a joining space, in a contraction); composing such functions is associative, and
the functions that can arise are few, so they are numbered and composed through a table. A
two-level prefix scan (columns of many blocks side by side, then the blocks) gives the state before
every code point, and state and class say where a word begins.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skytracks.llm.bpe import SliceCoder, ranks_of
from skytracks.llm.textbytes import chunks, ranges, text_bytes

# Fixed: the code points of Unicode's White_Space property.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# Fixed: what may follow an apostrophe in a word of its own.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

NO_PAIR = 1 << 60
LETTER, DIGIT, OTHER, SHORT, LONG, SPACES, JOINING, SINGLE = range(8)  # SHORT, LONG: apostrophe with 1 or 2 letters
(IN_LETTERS, IN_DIGITS, IN_OTHER, IN_SPACES, JOINED, ONE_MORE, TWO_MORE, CLOSED) = range(8)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The state after a code point, and whether a word begins at it."""
    if kind == LETTER:
        if state in (ONE_MORE, TWO_MORE):
            return (CLOSED if state == ONE_MORE else ONE_MORE), False
        return IN_LETTERS, state not in (IN_LETTERS, JOINED)
    if kind == DIGIT:
        return IN_DIGITS, state not in (IN_DIGITS, JOINED)
    if kind in (OTHER, SHORT, LONG):
        if state in (IN_OTHER, JOINED):
            return IN_OTHER, False
        return {OTHER: IN_OTHER, SHORT: ONE_MORE, LONG: TWO_MORE}[kind], True
    if kind == SPACES:
        return IN_SPACES, state != IN_SPACES
    return (JOINED if kind == JOINING else IN_SPACES), True


class WordScan:
    """Tables of the scan: numbered functions, their products, and their values."""

    def __init__(self):
        kinds, states = range(8), range(8)
        identity = tuple(states)
        plain = [tuple(_step(state, kind)[0] for state in states) for kind in kinds]
        first = [tuple(_step(CLOSED, kind)[0] for _ in states) for kind in kinds]  # a text begins here
        functions = list(dict.fromkeys([identity, *plain, *first]))
        numbers = {function: number for number, function in enumerate(functions)}
        for left in functions:  # grows while it is walked, until products give nothing new
            for right in functions[: len(functions)]:
                for one, two in ((left, right), (right, left)):
                    product = tuple(two[one[state]] for state in states)
                    if product not in numbers:
                        numbers[product] = len(functions)
                        functions.append(product)
        self.values = np.array(functions, np.uint8)
        self.products = np.array(
            [[numbers[tuple(two[one[state]] for state in states)] for two in functions] for one in functions], np.uint16
        )
        self.generators = np.array([numbers[f] for f in (*plain, *first)], np.uint16)
        self.begins = np.array([[_step(state, kind)[1] for kind in kinds] for state in states])
        table = np.full(0x110000, OTHER, np.uint8)
        for point in range(0x110000):
            category = unicodedata.category(chr(point))[0]
            if category in "LN":
                table[point] = LETTER if category == "L" else DIGIT
        table[list(WHITE_SPACE)] = SPACES
        self.classes = table

    def kinds(self, points: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The class of each code point; ``last`` marks the last one of each text."""
        kinds = self.classes[points]
        spaces = kinds == SPACES
        joins = spaces & ~last
        joins[:-1] &= ~spaces[1:]
        kinds[joins] = np.where(points[joins] == 0x20, JOINING, SINGLE)
        marks = np.flatnonzero((points == 0x27) & ~last)
        if len(marks):
            one = points[marks + 1]
            two = np.where(last[marks + 1], 0, points[np.minimum(marks + 2, len(points) - 1)])
            for ending in ENDINGS:
                hit = one == ord(ending[0])
                if len(ending) == 2:
                    hit &= two == ord(ending[1])
                kinds[marks[hit]] = SHORT if len(ending) == 1 else LONG
        return kinds

    def word_starts(self, points: np.ndarray, firsts: np.ndarray, width: int = 128) -> np.ndarray:
        """Places where words begin; ``firsts`` marks the first code point of each text."""
        count = len(points)
        last = np.ones(count, bool)
        last[:-1] = firsts[1:]
        kinds = self.kinds(points, last)
        blocks = -(-count // width)
        padded = np.zeros(blocks * width, np.uint16)
        padded[:count] = self.generators[kinds + 8 * firsts.astype(np.uint8)]
        columns = np.ascontiguousarray(padded.reshape(blocks, width).T)
        for at in range(1, width):
            columns[at] = self.products[columns[at - 1], columns[at]]
        # Blocks: the product of all blocks before each, by doubling.
        before = np.zeros(blocks, np.uint16)
        before[1:] = columns[-1, :-1]
        step = 1
        while step < blocks:
            before[step:] = self.products[before[:-step].copy(), before[step:]]
            step *= 2
        entering = self.values[before, CLOSED]
        states = np.empty((width, blocks), np.uint8)
        states[0] = entering
        states[1:] = self.values[columns[:-1], entering[None, :]]
        return np.flatnonzero(self.begins[states.T.reshape(-1)[:count], kinds] | firsts)


class PairMerger:
    """Ids of words by merging the pair of lowest rank, again and again."""

    def __init__(self, path: str):
        self.ranks = ranks_of(path)
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.sizes = np.array([len(token) for token in self.tokens], np.int64)
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.places = np.cumsum(self.sizes) - self.sizes

    def merged(self, word: bytes) -> list[int]:
        ranks = self.ranks
        if word in ranks:
            return [ranks[word]]
        parts = [word[i : i + 1] for i in range(len(word))]
        pairs = [ranks.get(a + b, NO_PAIR) for a, b in zip(parts, parts[1:], strict=False)]
        if len(parts) > 200:
            return self._merged_long(parts)
        while pairs:
            best = min(pairs)
            if best == NO_PAIR:
                break
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = ranks.get(parts[at] + parts[at + 1], NO_PAIR)
            if at:
                pairs[at - 1] = ranks.get(parts[at - 1] + parts[at], NO_PAIR)
        return [ranks[part] for part in parts]

    def _merged_long(self, parts: list[bytes]) -> list[int]:
        """The same with a heap and links, for words of many bytes."""
        import heapq

        ranks, count = self.ranks, len(parts)
        following, preceding = list(range(1, count + 1)), list(range(-1, count - 1))
        heap = []

        def offer(left: int) -> None:
            right = following[left]
            if right < count and (rank := ranks.get(parts[left] + parts[right])) is not None:
                heapq.heappush(heap, (rank, left, parts[left], parts[right]))

        for left in range(count - 1):
            offer(left)
        while heap:
            _, left, one, two = heapq.heappop(heap)
            right = following[left]
            if parts[left] != one or right >= count or parts[right] != two:
                continue  # one of the two has been merged since
            parts[left], parts[right] = one + two, b""
            following[left] = following[right]
            if following[right] < count:
                preceding[following[right]] = left
            offer(left)
            if preceding[left] >= 0:
                offer(preceding[left])
        return [ranks[part] for part in parts if part]

    def __call__(self, slices: list[bytes], free: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = [self.merged(word) for word in slices]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.arange(len(slices)), np.array([i for ids in found for i in ids], np.uint32), counts

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[ranges(self.places[ids], self.sizes[ids])]


class Tokeniser:
    """Encodes and decodes texts given as one byte array; words are kept as places in it."""

    def __init__(self, path: str):
        self.scan, self.merger = WordScan(), PairMerger(path)
        self.coder = SliceCoder(self.merger)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of words, in bytes."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        places = np.flatnonzero((data & 0xC0) != 0x80)
        begins = np.unique(offsets[:-1][np.diff(offsets) > 0])
        firsts = np.zeros(len(points), bool)
        firsts[np.searchsorted(places, begins)] = True
        starts = places[self.scan.word_starts(points, firsts)]
        return starts, np.append(starts[1:], len(data))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the place of each text's first id (one more than texts)."""
        starts, ends = self.words(data, offsets)
        ids, counts = self.coder.ids(data, starts, ends, np.ones(len(starts), bool))
        before = np.concatenate([[0], np.cumsum(counts)])
        places = before[np.searchsorted(starts, offsets, "left")] if len(starts) else np.zeros(len(offsets), np.int64)
        # Words are told apart by a hash; should two ever share one, decoding shows it and the text is coded by itself.
        if np.array_equal(self.merger.decoded(ids), data):
            return ids, places
        parts = []
        for a, b in zip(offsets[:-1], offsets[1:], strict=True):
            inside = (starts >= a) & (starts < b)
            words = [data[x:y].tobytes() for x, y in zip(starts[inside], ends[inside], strict=True)]
            parts.append(self.merger(words, np.ones(len(words), bool))[1])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(part) for part in parts])])

    def decode(self, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts, and the offset of each."""
        sizes = np.concatenate([[0], np.cumsum(self.merger.sizes[ids])])
        return self.merger.decoded(ids), sizes[places]


@lru_cache(maxsize=2)
def tokeniser(path: str) -> Tokeniser:
    """One per worker process."""
    return Tokeniser(path)


def encode_texts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) and word count per document; null and empty texts have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokeniser(path)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                ids, places = coder.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                lists = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the bytes that the ids stand for; null ids stand for none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokeniser(path)
        for batch in batches:
            lists = batch.column(1)
            values = [np.array(ids.as_py() or [], np.int64) for ids in lists]
            decoded = [coder.merger.decoded(ids).tobytes() for ids in values]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], ["doc_id", "content"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, content binary")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes decoded from them.

    Ids are digested as little-endian unsigned 32-bit numbers. Null and empty texts have no ids; repeated rows
    give repeated rows; other columns are ignored. A task holds about ``textbytes.CHUNK_BYTES`` of text at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokeniser(path)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                ids, places = coder.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                content, cuts = coder.decode(ids, places)
                little, plain = memoryview(ids.astype("<u4")).cast("B"), memoryview(np.ascontiguousarray(content))
                spans = list(zip(places[:-1].tolist(), places[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(np.diff(places), pa.int64()),
                        pa.array([hashlib.sha256(little[4 * x : 4 * y]).hexdigest() for x, y in spans], pa.string()),
                        pa.array(
                            [hashlib.sha256(plain[x:y]).hexdigest() for x, y in zip(cuts[:-1], cuts[1:], strict=True)],
                            pa.string(),
                        ),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
