"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

Sought are all places whose string of ``length`` bytes starts anywhere else too. Suffixes are dealt into buckets by content:
every place p belongs to the anchor of its string, the smallest hash of a short byte run in it. Equal strings have
their anchors at the same distance, so a suffix only has to be sorted among those of its own anchor's bucket.

1. Anchors that occur once are done: their suffixes are unique.
2. An anchor occurrence has a context, the text that the strings of its places cover. Contexts that occur twice or more are
   done: all their places repeat.
3. What is left differs somewhere in the context. Tasks take whole buckets, one block of them at a time, and sort the
   suffixes of the block's distinct contexts. Prefixes are named first, a part of the suffixes at a time. Ties beyond the
   prefix are resolved by ranks of the cover sample, computed before: for any two places there is a shift at which both are
   sample places, so two strings are equal when their prefixes, the ranks at that shift and their last prefixes are.
   Buckets of so many distinct contexts that a task should not hold them are counted instead, by slices and strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytracks.llm.tables import stored, whole_text
from skytracks.llm.textbytes import SliceHashes, chunks, ranges, text_bytes

LENGTH = 400
# Longer runs occur in fewer texts that share no whole string, for somewhat more anchors.
RUN = 128
# A difference cover modulo 31: every difference of two residues is one of two members.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
# Bytes of context sorted together in a task, and distinct contexts of one anchor that a task sorts at all.
BLOCK_BYTES = 1 << 20
LARGE_BUCKET = 2000
SLICE = 16

CONTEXT_COLUMNS = ["anchor", "n", "first", "place"]

_PLACE_BITS = np.uint64(24)
_PLACE = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, run: int = RUN):
    """(anchor hash, place of the anchor, first place, last place, text) of all anchor occurrences.

    Places first .. last have the anchor; a text shorter than ``length`` has none. At most 2**24 bytes at a time.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return np.zeros(0, np.uint64), none, none, none, none
    hashes = SliceHashes(data).of_width(run)
    # Of equal hashes the first place is taken, so that the choice depends on the string alone.
    best = (hashes >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(hashes), dtype=np.uint64)
    width, have = length - run + 1, 1
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best[: len(best) - step], best[step:])
        have += step
    place = (best & _PLACE).astype(np.int64)  # by start of the string
    starts = np.arange(len(place))
    text = np.searchsorted(offsets, starts, "right") - 1
    inside = starts + length <= offsets[text + 1]
    starts, place, text = starts[inside], place[inside], text[inside]
    if not len(starts):
        return np.zeros(0, np.uint64), none, none, none, none
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(starts)) - 1
    return hashes[place[at]], place[at], starts[at], starts[last], text[at]


def pieces_of(offsets: np.ndarray, length: int, limit: int = 1 << 23) -> Iterator[tuple[int, int, int, int]]:
    """(first text, last text, from, to) in bytes; a text beyond ``limit`` comes in parts that overlap by ``length`` - 1."""
    for a, b in chunks(offsets):
        start, end = int(offsets[a]), int(offsets[b])
        if end - start <= limit:
            yield a, b, start, end
            continue
        while start < end:
            yield a, b, start, min(start + limit, end)
            if start + limit >= end:
                break
            start += limit - length + 1


def _names(column: np.ndarray) -> np.ndarray:
    """Ranks of keys in sorted order, without gaps; equal keys have equal ranks."""
    order = np.argsort(column)
    ranked = column[order]
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(np.append(False, ranked[1:] != ranked[:-1])) if len(order) else 0
    return names


def _pair_names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Ranks of pairs of ranks; blocks hold fewer than 2**31 suffixes."""
    return _names((left << 32) + (right + 1))


def _prefix_names(data: np.ndarray, part: int) -> np.ndarray:
    """The rank of the PERIOD bytes at each place (zeros beyond the end) among all places.

    Suffixes are put into buckets by their first two bytes; buckets of about ``part`` suffixes are sorted at a time.
    """
    padded = np.concatenate([data, np.zeros(PERIOD + 8, np.uint8)])
    lead = (padded[: len(data)].astype(np.int64) << 8) | padded[1 : len(data) + 1]
    before = np.cumsum(np.bincount(lead, minlength=1 << 16))
    batch = np.concatenate([[0], before[:-1]])[lead] // part
    order = np.argsort(batch, kind="stable")
    names, base = np.empty(len(data), np.int64), 0
    for chosen in np.split(order, np.flatnonzero(np.diff(batch[order])) + 1):
        ranks = None
        for at in range(0, PERIOD, 8):
            word = np.zeros(len(chosen), np.uint64)
            for step in range(at, min(at + 8, PERIOD)):
                word = (word << np.uint64(8)) | padded[chosen + step]
            ranks = _names(word) if ranks is None else _pair_names(ranks, _names(word))
        names[chosen] = base + ranks
        base += int(ranks.max()) + 1
    return names


def repeated_strings(data: np.ndarray, places: np.ndarray, length: int = LENGTH, part: int = 1 << 18) -> np.ndarray:
    """Whether the ``length`` bytes at each of ``places`` also start at another of them.

    All strings lie inside ``data``; ``length`` is at least twice PERIOD.
    """
    found = np.zeros(len(places), bool)
    if not len(places):
        return found
    prefix = np.append(_prefix_names(data, part), -1)
    member = np.zeros(PERIOD, bool)
    member[list(COVER)] = True
    sample = np.flatnonzero(member[np.arange(len(data)) % PERIOD])
    # Ranks of the cover sample to a depth of whole periods, by doubling: places a period apart are both in the sample.
    depth = (length - PERIOD + 1) // PERIOD * PERIOD
    rank = np.full(len(data) + 1, -1, np.int64)
    rank[sample] = prefix[sample]
    known = PERIOD
    while known < depth:
        step = min(known, depth - known)
        rank[sample] = _pair_names(rank[sample], rank[np.minimum(sample + step, len(data))])
        known += step
    # The rank reaches from the shift to within two periods of the end; the string's first and last prefixes cover the rest.
    ends = _pair_names(prefix[places + length - 2 * PERIOD], prefix[places + length - PERIOD])
    frame = _pair_names(prefix[places], ends)
    # Strings that are alone with their prefixes are unique; only ties go on to the ranks.
    tied = np.flatnonzero(np.bincount(frame)[frame] > 1)
    residue, frame = places[tied] % PERIOD, frame[tied] << 32
    for shift in range(PERIOD):
        here = np.flatnonzero(member[(residue + shift) % PERIOD])
        if len(here) > 1:
            codes = pd.factorize(frame[here] + rank[places[tied[here]] + shift])[0]
            found[tied[here[np.bincount(codes)[codes] > 1]]] = True
    return found


def _two_longs(column, name: str) -> list:
    """A 32-digit hexadecimal digest as two longs."""
    half = lambda start: F.conv(F.substring(column, start, 16), 16, -10).cast("long")
    return [half(1).alias(f"{name}1"), half(17).alias(f"{name}2")]


def _keyed(docs: DataFrame) -> DataFrame:
    """The text and its digest (k1, k2); null counts as empty."""
    return docs.select(*_two_longs(F.md5(whole_text()), "k"), whole_text().alias("text"))


def occurrences(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(k1, k2, anchor, c1, c2, first, last): the anchor occurrences of every text and the digests of their contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            keys = [batch.column(name).to_numpy() for name in ("k1", "k2")]
            for a, b, start, end in pieces_of(offsets, length):
                part = data[start:end]
                local = np.clip(offsets[a : b + 1], start, end) - start
                found, place, first, last, text = anchors(part, local, length)
                view = memoryview(np.ascontiguousarray(part))
                spans = zip(first.tolist(), (last + length).tolist(), strict=True)
                digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(view[x:y]) for x, y in spans), "<i8").reshape(-1, 2)
                shift = start - offsets[a : b + 1][text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[a:b][text]) for key in keys]
                    + [pa.array(found.view(np.int64)), pa.array(digests[:, 0]), pa.array(digests[:, 1])]
                    + [pa.array(first + shift), pa.array(last + shift), pa.array(place + shift)],
                    ["k1", "k2", "anchor", "c1", "c2", "first", "last", "place"],
                )

    schema = "k1 long, k2 long, anchor long, c1 long, c2 long, first long, last long, place long"
    return _keyed(docs).filter(F.octet_length("text") >= length).mapInArrow(run, schema)


def _context_rows(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` (k1, k2, first, last and COLUMNS) with the bytes of their contexts."""
    asked = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("last", *CONTEXT_COLUMNS)).alias("asked"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in chunks(offsets):
                lists = batch.column("asked").slice(a, b - a)
                owner = a + np.repeat(np.arange(b - a), lists.value_lengths().to_numpy(zero_copy_only=False))
                last, *others = (field.to_numpy(zero_copy_only=False) for field in lists.flatten().flatten())
                first = others[CONTEXT_COLUMNS.index("first")]
                sizes = last - first + length
                # Contexts of one text overlap, so they are taken a bounded number of bytes at a time.
                ends = np.cumsum(sizes)
                for x, y in chunks(np.concatenate([[0], ends])):
                    cuts = np.concatenate([[0], np.cumsum(sizes[x:y])]).astype(np.int32)
                    content = data[ranges(offsets[owner[x:y]] + first[x:y], sizes[x:y])]
                    contexts = pa.Array.from_buffers(
                        pa.binary(), y - x, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(content))]
                    )
                    keys = [batch.column(name).to_numpy()[owner[x:y]] for name in ("k1", "k2")]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(column) for column in (*keys, *(column[x:y] for column in others))] + [contexts],
                        ["k1", "k2", *CONTEXT_COLUMNS, "bytes"],
                    )

    joined = texts.join(asked, ["k1", "k2"]).select("k1", "k2", "text", "asked")
    return joined.mapInArrow(run, ", ".join(f"{name} long" for name in ("k1", "k2", *CONTEXT_COLUMNS)) + ", bytes binary")


def _sorted_buckets(contexts: DataFrame, length: int) -> DataFrame:
    """(k1, k2, first, last): runs of repeated places in the contexts that occur once."""

    def solve(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        block = pa.Table.from_batches(rows).combine_chunks()
        data, offsets = _binary(block.column("bytes").chunk(0))
        counts = np.diff(offsets) - length + 1
        owner = np.repeat(np.arange(len(counts)), counts)
        places = ranges(offsets[:-1], counts)
        found = repeated_strings(data, places, length) & (block.column("n").to_numpy() == 1)[owner]
        # Runs of places that repeat, none over the end of a context.
        here = np.flatnonzero(found)
        new = np.ones(len(here), bool)
        new[1:] = (np.diff(here) > 1) | (owner[here[1:]] != owner[here[:-1]])
        at = np.flatnonzero(new)
        low, high = here[at], here[np.append(at[1:], len(here)) - 1] if len(here) else here
        first = block.column("first").to_numpy()[owner[low]] + places[low] - offsets[owner[low]]
        keys = [block.column(name).to_numpy()[owner[low]] for name in ("k1", "k2")]
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (*keys, first, first + (high - low))], ["k1", "k2", "first", "last"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            anchor = batch.column("anchor").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(anchor)) + 1).tolist(), len(anchor)] if len(anchor) else [0]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                bucket = batch.slice(x, y - x)
                same = held and held[-1].column("anchor")[-1].as_py() == anchor[x]
                if size > BLOCK_BYTES and not same:
                    yield solve(held)
                    held, size = [], 0
                held.append(bucket)
                size += int(_binary(bucket.column("bytes"))[1][-1])
        if held:
            yield solve(held)

    dealt = contexts.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "k1 long, k2 long, first long, last long")


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def _digests(view: memoryview, starts, size: int) -> np.ndarray:
    joined = b"".join(xxhash.xxh3_128_digest(view[x : x + size]) for x in starts)
    return np.frombuffer(joined, "<i8").reshape(-1, 2)


def _counted_slices(contexts: DataFrame, length: int) -> DataFrame:
    """The same for buckets too large to sort, as counts that combine before each shuffle.

    Contexts are cut into slices of SLICE places by their distance from the anchor, so that equal strings stand in slices of
    the same number. A slice that occurs twice repeats whole. Of the distinct slices left, every string is counted.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                view, first = row["bytes"], row["first"]
                number = (row["place"] - first - np.arange(len(view) - length + 1)) // SLICE
                begins = np.flatnonzero(np.diff(number, prepend=number[0] + 1))
                sizes = np.diff(np.append(begins, len(number)))
                parts = [view[x : x + size + length - 1] for x, size in zip(begins.tolist(), sizes.tolist(), strict=True)]
                pair = np.frombuffer(b"".join(xxhash.xxh3_128_digest(part) for part in parts), "<i8").reshape(-1, 2)
                same = [np.full(len(parts), row[name]) for name in ("k1", "k2", "n")]
                columns = [*same, first + begins, pair[:, 0], pair[:, 1]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in columns] + [pa.array(parts, pa.binary())], ["k1", "k2", "n", "first", "s1", "s2", "bytes"]
                )

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places = len(row["bytes"]) - length + 1
                pair = _digests(memoryview(row["bytes"]), range(places), length)
                same = [np.full(places, row[name]) for name in ("k1", "k2", "n")]
                columns = [*same, row["first"] + np.arange(places), pair[:, 0], pair[:, 1]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["k1", "k2", "n", "first", "t1", "t2"])

    schema = "k1 long, k2 long, n long, first long, s1 long, s2 long, bytes binary"
    slices = contexts.mapInArrow(cut, schema)
    # The only occurrence of a slice that occurs once is the smallest one.
    one = F.min(F.struct("k1", "k2", "first", "bytes")).alias("one")
    counted = slices.groupBy("s1", "s2").agg(F.sum("n").alias("n"), one).select("s1", "s2", "n", "one.*")
    last = F.col("first") + F.octet_length("bytes") - length
    twice = counted.filter("n > 1").select("s1", "s2")
    whole = slices.filter("n = 1").join(twice, ["s1", "s2"], "left_semi").select("k1", "k2", "first", last.alias("last"))
    single = counted.select("k1", "k2", "n", "first", "bytes").mapInArrow(
        strings, "k1 long, k2 long, n long, first long, t1 long, t2 long"
    )
    again = single.groupBy("t1", "t2").agg(F.sum("n").alias("times")).filter("times > 1").drop("times")
    partly = single.filter("n = 1").join(again, ["t1", "t2"], "left_semi")
    return whole.unionByName(partly.select("k1", "k2", "first", F.col("first").alias("last")))


def repeated_places(docs: DataFrame, texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(k1, k2, first, last): runs of places of each text whose string starts anywhere else too; runs may come repeatedly."""
    found = occurrences(docs, length)
    # The only occurrence of a context that occurs once is the smallest one.
    one = F.min(F.struct("k1", "k2", "first", "last", "place", "anchor")).alias("one")
    counted = found.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n"), one)
    # Only contexts that occur again are looked up by their digest.
    digest = [F.when(F.col("n") > 1, F.col(name)).alias(name) for name in ("c1", "c2")]
    contexts = stored(counted.select(*digest, "n", "one.*"), "contexts")
    buckets = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts"), F.min("n").alias("least"))
    unsettled = stored(buckets.filter("contexts > 1 and least = 1").select("anchor", "contexts"), "buckets")
    few, many = unsettled.filter(F.col("contexts") <= LARGE_BUCKET), unsettled.filter(F.col("contexts") > LARGE_BUCKET)
    partly = _sorted_buckets(_context_rows(texts, contexts.join(few, "anchor"), length), length)
    if not many.isEmpty():
        large = _counted_slices(_context_rows(texts, contexts.join(many, "anchor"), length), length)
        partly = partly.unionByName(large)
    whole = found.select("c1", "c2", "k1", "k2", "first", "last").join(
        contexts.filter("n > 1").select("c1", "c2"), ["c1", "c2"], "left_semi"
    )
    return whole.select("k1", "k2", "first", "last").unionByName(partly)


def without_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with ``with_text`` the remaining bytes.

    Removed is every byte covered by a string of ``length`` bytes that starts anywhere else in the table too, in the same
    document or another, judged on the input. Null text counts as empty; shorter texts stay whole; the rows of a repeated
    text all lose what they share. What remains need not be valid UTF-8, so it is binary. Other columns are ignored.
    """
    texts = _keyed(docs).groupBy("k1", "k2").agg(F.max("text").alias("text"))
    spans = repeated_places(docs, texts, length)
    listed = spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("first", "last")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in chunks(offsets):
                part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                lists = batch.column("spans").slice(a, b - a)
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                owner, flat = np.repeat(np.arange(b - a), sizes), lists.flatten()
                first, last = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
                change = np.zeros(len(part) + 1, np.int64)
                np.add.at(change, cuts[owner] + first, 1)
                np.add.at(change, cuts[owner] + last + length, -1)
                gone = np.cumsum(change[:-1]) > 0
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                opens[cuts[:-1][np.diff(cuts) > 0]] = gone[cuts[:-1][np.diff(cuts) > 0]]
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[cuts])
                runs = np.diff(np.concatenate([[0], np.cumsum(opens)])[cuts])
                kept = memoryview(np.ascontiguousarray(part[~gone]))
                ends = np.concatenate([[0], np.cumsum(np.diff(cuts) - removed)]).tolist()
                left = [kept[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)]
                columns = [
                    batch.column("k1").slice(a, b - a),
                    batch.column("k2").slice(a, b - a),
                    pa.array(np.diff(cuts)),
                    pa.array(removed),
                    pa.array(runs),
                    pa.array([hashlib.sha256(x).hexdigest() for x in left], pa.string()),
                ]
                if with_text:
                    columns.append(pa.array([bytes(x) for x in left], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "k1 long, k2 long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    names = [field.split()[0] for field in schema.split(", ")]
    # Each distinct text is cut once; its rows are joined by the digest alone.
    cut = texts.join(listed, ["k1", "k2"], "left").select("k1", "k2", "text", "spans").mapInArrow(run, schema)
    rows = docs.select("doc_id", *_two_longs(F.md5(whole_text()), "k"))
    return rows.join(cut, ["k1", "k2"]).drop("k1", "k2")
