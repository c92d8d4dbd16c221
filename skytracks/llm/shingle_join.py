"""Exact Jaccard join of documents over word shingles, by T-occurrence search.

A text is the set of its shingles. Two texts can only link when one occurs in enough of the other's inverted lists, so:

* A text that has too many shingles to itself links with nothing. A fixed share of the shingles, chosen by value and
  therefore alike in all texts, shows this for nearly all texts in one aggregate; the rest is judged by whole sets.
* Texts that share one of their shortest lists are brought together: of ``n`` shingles the ``n - T + 1`` rarest must
  hold one that any partner has. Lists are linked as stars, never as pairs.
* Inside such a group, block by block, every text searches the inverted lists of the block by DivideSkip: its short lists
  are merged in order and counted, its longest ones are probed by binary search for the texts that can still reach T.

What comes out of a block is one row per text, the text's root there, not its pairs. A group of more than one block is
settled by one hub for each root, and then by the texts outside its largest component against all its blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytracks.llm.components import components
from skytracks.llm.tables import stored, whole_text
from skytracks.llm.textbytes import chunks, mixed, ranges, text_bytes
from skytracks.llm.words import Words, words_of

PERCENT = 85
WIDTH = 4
# One shingle in so many, by value, is looked at in the first pass.
SHARE = 4
# Shingles that a block of texts holds, about; one longer text is a block with others still.
BLOCK = 1 << 20
# Cost of a probe against that of a step of the merge, as in DivideSkip: long lists are T / (MU * log2(longest) + 1).
MU = 1.0

_ODD = np.random.default_rng(13).integers(1, 2**62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, ascending in each text, and where each text's begin (one more than texts).

    A text of fewer than ``width`` words has one shingle, all its words; a text without words has none.
    """
    counts = np.diff(words.firsts)
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    text = np.repeat(np.arange(words.texts), sizes)
    at = np.arange(begins[-1]) + np.repeat(words.firsts[:-1] - begins[:-1], sizes)
    left = np.repeat(words.firsts[1:], sizes) - at
    padded = np.concatenate([words.hashes, np.zeros(width, np.uint64)])
    found = np.zeros(len(at), np.uint64)
    for step in range(width):
        found += np.where(left > step, padded[at + step] * _ODD[step % len(_ODD)] + np.uint64(step + 1), np.uint64(0))
    found = mixed(found)
    order = np.lexsort((found, text))
    text, found = text[order], found[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (found[1:] != found[:-1])
    return found[new], np.searchsorted(text[new], np.arange(words.texts + 1))


def _set_digests(shingles: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    halves = []
    for salt in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(shingles ^ salt), dtype=np.uint64)])
        halves.append(mixed(sums[begins[1:]] - sums[begins[:-1]] + salt).view(np.int64))
    return halves[0], halves[1]


def _key() -> Column:
    return F.unhex(F.md5(whole_text()))


def _sketched(docs: DataFrame, width: int, share: int) -> DataFrame:
    """(doc_id, key, a, b, n, sample): digest of the text, digests and size of its set, the shingles of the share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for x, y in chunks(offsets):
                words = words_of(data[offsets[x] : offsets[y]], offsets[x : y + 1] - offsets[x])
                shingles, begins = shingle_sets(words, width)
                chosen = np.flatnonzero(shingles % np.uint64(share) == 0)
                places = pa.array(np.searchsorted(chosen, begins), pa.int32())
                sample = pa.ListArray.from_arrays(places, pa.array(shingles[chosen].view(np.int64)))
                columns = [
                    batch.column(0).slice(x, y - x),
                    batch.column(1).slice(x, y - x),
                    *(pa.array(half) for half in _set_digests(shingles, begins)),
                    pa.array(np.diff(begins), pa.int64()),
                    sample,
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "a", "b", "n", "sample"])

    schema = T.StructType().add("doc_id", docs.schema["doc_id"].dataType).add("key", "binary")
    for name in ("a", "b", "n"):
        schema = schema.add(name, "long")
    schema = schema.add("sample", T.ArrayType(T.LongType()))
    return docs.select("doc_id", _key().alias("key"), "text").mapInArrow(run, schema)


def _needed(percent: int, size: str = "n") -> Column:
    """The least number of shingles that a set shares with any partner."""
    return F.expr(f"({percent} * {size} + 99) div 100")


def _near_sets(docs: DataFrame, sketch: DataFrame, percent: int, width: int) -> DataFrame:
    """(sid, a, b, n, shingles) of the distinct sets that do not have too many sampled shingles to themselves."""
    some = sketch.filter("n > 0")
    holders = some.select("a", F.explode("sample").alias("shingle")).groupBy("shingle").agg(F.min("a").alias("a"), F.max("a").alias("last"))
    own = holders.filter("a = last").groupBy("a").agg(F.count(F.lit(1)).alias("own"))
    sets = some.groupBy("a", "b", "n").agg(F.min("key").alias("key")).join(own, "a", "left")
    near = stored(sets.filter(F.coalesce("own", F.lit(0)) <= F.col("n") - _needed(percent)).select("key", "a", "b", "n"), "near_sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for x, y in chunks(offsets):
                words = words_of(data[offsets[x] : offsets[y]], offsets[x : y + 1] - offsets[x])
                shingles, begins = shingle_sets(words, width)
                whole = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(shingles.view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(x, y - x) for c in ("a", "b", "n")), whole], ["a", "b", "n", "shingles"])

    # Copies of a text are dropped before the shuffle, so a text that a third of all rows hold is one row a task.
    texts = docs.select(_key().alias("key"), whole_text().alias("text")).groupBy("key").agg(F.first("text").alias("text"))
    whole = texts.join(near, "key").mapInArrow(run, "a long, b long, n long, shingles array<long>")
    return stored(whole.withColumn("sid", F.monotonically_increasing_id()), "whole_sets")


def _listed_together(sets: DataFrame, percent: int) -> DataFrame:
    """(sid, group) of the sets that share a short list with another, directly or by way of others."""
    rows = sets.select("sid", "n", F.explode("shingles").alias("shingle"))
    lists = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("length")).filter("length > 1")
    shared = rows.join(lists, "shingle")
    ranked = shared.selectExpr(
        "*",
        "row_number() over (partition by sid order by length, shingle) as place",
        "count(*) over (partition by sid) as have",
    )
    short = stored(ranked.filter(F.col("place") <= F.col("have") - _needed(percent) + 1).select("shingle", "sid"), "short_lists")
    first = short.groupBy("shingle").agg(F.min("sid").alias("a"))
    found = components(short.join(first, "shingle").select("a", F.col("sid").alias("b")))
    return found.select(F.col("node").alias("sid"), F.col("component").alias("group"))


class _Lists:
    """Inverted lists of a block: its sets numbered by size, and for each shingle the numbers of the sets that hold it."""

    def __init__(self, shingles: np.ndarray, begins: np.ndarray):
        sizes = np.diff(begins)
        self.order = np.argsort(sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.count = len(sizes)
        self.shingles, self.begins = shingles, begins
        number = np.empty(self.count, np.int64)
        number[self.order] = np.arange(self.count)
        self.values, at = np.unique(shingles, return_inverse=True)
        # One sorted array for all lists: list by list, numbers ascending.
        self.postings = np.sort(at * self.count + np.repeat(number, sizes))

    def set_of(self, number: int) -> np.ndarray:
        row = self.order[number]
        return self.shingles[self.begins[row] : self.begins[row + 1]]

    def search(self, shingles: np.ndarray, least: int, low: int, high: int, percent: int) -> np.ndarray:
        """Numbers from ``low`` up to ``high`` of the sets that link with ``shingles``; each shares ``least`` or more."""
        size = len(shingles)
        place = np.searchsorted(self.values, shingles)
        place[place == len(self.values)] = 0
        place = place[self.values[place] == shingles]
        begin = np.searchsorted(self.postings, place * self.count + low)
        length = np.searchsorted(self.postings, place * self.count + high) - begin
        held = length > 0
        place, begin, length = place[held], begin[held], length[held]
        if len(place) < least:
            return place[:0]
        order = np.argsort(length, kind="stable")
        place, begin, length = place[order], begin[order], length[order]
        long = min(least - 1, int(least / (MU * np.log2(length[-1] + 1) + 1)))
        short = len(place) - long
        # The short lists are sorted runs: a stable sort merges them.
        run = ranges(begin[:short], length[:short])
        merged = np.sort(self.postings[run] - np.repeat(place[:short] * self.count, length[:short]), kind="stable")
        start = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
        found, times = merged[start], np.diff(np.append(start, len(merged)))
        # The shortest of the long lists come first, and what cannot reach the count any more is left out between steps.
        done = 0
        while True:
            able = times + (long - done) >= least
            found, times = found[able], times[able]
            if done == long or not len(found):
                break
            step = place[short + done : short + done + max(1, (1 << 16) // len(found))]
            probes = step[:, None] * self.count + found
            at = np.minimum(np.searchsorted(self.postings, probes), len(self.postings) - 1)
            times = times + (self.postings[at] == probes).sum(axis=0)
            done += len(step)
        return found[100 * times >= percent * (size + self.sizes[found] - times)]


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, shingles and their begins of a block's sets."""
    lists = table.column("shingles").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint64)
    return table.column("sid").to_numpy(), values, offsets - offsets[0]


def _rooted(table: pa.Table, percent: int) -> pa.Table:
    """(sid, root, hub) for the sets of a block: the smallest id they are connected with there, the best linked set of each root."""
    ids, shingles, begins = _columns(table)
    lists = _Lists(shingles, begins)
    names = ids[lists.order]
    root = names.copy()
    degree = np.zeros(len(names), np.int64)
    for number in range(len(names)):
        size = int(lists.sizes[number])
        high = int(np.searchsorted(lists.sizes, size * 100 // percent, "right"))
        if (root[number + 1 : high] == root[number]).all():
            continue
        # No smaller partner is looked for, and a partner of the same size shares the least.
        least = -(-2 * percent * size // (100 + percent))
        for_this = lists.search(lists.set_of(number), least, number + 1, high, percent)
        degree[number] += len(for_this)
        degree[for_this] += 1
        met = np.unique(root[for_this])
        if len(met):
            met = np.unique(np.append(met, root[number]))
            root[np.isin(root, met[1:])] = met[0]
    order = np.lexsort((names, -degree, root))
    hub = np.zeros(len(names), bool)
    hub[order] = np.concatenate([[True], root[order][1:] != root[order][:-1]])
    return pa.table({"sid": names, "root": root, "hub": hub})


def _across(asking: pa.Table, block: pa.Table, percent: int) -> pa.Table:
    """(sid, root): links that join components of the asking sets with those of a block, no more than there are components."""
    if not asking.num_rows or not block.num_rows:
        return pa.table({"sid": np.zeros(0, np.int64), "root": np.zeros(0, np.int64)})
    ids, shingles, begins = _columns(asking)
    names, held, starts = _columns(block)
    lists = _Lists(held, starts)
    names = names[lists.order]
    component = block.column("component").to_numpy()[lists.order].copy()
    own = asking.column("component").to_numpy().copy()
    links = []
    for row in range(len(ids)):
        size = int(begins[row + 1] - begins[row])
        least = -(-percent * size // 100)
        low = int(np.searchsorted(lists.sizes, least, "left"))
        high = int(np.searchsorted(lists.sizes, size * 100 // percent, "right"))
        if (component[low:high] == own[row]).all():
            continue
        found = lists.search(shingles[begins[row] : begins[row + 1]], least, low, high, percent)
        met, first = np.unique(component[found], return_index=True)
        for other, at in zip(met.tolist(), first.tolist()):
            if other != own[row]:
                links.append((int(ids[row]), int(names[found[at]])))
                old = own[row]
                component[component == old] = other
                own[own == old] = other
    return pa.table({"sid": np.array([x for x, _ in links], np.int64), "root": np.array([x for _, x in links], np.int64)})


def _blocks_of(total: Column, block: int) -> Column:
    return F.ceil(total / F.lit(block)).cast("int")


def _dealt(sid: str, blocks: str) -> Column:
    return F.pmod(F.xxhash64(sid), F.col(blocks)).cast("int")


def _linked(listed: DataFrame, percent: int, block: int) -> DataFrame:
    """(sid, component) of the sets that link with another; ``listed`` has sid, group, n and shingles."""
    sums = listed.groupBy("group").agg(F.sum("n").alias("total")).withColumn("blocks", _blocks_of(F.col("total"), block))
    small = sums.filter("blocks = 1").agg(F.sum("total")).first()[0] or 0
    bins = F.lit(max(1, -(-small // block)))
    # Small groups share blocks; nothing is lost if sets of two groups meet.
    placed = listed.join(sums, "group").withColumn("large", F.col("blocks") > 1)
    placed = placed.withColumn("home", F.when(F.col("large"), F.col("group")).otherwise(-1))
    spot = F.when(F.col("large"), _dealt("sid", "blocks")).otherwise(F.pmod(F.xxhash64("group"), bins).cast("int"))
    placed = stored(placed.select("sid", "group", "n", "shingles", "blocks", "large", "home", spot.alias("spot")), "placed_sets")

    def rooted(table: pa.Table) -> pa.Table:
        return _rooted(table, percent)

    def across(asking: pa.Table, found: pa.Table) -> pa.Table:
        return _across(asking, found, percent)

    held = placed.select("home", "spot", "sid", "shingles")
    local = stored(held.groupBy("home", "spot").applyInArrow(rooted, "sid long, root long, hub boolean"), "local_roots")
    links = local.filter("sid <> root").select(F.col("root").alias("a"), F.col("sid").alias("b"))
    large = placed.filter("large")
    if not large.isEmpty():
        hubs = large.join(local.filter("hub").select("sid"), "sid")
        some = hubs.groupBy("group").agg(_blocks_of(F.sum("n"), block).alias("hub_blocks"))
        dealt = hubs.join(some, "group").select("group", _dealt("sid", "hub_blocks").alias("spot"), "sid", "shingles")
        met = dealt.groupBy("group", "spot").applyInArrow(rooted, "sid long, root long, hub boolean")
        links = stored(links.unionByName(met.filter("sid <> root").select(F.col("root").alias("a"), F.col("sid").alias("b"))), "links")
        known = components(links).select(F.col("node").alias("sid"), "component")
        named = large.join(known, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
        sizes = named.groupBy("group", "component").agg(F.count(F.lit(1)).alias("rows"))
        main = sizes.groupBy("group").agg(F.max(F.struct("rows", "component")).alias("main"))
        named = stored(named.join(main, "group").withColumn("outside", F.col("component") != F.col("main.component")).drop("main"), "named_sets")
        asking = named.filter("outside")
        turns = asking.groupBy("group").agg(_blocks_of(F.sum("n"), block).alias("turns"))
        asking = asking.join(turns, "group").withColumn("turn", _dealt("sid", "turns"))
        asking = asking.withColumn("spot", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        asked = named.join(turns, "group").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
        columns = ["group", "turn", "spot", "sid", "component", "shingles"]
        # Both sides come from one table: toDF gives their columns names of their own.
        sides = [side.select(*columns).toDF(*columns).groupBy("group", "turn", "spot") for side in (asking, asked)]
        more = sides[0].cogroup(sides[1]).applyInArrow(across, "sid long, root long")
        links = links.unionByName(more.select(F.col("root").alias("a"), F.col("sid").alias("b")))
    return components(links).select(F.col("node").alias("sid"), "component")


def shingle_components(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, share: int = SHARE, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents link when 100 times the shingles they share reach ``percent`` times those of either. ``component_id`` is
    the smallest doc_id that links lead to, itself included (nulls aside; null where all are null). Words are compared with
    A-Z in lower case, shingles by 64-bit hashes. A text of fewer than ``width`` words is one shingle, the whole
    sequence. Null and empty texts and texts without words have no shingle and link with nothing. Repeated rows link like any equal
    texts; every row has a row in the result. An empty table gives an empty result; other columns are ignored.
    """
    sketch = stored(_sketched(docs, width, share), "shingle_sketch")
    sets = _near_sets(docs, sketch, percent, width)
    grouped = _listed_together(sets, percent)
    listed = stored(sets.select("sid", "n", "shingles").join(grouped, "sid"), "listed_sets")
    linked = sets.select("sid", "a", "b", "n").join(_linked(listed, percent, block), "sid")
    # Equal sets are one set from here on; the copies of a hot one meet in the map tasks.
    least = sketch.filter("n > 0").groupBy("a", "b", "n").agg(F.min("doc_id").alias("least"))
    named = stored(least.join(linked.select("a", "b", "n", "component"), ["a", "b", "n"], "left"), "named_sets")
    lowest = named.filter("component is not null").groupBy("component").agg(F.min("least").alias("lowest"))
    ids = named.join(lowest, "component", "left").select("a", "b", "n", F.coalesce("lowest", "least").alias("component_id"))
    found = sketch.select("doc_id", "a", "b", "n").join(ids, ["a", "b", "n"], "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
