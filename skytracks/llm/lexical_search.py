"""Ranked lexical search of a set of items over all documents, with one score for all equal documents.

For the score a document is no more than its counts of the items' words and a number ``m`` made from its length. Documents
are therefore cut down to the items' vocabulary, and those with identical counts and ``m`` form a class: classes are found by
a hash and verified by content, scored once, and only those that win a place are expanded into their documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytracks.llm.tables import stored, whole_text
from skytracks.llm.textbytes import SliceHashes, chunks, ranges, text_bytes

TOP = 50
# Bits of the map of the vocabulary that tasks get, whatever the vocabulary's size: what passes by chance is only carried along.
MAP_BITS = 1 << 20
# Classes, and items, that are scored together.
CLASSES, ITEMS = 4096, 512
# Term and item pairs that a task lays out at a time.
PAIRS = 1 << 21

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """All terms in order: how many each text has, and the lower-case terms as a dictionary."""
    solid = np.concatenate([[False], _TERM[data], [False]])
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(solid[1:-1] & (~solid[:-2] | edge[:-1]))
    ends = np.flatnonzero(solid[1:-1] & (~solid[2:] | edge[1:])) + 1
    lengths = ends - starts
    places = np.concatenate([[0], np.cumsum(lengths)])
    words = _LOWER[data[ranges(starts, lengths)]] if len(starts) else data[:0]
    terms = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(words)])
    return np.diff(np.searchsorted(starts, offsets, "left")), terms.dictionary_encode()


def _slots(terms: pa.Array, bits: int) -> np.ndarray:
    """The bit of each term in the map of the vocabulary."""
    if not len(terms):
        return np.zeros(0, np.int64)
    data, offsets = np.frombuffer(terms.buffers()[2] or b"", np.uint8), np.frombuffer(terms.buffers()[1], np.int64)
    offsets = offsets[terms.offset : terms.offset + len(terms) + 1]
    return (SliceHashes(data).of(offsets[:-1], offsets[1:]) % np.uint64(bits)).astype(np.int64)


def _counted(rows: DataFrame, ids: list[str], known: np.ndarray | None) -> DataFrame:
    """``ids``, n (terms with repeats), terms and counts (distinct, ascending; those of the map only, where one is given)."""

    packed = None if known is None else np.packbits(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if packed is None else np.unpackbits(packed).astype(bool)
        for batch in batches:
            data, offsets = text_bytes(batch.column(len(ids)))
            for x, y in chunks(offsets):
                n, terms = _terms(data[offsets[x] : offsets[y]], offsets[x : y + 1] - offsets[x])
                codes, values = terms.indices.to_numpy().astype(np.int64), terms.dictionary
                passes = np.ones(len(values), bool) if known is None else known[_slots(values, len(known))]
                text = np.repeat(np.arange(y - x), n)[passes[codes]]
                order = pc.sort_indices(values).to_numpy()
                rank = np.empty(len(values), np.int64)
                rank[order] = np.arange(len(values))
                pairs, counts = np.unique(text * max(len(values), 1) + rank[codes[passes[codes]]], return_counts=True)
                text, at = np.divmod(pairs, max(len(values), 1))
                places = pa.array(np.searchsorted(text, np.arange(y - x + 1)), pa.int32())
                held = values.take(pa.array(order[at])).cast(pa.binary()).cast(pa.string())
                columns = [batch.column(c).slice(x, y - x) for c in range(len(ids))]
                columns += [pa.array(n, pa.int64()), pa.ListArray.from_arrays(places, held), pa.ListArray.from_arrays(places, pa.array(counts))]
                yield pa.RecordBatch.from_arrays(columns, [*ids, "n", "terms", "counts"])

    schema = ", ".join(f"{name} long" for name in ids) + ", n long, terms array<string>, counts array<long>"
    chosen = rows.select(*(F.col(name).cast("long").alias(name) for name in ids), whole_text().alias("text"))
    return chosen.mapInArrow(run, schema)


def _vocabulary_map(items: DataFrame, bits: int) -> np.ndarray:
    """A bit for each hash of a term of the items. At most ``bits`` / 32 numbers come to the driver, however many terms there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_slots(batch.column(0).cast(pa.large_string()).cast(pa.large_binary()), bits))], ["slot"])

    slots = items.select(F.explode("terms").alias("term")).distinct().mapInArrow(run, "slot long")
    words = slots.groupBy(F.expr("slot div 32").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 32 as int))")).alias("bits"))
    known = np.zeros(bits, bool)
    for word, held in words.toLocalIterator():
        known[word * 32 + np.flatnonzero((held >> np.arange(32)) & 1)] = True
    return known


def _class_hash() -> Column:
    return F.xxhash64("m", "terms", "counts")


def _classes(rows: DataFrame) -> DataFrame:
    """(class, first_id, hash, alone, m, terms, counts) of each class of ``rows``, which have their hash.

    Documents of one hash whose contents differ, which the least and the greatest of them show, are told apart by content; their
    classes are not ``alone`` under the hash.
    """
    content = F.struct("m", "terms", "counts")
    found = rows.groupBy("hash").agg(
        F.min(content).alias("low"), F.max(content).alias("high"), F.min("rid").alias("class"), F.min("doc_id").alias("first_id")
    )
    found = stored(found, "hashes")
    alone = found.filter("low = high").select("class", "first_id", "hash", F.lit(True).alias("alone"), "low.*")
    apart = rows.join(found.filter("low <> high").select("hash"), "hash", "left_semi")
    told = apart.groupBy("hash", "m", "terms", "counts").agg(F.min("rid").alias("class"), F.min("doc_id").alias("first_id"))
    return stored(alone.unionByName(told.withColumn("alone", F.lit(False))), "search_classes")


def _members(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, doc_id) of the documents of ``classes``."""
    alone = rows.select("hash", "doc_id").join(classes.filter("alone").select("hash", "class"), "hash")
    told = rows.join(classes.filter("not alone").select("hash", "m", "terms", "counts", "class"), ["hash", "m", "terms", "counts"])
    return alone.select("class", "doc_id").unionByName(told.select("class", "doc_id"))


def _flat(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Values of a column of lists and the lists' begins (one more than lists)."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]


def _best(classes: pa.Table, items: pa.Table, top: int) -> pa.Table:
    """(item, class, first_id, score): the best classes of a block for each item of a block."""
    terms, firsts = _flat(items.column("terms"))
    weights = _flat(items.column("weights"))[0].to_numpy()
    owner = np.repeat(np.arange(items.num_rows), np.diff(firsts))
    vocabulary = terms.dictionary_encode()
    order = np.argsort(vocabulary.indices.to_numpy(), kind="stable")
    owner, weights = owner[order], weights[order]
    lists = np.searchsorted(vocabulary.indices.to_numpy()[order], np.arange(len(vocabulary.dictionary) + 1))
    held, begins = _flat(classes.column("terms"))
    term = pc.index_in(held, vocabulary.dictionary).fill_null(-1).to_numpy()
    tf = _flat(classes.column("counts"))[0].to_numpy()
    of_class = np.repeat(np.arange(classes.num_rows), np.diff(begins))
    m = classes.column("m").to_numpy()
    # A document without an id comes after all others of its score.
    ids = classes.column("first_id").fill_null(np.iinfo(np.int64).max).to_numpy()
    known = term >= 0
    term, tf, of_class = term[known], tf[known], of_class[known]
    impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[of_class])
    width = lists[term + 1] - lists[term]
    reach = np.concatenate([[0], np.cumsum(np.bincount(of_class, width, classes.num_rows).astype(np.int64))])
    begins = np.searchsorted(of_class, np.arange(classes.num_rows + 1))
    best = [np.zeros(0, np.int64)] * 3  # item, class, score
    floor = np.zeros(items.num_rows, np.int64)
    for x, y in chunks(reach, PAIRS):
        part = slice(begins[x], begins[y])
        at = ranges(lists[term[part]], width[part])
        score = np.zeros((y - x) * items.num_rows, np.int64)
        np.add.at(score, np.repeat((of_class[part] - x) * items.num_rows, width[part]) + owner[at], np.repeat(impact[part], width[part]) * weights[at])
        cell = np.flatnonzero(score)
        row, item = np.divmod(cell, items.num_rows)
        score = score[cell]
        able = score >= floor[item]
        best = [np.concatenate(both) for both in zip(best, (item[able], row[able] + x, score[able]))]
        order = np.lexsort((ids[best[1]], -best[2], best[0]))
        best = [column[order] for column in best]
        place = np.arange(len(order)) - np.searchsorted(best[0], best[0])
        full = place == top - 1
        floor[best[0][full]] = best[2][full]
        best = [column[place < top] for column in best]
    return pa.table(
        {
            "item": items.column("item").take(pa.array(best[0])),
            "class": classes.column("class").take(pa.array(best[1])),
            "first_id": classes.column("first_id").take(pa.array(best[1])),
            "score": best[2],
        }
    )


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, bits: int = MAP_BITS, class_hash: Callable[[], Column] = _class_hash
) -> DataFrame:
    """The ``top`` documents of each item: item_id, rank, doc_id, score.

    ``docs`` has doc_id and text, ``items`` item_id and text. A term is a maximal run of ASCII letters and digits and of
    anything beyond ASCII, A-Z in lower case; null and empty texts have none. With N documents that have a term, L all their terms,
    n a document's and df the documents that hold a term: the weight of a term is floor(1000 ln((2N + 2) / (2df + 1))), m is
    50 + (50 n N div L), and the score is the sum of weight * ((10**9 tf) div (1000 tf + 20 m)) over the item's distinct terms.
    Only scores above 0 count; equal scores go by ascending doc_id, null last. Repeated rows of documents each take a place, and
    repeated rows of items are items of their own. An empty table gives an empty result; other columns are ignored.
    """
    wanted = items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id())
    wanted = stored(_counted(wanted, ["item", "item_id"], None).drop("n", "counts"), "search_items")
    known = _vocabulary_map(wanted, bits)
    rows = stored(_counted(docs, ["doc_id"], known).withColumn("rid", F.monotonically_increasing_id()), "search_docs")
    total, length = rows.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    length = max(length or 0, 1)
    m = (F.lit(50) + F.expr(f"(cast(50 * n as decimal(38, 0)) * {total}) div {length}")).cast("long")
    rows = rows.withColumn("m", m)
    held = rows.filter("size(terms) > 0").withColumn("hash", class_hash())
    classes = _classes(held)

    terms = wanted.select("item", F.explode("terms").alias("term"))
    lengths = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2.0 * total + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    weighed = terms.join(lengths, "term").withColumn("weight", weight).groupBy("item").agg(F.collect_list(F.struct("term", "weight")).alias("held"))
    weighed = stored(weighed.select("item", F.col("held.term").alias("terms"), F.col("held.weight").alias("weights")), "weighed_items")

    parts, groups = (max(1, -(-frame.count() // size)) for frame, size in ((classes, CLASSES), (weighed, ITEMS)))
    # Every class meets every item, block by block.
    left = classes.select("class", "first_id", "m", "terms", "counts").withColumn("part", F.pmod(F.xxhash64("class"), F.lit(parts))).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = weighed.withColumn("group", F.pmod(F.xxhash64("item"), F.lit(groups)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def scored(some: pa.Table, asked: pa.Table) -> pa.Table:
        if not some.num_rows or not asked.num_rows:
            return pa.table({name: pa.array([], pa.int64()) for name in ("item", "class", "first_id", "score")})
        return _best(some, asked, top)

    best = left.groupBy("part", "group").cogroup(right.groupBy("part", "group")).applyInArrow(scored, "item long, class long, first_id long, score long")
    best = best.withColumn("place", F.expr("row_number() over (partition by item order by score desc, first_id asc nulls last, class)"))
    best = stored(best.filter(F.col("place") <= top).select("item", "class", "score"), "best_classes")
    # Of a class no more than the first ``top`` documents can win.
    winners = stored(classes.join(best.select("class").distinct(), "class", "left_semi"), "winning_classes")
    winners = _members(held, winners).withColumn("copy", F.expr("row_number() over (partition by class order by doc_id asc nulls last)")).filter(F.col("copy") <= top)
    placed = best.join(winners, "class").withColumn("rank", F.expr("row_number() over (partition by item order by score desc, doc_id asc nulls last)"))
    return placed.filter(F.col("rank") <= top).join(wanted.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
