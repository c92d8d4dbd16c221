"""Near-duplicate documents by BagMinHash over five-word shingles.

A document is the bag of its shingles, weighted by how often each occurs. Every shingle drives Poisson processes, one for
each dyadic stretch (0, 1], (1, 2], (2, 4], ... of the weight axis, with points at the rate of the stretch's width. A
point has a time, a component, and a level inside its stretch; it counts for a document when the level does not exceed the
shingle's weight there. Equal shingles have equal points in all documents, and the earliest point of each component is
equal in two documents with probability of their weighted Jaccard similarity. Points come in order of time, so nearly
all shingles stop at their first point, past the time by which every component is filled.

Components are banded. Documents that share a band are candidates; exact copies have been made one before. In every
bucket all documents are compared with one pivot first, by their whole bags; what that connects need not be compared
again. Members of a bucket that are in different groups then are compared with its most central member, and at last with each
other, where their similarity could be high enough: shingles that no other candidate has bound it from above, exactly, which
leaves out the many pairs of a large loose group that cannot reach the limit, and no pair that can.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytracks.llm.components import components
from skytracks.llm.tables import Scratch, stored, whole_text
from skytracks.llm.textbytes import chunks, mixed, text_bytes
from skytracks.llm.words import words_of

SIMILARITY = 0.8
# A pair shares a band with probability 1 - (1 - s ** 7) ** 32: 0.9995 at a similarity of 0.8, 0.05 at 0.4.
BANDS, ROWS = 32, 7

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _unit(values: np.ndarray) -> np.ndarray:
    """Hashes as numbers in (0, 1]."""
    return ((values >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def bags(shingles: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) of all texts' distinct shingles, in order of text and shingle."""
    text = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    order = np.lexsort((shingles, text))
    text, shingles = text[order], shingles[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (shingles[1:] != shingles[:-1])
    at = np.flatnonzero(new)
    return text[at], shingles[at], np.diff(np.append(at, len(text)))


def signatures(text: np.ndarray, shingle: np.ndarray, weight: np.ndarray, texts: int, size: int) -> np.ndarray:
    """BagMinHash: the time of the earliest point of each component, as bits; a row per text.

    Texts without shingles have rows of the largest value.
    """
    total = np.bincount(text, weight, texts)
    # The time by which all components are filled, but for one text in about twenty, which are run on.
    limit = size / np.maximum(total, 1) * (np.log(size) + 3)
    # One row per shingle and stretch that its weight reaches into.
    top = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    row = np.repeat(np.arange(len(text)), top + 1)
    stretch = np.arange(len(row)) - np.repeat(np.cumsum(top + 1) - (top + 1), top + 1)
    low = np.where(stretch == 0, 0, 2.0 ** (stretch - 1))
    width = np.where(stretch == 0, 1.0, low)
    owner, reach = text[row], weight[row]
    state = mixed(shingle[row] ^ (stretch.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
    time = -np.log(_unit(mixed(state))) / width
    best = np.full(texts * size, np.inf)
    open_rows = np.arange(len(row))
    while len(open_rows):
        live = open_rows[time[open_rows] < limit[owner[open_rows]]]
        while len(live):
            point = mixed(state[live] + np.uint64(0x632BE59BD9B4E019))
            level = np.floor(low[live] + _unit(mixed(point ^ _STEP)) * width[live] - 1e-12) + 1
            valid = level <= reach[live]
            slot = owner[live] * size + (point % np.uint64(size)).astype(np.int64)
            np.minimum.at(best, slot[valid], time[live][valid])
            state[live] += _STEP
            time[live] += -np.log(_unit(mixed(state[live]))) / width[live]
            live = live[time[live] < limit[owner[live]]]
        unfilled = np.isinf(best.reshape(texts, size)).any(axis=1) & (total > 0)
        open_rows = open_rows[unfilled[owner[open_rows]]]
        limit[unfilled] *= 2
    return best.reshape(texts, size).view(np.uint64)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per text and band."""
    keys = np.zeros((len(signature), bands), np.uint64)
    for row in range(rows):
        keys = mixed(keys * _STEP + signature.reshape(len(signature), bands, rows)[:, :, row])
    return keys


def similarities(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the shingle bags of each pair of texts; 1 where both are empty."""
    count = len(left)
    parts = []
    for column in (left, right):
        shingles, begins = words_of(*text_bytes(column)).shingles()
        parts.append(bags(shingles, begins))
    owner = np.concatenate([parts[0][0], parts[1][0]])
    shingle = np.concatenate([parts[0][1], parts[1][1]])
    weight = np.concatenate([parts[0][2], parts[1][2]]).astype(np.float64)
    order = np.lexsort((shingle, owner))
    owner, shingle, weight = owner[order], shingle[order], weight[order]
    same = (owner[1:] == owner[:-1]) & (shingle[1:] == shingle[:-1])
    both = np.bincount(owner[1:][same], np.minimum(weight[1:], weight[:-1])[same], count)
    total = np.bincount(owner, weight, count)
    return np.where(total > 0, both / np.maximum(total - both, 1e-300), 1.0)


def _digest():
    """Equal whole texts have equal digests; null counts as empty."""
    return F.unhex(F.md5(whole_text()))


def sketched(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(digest, weight, keys) per distinct text: number of shingles and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in chunks(offsets):
                words = words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                shingles, begins = words.shingles()
                signature = signatures(*bags(shingles, begins), b - a, bands * rows)
                keys = band_keys(signature, bands, rows).astype("<u8").view(np.int64)
                places = pa.array(np.arange(0, (b - a + 1) * bands, bands), pa.int32())
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array(np.diff(begins), pa.int64()),
                    pa.ListArray.from_arrays(places, pa.array(keys.reshape(-1))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["digest", "weight", "keys"])

    each = docs.select(_digest().alias("digest"), "text").mapInArrow(run, "digest binary, weight long, keys array<long>")
    return each.groupBy("digest").agg(F.first("weight").alias("weight"), F.first("keys").alias("keys"))


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    left = texts.select(F.col("digest").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("digest").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [text_bytes(batch.column(name))[1] for name in ("text_a", "text_b")]
            for x, y in chunks(sizes[0] + sizes[1]):
                part = batch.slice(x, y - x)
                close = similarities(part.column("text_a"), part.column("text_b")) >= similarity
                yield part.select(["a", "b"]).filter(pa.array(close))

    return pairs.join(right, "b").join(left, "a").mapInArrow(run, "a binary, b binary")


def _shared_weight(texts: DataFrame, contended: DataFrame) -> DataFrame:
    """(digest, own): the weight of the shingles that no other of the contended texts has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for a, b in chunks(offsets):
                words = words_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                text, shingle, weight = bags(*words.shingles())
                keys = [batch.column(name).to_numpy()[text + a] for name in ("d1", "d2")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle.view(np.int64)), pa.array(weight), *(pa.array(key) for key in keys)],
                    ["shingle", "weight", "d1", "d2"],
                )

    halves = [F.conv(F.substring(F.hex("digest"), at, 16), 16, -10).cast("long") for at in (1, 17)]
    keyed = texts.join(contended, "digest", "left_semi").select("text", halves[0].alias("d1"), halves[1].alias("d2"))
    shingles = keyed.mapInArrow(run, "shingle long, weight long, d1 long, d2 long")
    # Of a shingle with one text the largest key is that text's.
    alone = shingles.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("texts"), F.sum("weight").alias("weight"), F.max("d1").alias("d1"), F.max("d2").alias("d2")
    )
    own = alone.filter("texts = 1").groupBy("d1", "d2").agg(F.sum("weight").alias("own"))
    named = contended.select("digest", halves[0].alias("d1"), halves[1].alias("d2"))
    return named.join(own, ["d1", "d2"]).select("digest", "own")


def _pivot_pairs(buckets: DataFrame, central, similarity: float) -> DataFrame:
    """Each member of a bucket with the bucket's pivot, its most ``central`` one, where the two are not in one group yet."""
    pivots = buckets.groupBy("band", "key").agg(F.max(F.struct(central.alias("central"), "digest", "group", "weight")).alias("pivot"))
    met = buckets.join(pivots, ["band", "key"]).filter("group <> pivot.group")
    weight = F.col("pivot.weight")
    fits = F.least("weight", weight) >= similarity * F.greatest(F.col("weight"), weight)
    return _ordered(met.filter(fits), F.col("pivot.digest"))


def _with_most(buckets: DataFrame, own: DataFrame, similarity: float) -> DataFrame:
    """Members that can still be similar to another, with ``most``, the weight they can share at all."""
    known = buckets.join(own, "digest", "left").withColumn("most", F.col("weight") - F.coalesce("own", F.lit(0)))
    return known.filter(F.col("most") >= similarity * F.col("weight")).select("band", "key", "digest", "group", "weight", "most")


def _remaining_pairs(known: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """Members of one bucket that are in different groups and could be similar enough.

    What two texts share is at most what either shares with any other candidate. A pair that shares several bands is made
    in the first of them only.
    """
    known = known.join(sketches.select("digest", "keys"), "digest").withColumn("keys", F.slice("keys", 1, F.col("band")))
    other = known.select("band", "key", *(F.col(c).alias(f"{c}_b") for c in ("digest", "group", "weight", "most", "keys")))
    earlier = F.exists(F.zip_with("keys", "keys_b", lambda x, y: x == y), lambda same: same)
    both = F.least("most", "most_b")
    could = both >= similarity * (F.col("weight") + F.col("weight_b") - both)
    return _ordered(known.join(other, ["band", "key"]).filter((F.col("group") < F.col("group_b")) & could & ~earlier), F.col("digest_b"))


def _ordered(met: DataFrame, other) -> DataFrame:
    return met.select(F.least("digest", other).alias("a"), F.greatest("digest", other).alias("b")).distinct()


def near_groups(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(digest, group) of every distinct text that is linked to another: groups are connected by similar pairs."""
    with Scratch() as scratch:
        sketches = scratch.stored(sketched(docs, bands, rows), "sketches")
        rows_of = sketches.filter("weight > 0").select("digest", "weight", F.posexplode("keys").alias("band", "key"))
        shared = rows_of.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        buckets = scratch.stored(rows_of.join(shared, ["band", "key"]), "buckets")
        met = buckets.select("digest").distinct()
        texts = docs.select(_digest().alias("digest"), whole_text().alias("text"))
        texts = scratch.stored(texts.groupBy("digest").agg(F.max("text").alias("text")).join(met, "digest", "left_semi"), "near_texts")
        grouped, groups, tried, own = buckets.withColumn("group", F.col("digest")), None, None, None
        steps = (
            # Any pivot first: most buckets are small and settled by it.
            lambda found: _pivot_pairs(found, F.xxhash64("digest"), similarity),
            # Then the member with the least of its own, which is nearest to what a group of copies was made from.
            lambda found: _pivot_pairs(_with_most(found, own, similarity), F.col("most") / F.col("weight"), similarity),
            lambda found: _remaining_pairs(_with_most(found, own, similarity), sketches, similarity),
        )
        for step in steps:
            if groups is not None and own is None:
                own = scratch.stored(_shared_weight(texts, grouped.select("digest").distinct()), "own_weight")
            pairs = scratch.stored(step(grouped) if tried is None else step(grouped).join(tried, ["a", "b"], "left_anti"), "near_pairs")
            if groups is not None and pairs.isEmpty():
                continue
            tried = pairs if tried is None else tried.unionByName(pairs)
            links = _verified(pairs, texts, similarity)
            if groups is not None:
                links = links.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b")))
            groups = stored(components(links), "near_groups")
            named = groups.select(F.col("node").alias("digest"), F.col("component").alias("group"))
            grouped = buckets.join(named, "digest", "left").withColumn("group", F.coalesce("group", "digest"))
            apart = grouped.groupBy("band", "key").agg(F.min("group").alias("x"), F.max("group").alias("y")).filter("x <> y")
            grouped = grouped.join(apart.select("band", "key"), ["band", "key"])
    return groups.select(F.col("node").alias("digest"), F.col("component").alias("group"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept.

    Documents are in one class when a chain of pairs leads from one to the other, each pair with a weighted Jaccard
    similarity of shingles of at least ``similarity``. ``class_id`` is the smallest doc_id of the class (nulls aside) and
    that document stays; of repeated rows one does. Words are compared with A-Z in lower case. A text of one to four
    words is one shingle; null text counts as empty, and texts without words are in one class when equal. A document
    alone is a class of one. Other columns are ignored.
    """
    groups = near_groups(docs, similarity, bands, rows)
    rows_of = docs.select("doc_id", _digest().alias("digest")).groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("rows"))
    named = rows_of.join(groups, "digest", "left").withColumn("group", F.coalesce("group", "digest"))
    classes = named.groupBy("group").agg(F.min("doc_id").alias("class_id"), F.sum("rows").alias("class_size"))
    # The smallest id may stand before several texts of the class: the smallest digest of them stays.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest"))
    stays = named.groupBy("group").agg(first.alias("stays")).select("group", "stays")
    joined = named.join(classes.join(stays, "group"), "group")
    copies = joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    same = F.col("doc_id").eqNullSafe(F.col("stays.doc_id")) & (F.col("digest") == F.col("stays.digest"))
    return copies.select("doc_id", "class_id", "class_size", (same & (F.col("copy") == 1)).alias("kept"), "digest")


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, with all its columns; of repeated rows the smallest by the other columns."""
    stay = near_duplicates(docs, similarity).filter("kept").select(F.col("doc_id").alias("__id"), F.col("digest").alias("__of"))
    rows_of = docs.withColumn("__digest", _digest())
    kept = rows_of.join(stay, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__of")), "left_semi")
    others = [name for name in docs.columns if name != "doc_id"]
    one = kept.groupBy("doc_id", "__digest").agg(F.min(F.struct(*others)).alias("__row"))
    return one.select(*(F.col("doc_id") if name == "doc_id" else F.col(f"__row.`{name}`") for name in docs.columns))
