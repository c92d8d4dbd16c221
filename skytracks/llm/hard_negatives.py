"""Hard negatives by threshold joins over an inverted index, after L2AP.

Anchors meet all rows block by block. In a block the dimensions are put in order of their energy, smallest first, and
rows are indexed from the first strip of dimensions on at which their leading part, by the bound of its norm, could lift a
score to the threshold; what lies before is left out of the index. Scores are summed strip by strip from the largest
dimensions down, pairs whose score and remaining norms cannot reach the anchor's threshold are dropped on the way, and what
is left is completed with the dimensions that the index omits.

Thresholds start high and are lowered, for the anchors whose windows are not full yet, until they are full or cannot be.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytracks.llm.tables import stored

POSITIVES, NEGATIVES = 5, 3
# A negative's score lies between these percentages of the positive's.
LOW, HIGH = 50, 95
# Thresholds of the rounds: shares of the largest score that norms allow for positives, of the smallest positive's score for negatives.
POSITIVE_LEVELS = (0.35, 0.15, 0.0)
NEGATIVE_LEVELS = (0.8, 0.0)
# Rows and anchors that meet in a task.
ROWS, ANCHORS = 2048, 1024
# Dimensions that are summed between two prunings.
STRIP = 8
# Sums of integers below this are exact as doubles.
_EXACT = 2.0**53


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones go on with zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    sizes = np.diff(offsets)
    if (sizes == width).all():
        return values.reshape(len(sizes), width).astype(np.int64)
    found = np.zeros((len(sizes), width), np.int64)
    found[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return found


def _widest(*columns: pa.ChunkedArray) -> int:
    sizes = [int(np.diff(chunk.offsets.to_numpy()).max(initial=0)) for column in columns for chunk in column.chunks]
    return max(sizes, default=0)


class _Index:
    """Strips of dimensions of a block's rows, with the rows that are listed in each; rows are in order of their first strip."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray, least: float):
        self.dims = np.argsort((rows * rows).sum(axis=0), kind="stable")
        rows, anchors = rows[:, self.dims], anchors[:, self.dims]
        self.edges = [*range(0, rows.shape[1], STRIP), rows.shape[1]]
        lead, reach = self.leading(rows), self.leading(anchors).max(axis=0)
        # The first strip with which the leading part may reach the least threshold; no strip if none does.
        may = _loose(lead[:, 1:] * reach[1:]) >= least
        first = np.where(may.any(axis=1), may.argmax(axis=1), len(self.edges) - 1)
        self.order = np.argsort(first, kind="stable")
        self.first, self.rows, self.lead = first[self.order], rows[self.order], lead[self.order]
        self.listed = np.searchsorted(self.first, np.arange(len(self.edges)), "right")

    def leading(self, matrix: np.ndarray) -> np.ndarray:
        """Norms of the dimensions before each edge."""
        squares = np.concatenate([np.zeros((len(matrix), 1)), np.cumsum(matrix * matrix, axis=1)], axis=1)
        return np.sqrt(squares[:, self.edges])

    def at_least(self, anchors: np.ndarray, thresholds: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of the allowed pairs whose score reaches the anchor's threshold."""
        anchors, alive = anchors[:, self.dims], allowed[:, self.order]
        lead = self.leading(anchors)
        score = np.zeros(alive.shape)
        alive[:, self.listed[-2] :] = False
        for strip in range(len(self.edges) - 2, -1, -1):
            rows, dims = self.listed[strip], slice(self.edges[strip], self.edges[strip + 1])
            if not rows or not alive[:, :rows].any():
                continue
            score[:, :rows] += anchors[:, dims] @ self.rows[:rows, dims].T
            # What is still to come: the dimensions before this strip.
            rest = lead[:, strip, None] * self.lead[None, :rows, strip]
            alive[:, :rows] &= score[:, :rows] + _loose(rest) >= thresholds[:, None]
        anchor, row = np.nonzero(alive)
        found = score[anchor, row]
        # Dimensions that are not in the index.
        for strip in range(int(self.first[row].max(initial=0))):
            dims = slice(self.edges[strip], self.edges[strip + 1])
            part = np.flatnonzero(self.first[row] > strip)
            found[part] += np.einsum("ij,ij->i", anchors[anchor[part], dims], self.rows[row[part], dims])
        keep = found >= thresholds[anchor]
        return anchor[keep], self.order[row[keep]], found[keep].astype(np.int64)


def _loose(bound: np.ndarray) -> np.ndarray:
    """Bounds of sums, with room for the rounding of square roots."""
    return bound * (1 + 1e-9) + 1


def _exact_pairs(rows: np.ndarray, anchors: np.ndarray, thresholds: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same pairs for numbers too large for doubles, in whole numbers of any size; scores beyond 64 bits become the nearest."""
    product = anchors.astype(object) @ rows.astype(object).T
    score = np.clip(product, -(2**63), 2**63 - 1).astype(np.int64)
    anchor, row = np.nonzero(allowed & (score >= thresholds[:, None]))
    return anchor, row, score[anchor, row]


def _wanted(rows: pa.Table, anchors: pa.Table, same: bool, take: int) -> pa.Table:
    """(anchor, slot, row, vec_id, score): for each window of each anchor of a block its best rows in a block.

    Windows are the scores from ``lows`` to ``highs`` of an anchor's slots; rows below its threshold stay out.
    """
    names = ("anchor", "slot", "row", "vec_id", "score")
    if not rows.num_rows or not anchors.num_rows:
        return pa.table({name: pa.array([], pa.int64()) for name in names})
    width = _widest(rows.column("vector"), anchors.column("vector"))
    left, right = _matrix(rows.column("vector"), max(width, 1)), _matrix(anchors.column("vector"), max(width, 1))
    thresholds = anchors.column("threshold").to_numpy().astype(np.int64)
    equal = anchors.column("label").to_numpy()[:, None] == rows.column("label").to_numpy()
    allowed = (equal if same else ~equal) & (anchors.column("rid").to_numpy()[:, None] != rows.column("rid").to_numpy())
    doubles = [side.astype(np.float64) for side in (left, right)]
    if np.prod([np.sqrt((side * side).sum(axis=1).max()) for side in doubles]) < _EXACT:
        found = _Index(*doubles, float(thresholds.min())).at_least(doubles[1], thresholds.astype(np.float64), allowed)
    else:
        found = _exact_pairs(left, right, thresholds, allowed)
    anchor, row, score = found
    ids = rows.column("vec_id").fill_null(np.iinfo(np.int64).max).to_numpy()
    order = np.lexsort((ids[row], -score, anchor))
    anchor, row, score = anchor[order], row[order], score[order]
    lows, highs = (np.array(anchors.column(name).to_pylist(), np.int64) for name in ("lows", "highs"))
    parts = []
    for slot in range(lows.shape[1]):
        inside = np.flatnonzero((score >= lows[anchor, slot]) & (score <= highs[anchor, slot]))
        place = np.arange(len(inside)) - np.searchsorted(anchor[inside], anchor[inside])
        inside = inside[place < take]
        parts.append((inside, np.full(len(inside), slot)))
    at, slot = (np.concatenate(both) for both in zip(*parts))
    columns = [
        anchors.column("rid").take(pa.array(anchor[at])),
        pa.array(slot),
        rows.column("rid").take(pa.array(row[at])),
        rows.column("vec_id").take(pa.array(row[at])),
        pa.array(score[at]),
    ]
    return pa.table(dict(zip(names, columns)))


def _joined(rows: DataFrame, parts: int, anchors: DataFrame, same: bool, take: int) -> DataFrame:
    """The best rows of each window of each anchor over all blocks: anchor, slot, place, row, vec_id, score."""
    groups = max(1, -(-anchors.count() // ANCHORS))
    key = F.xxhash64("rid")
    left = rows.withColumn("part", F.pmod(key, F.lit(parts)).cast("int")).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = anchors.withColumn("group", F.pmod(key, F.lit(groups)).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def wanted(some: pa.Table, asked: pa.Table) -> pa.Table:
        return _wanted(some, asked, same, take)

    sides = [side.toDF(*side.columns).groupBy("part", "group") for side in (left, right)]
    found = sides[0].cogroup(sides[1]).applyInArrow(wanted, "anchor long, slot long, row long, vec_id long, score long")
    place = F.expr("row_number() over (partition by anchor, slot order by score desc, vec_id asc nulls last, row)")
    return found.withColumn("place", place).filter(F.col("place") <= take)


def _norm(vector: str) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def _in_rounds(rows: DataFrame, parts: int, anchors: DataFrame, levels: tuple[float, ...], same: bool, take: int, name: str) -> DataFrame:
    """Windows filled by threshold joins, stored round by round.

    ``anchors`` has rid, vec_id, label, vector, lows, highs and reach, the score that levels are shares of. A window is done when it
    holds ``take`` rows, all at the threshold or above, or when the threshold has come down to its low end.
    """
    done, open_slots = None, None
    for level in levels:
        threshold = F.greatest(F.ceil(F.least(F.col("reach") * level, F.lit(2.0**62))), F.array_min("lows")).cast("long")
        asking = anchors.withColumn("threshold", threshold)
        if open_slots is not None:
            asking = asking.join(open_slots.select(F.col("anchor").alias("rid")).distinct(), "rid", "left_semi")
        asking = stored(asking, f"{name}_asking")
        found = _joined(rows, parts, asking, same, take)
        if open_slots is not None:
            found = found.join(open_slots, ["anchor", "slot"], "left_semi")
        found = stored(found, f"{name}_found")
        held = found.groupBy("anchor", "slot").agg(F.count(F.lit(1)).alias("held"))
        slots = asking.select(F.col("rid").alias("anchor"), "threshold", F.posexplode("lows").alias("slot", "low"))
        slots = slots.withColumn("slot", F.col("slot").cast("long"))
        if open_slots is not None:
            slots = slots.join(open_slots, ["anchor", "slot"], "left_semi")
        left = slots.join(held, ["anchor", "slot"], "left").filter((F.coalesce("held", F.lit(0)) < take) & (F.col("threshold") > F.col("low")))
        open_slots = stored(left.select("anchor", "slot"), f"{name}_open")
        kept = found.join(open_slots, ["anchor", "slot"], "left_anti")
        done = kept if done is None else done.unionByName(kept)
        if open_slots.isEmpty():
            break
    return done


def hard_negatives(
    rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, for each positive of each anchor.

    ``rows`` has vec_id, label, vector (whole numbers) and anchor (whether it is one). A score is the inner product with the anchor.
    The ``positives`` other rows of the anchor's label with the highest scores are its positives; of the rows of other labels
    whose score lies between ``low`` and ``high`` percent of the positive's, the ``negatives`` highest are returned. Equal scores
    go by smaller vec_id, null last. A positive below 0 has an empty window. Rows with a null label, vector or component take no part;
    shorter vectors go on with zeros, an empty one scores 0 everywhere. Rows that repeat, or repeat an id, are rows of their own. Scores
    are exact; beyond 64 bits they count as the nearest such number. An empty table gives an empty result; other columns are ignored.
    """
    whole = "label is not null and vector is not null and not exists(vector, x -> x is null)"
    chosen = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "vector", "anchor").filter(whole)
    chosen = stored(chosen.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    count, longest = chosen.agg(F.count(F.lit(1)), F.max(_norm("vector"))).first()
    parts = max(1, -(-count // ROWS))
    index = chosen.select("rid", "vec_id", "label", "vector")
    anchors = chosen.filter("anchor").select("rid", "vec_id", "label", "vector")
    # Positives below 0 have no window: 0 is the least threshold.
    every = anchors.withColumn("lows", F.array(F.lit(0).cast("long"))).withColumn("highs", F.array(F.lit(2**63 - 1)))
    every = every.withColumn("reach", _norm("vector") * F.lit(longest or 0.0))
    near = stored(_in_rounds(index, parts, every, POSITIVE_LEVELS, True, positives, "positives"), "positives")

    ends = near.withColumn("low", F.expr(f"({low} * cast(score as decimal(38, 0)) + 99) div 100"))
    ends = ends.withColumn("high", F.expr(f"({high} * cast(score as decimal(38, 0))) div 100"))
    windows = ends.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "low", "high", "score"))).alias("held"))
    windows = windows.select(
        F.col("anchor").alias("rid"),
        F.col("held.low").alias("lows"),
        F.col("held.high").alias("highs"),
        F.array_min("held.score").cast("double").alias("reach"),
    )
    # All anchors of a block have as many slots: an empty window stands in for a missing positive.
    padded = [F.concat(name, F.array_repeat(F.lit(value).cast("long"), F.lit(positives) - F.size(name))).alias(name) for name, value in (("lows", 2**63 - 1), ("highs", -1))]
    asking = anchors.join(windows.select("rid", "reach", *padded), "rid")
    far = _in_rounds(index, parts, asking, NEGATIVE_LEVELS, False, negatives, "negatives")

    ids = anchors.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    of = near.select("anchor", (F.col("place") - 1).cast("long").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = far.select("anchor", "slot", F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    joined = found.join(of, ["anchor", "slot"]).join(ids, "anchor")
    return joined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
