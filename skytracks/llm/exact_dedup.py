"""Exact de-duplication by skew-safe combining.

Three combines, each of which compares whole texts, because the text is a grouping key:

1. local: the map-side half of the first aggregate leaves one row per distinct text and salt in
   each task, so a task sends a text at most ``salts`` times however many copies it holds;
2. salted: rows of one digest meet in ``salts`` different groups;
3. global: the salt winners of one digest meet, at most ``salts`` rows per text.

No list of members is ever built. Members find their winner through the digest alone, which is
exact where all rows of a digest have the same text; the combines have just established which
digests those are. Members of a digest with several texts are joined by the text itself.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytracks.llm.tables import stored, whole_text

SALTS = 16


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, in lower case."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def winners(
    docs: DataFrame,
    normalise: Callable[[Column], Column] = ascii_lower,
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row (digest, norm, keep_id, group_size) per distinct normalised text."""
    keyed = docs.select("doc_id", normalise(whole_text()).alias("norm"))
    keyed = keyed.select("doc_id", "norm", digest(F.col("norm")).alias("digest"))
    # Null ids hash alike; any spread will do, since the salt only decides where copies meet.
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    per_salt = salted.groupBy("digest", "salt", "norm").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    # Dealt by digest, which also serves the count of texts per digest.
    return per_salt.repartition("digest").groupBy("digest", "norm").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def exact_duplicates(
    docs: DataFrame,
    normalise: Callable[[Column], Column] = ascii_lower,
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest.

    Texts are equal when identical after ``normalise``. The row with the largest id stays; a null
    id is smaller than any other. Null text counts as empty, and empty texts are equal to each
    other. Of repeated rows (same id, same text) exactly one has ``kept``. A group of null ids
    alone keeps one of them, with a null ``keep_id``. Columns besides doc_id and text are ignored.
    """
    groups = winners(docs, normalise, digest, salts)
    summary = stored(
        groups.groupBy("digest").agg(
            F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
        ),
        "exact_dedup",
    )
    norm = normalise(whole_text())
    # Repeated rows become one with a count before the join, which adaptive execution can then split where a digest is hot.
    rows = _counted(docs.select("doc_id", digest(norm).alias("digest")))
    found = rows.join(summary.filter("texts = 1").drop("texts"), "digest")
    clashes = summary.filter("texts > 1").select("digest")
    if not clashes.isEmpty():
        texts = _counted(docs.select("doc_id", norm.alias("norm"), digest(norm).alias("digest")))
        clashing = texts.join(clashes, "digest", "left_semi").join(groups, ["digest", "norm"])
        found = found.unionByName(clashing.select(*found.columns))
    return _numbered(found)


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("rows"))


def _numbered(counted: DataFrame) -> DataFrame:
    """Repeated rows back to rows, numbered, so that one of them stays."""
    numbered = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return numbered.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest")


def drop_exact_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of repeated rows (same id and text) the smallest by the other columns stays.
    """
    digest = options.get("digest", sha256)
    normalise = options.get("normalise", ascii_lower)
    marked = exact_duplicates(docs, **options).filter("kept")
    mark = {"__digest": digest(normalise(whole_text())), "__norm": normalise(whole_text())}
    keys = [F.col("__id").eqNullSafe(F.col("doc_id")), F.col("__kept") == F.col("__digest")]
    stay = marked.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__kept"))
    rows = docs.withColumns(mark)
    kept = rows.join(stay, keys[0] & keys[1], "left_semi")
    others = [name for name in docs.columns if name != "doc_id"]
    one = kept.groupBy("doc_id", "__digest", "__norm").agg(F.min(F.struct(*others)).alias("__row"))
    return one.select(*(F.col("doc_id") if name == "doc_id" else F.col(f"__row.`{name}`") for name in docs.columns))
