"""Quality rules with cross-document line frequency, in DataFrame functions only.

A line is hashed after normalising (lower case, digits to 0, white space to one space). Its count is
the number of distinct texts of one host that hold it: copies of a text count once, so that a document
is not boiler-plate because it was copied. Lines above the limit are removed, and a document that
has too little left is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytracks.llm.tables import SPACES, let, stored, whole_text, words_of

# Fixed: the characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Limits:
    """``line_docs``: a line is removed when more distinct texts than so many hold it on its host, however large the host is.

    ``left_share`` and ``min_words``: what has to be left of a document.
    """

    min_words: int = 10
    repeat_percent: int = 20
    line_docs: int = 10
    left_share: float = 0.3


MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_removed_words",
    "base_failed",
    "kept",
)


def normalised(line: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.lower(line), "[0-9]", "0"), f"[{SPACES}]+", " ")
    return F.trim(plain)


def word_windows(hashes: Column) -> Column:
    """A 64-bit hash for each window of five words, from an array of word hashes."""

    def each(known: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(known) - WINDOW),
            lambda at: F.xxhash64(*(F.get(known, at + step) for step in range(WINDOW))),
        )

    return let(hashes, lambda known: F.when(F.size(known) >= WINDOW, each(known)).otherwise(F.array().cast("array<bigint>")))


def words_in_repeats(windows: Column) -> Column:
    """Words covered by windows that stand twice or more in the array.

    Sorting brings equal windows together; their starts, in order, cover five words each, or as
    many as there are up to the next start.
    """

    def starts_in(ranked: Column) -> Column:
        def repeated(this: Column, at: Column) -> Column:
            before = (at > 0) & (F.get(ranked, F.greatest(at - 1, F.lit(0)))["value"] == this["value"])
            return before | F.coalesce(F.get(ranked, at + 1)["value"] == this["value"], F.lit(False))

        return F.array_sort(F.transform(F.filter(ranked, repeated), lambda window: window["at"]))

    def covered(starts: Column) -> Column:
        return F.transform(
            starts, lambda at, k: F.least(F.coalesce(F.get(starts, k + 1) - at, F.lit(WINDOW)), F.lit(WINDOW))
        )

    ranked = F.array_sort(F.transform(windows, lambda value, at: F.struct(value.alias("value"), at.alias("at"))))
    gaps = let(let(ranked, starts_in), covered)
    return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, gap: total + gap)


def base_measures(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = whole_text()
    hashed = docs.withColumn("__hashes", F.transform(words_of(text), lambda word: F.xxhash64(word)))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{SPACES}]"))
    measured = hashed.withColumns(
        {
            "n_words": F.size("__hashes").cast("bigint"),
            "word_chars": F.length(F.regexp_replace(text, f"[{SPACES}]+", "")).cast("bigint"),
            "n_symbols": F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).cast("bigint"),
            "__lines": lines,
            "__windows": word_windows(F.col("__hashes")),
        }
    )
    twice = F.size(F.array_distinct("__windows")) < F.size("__windows")
    measured = measured.withColumns(
        {
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
            "n_repeat_words": F.when(twice, words_in_repeats(F.col("__windows"))).otherwise(F.lit(0).cast("bigint")),
        }
    )
    failed = (F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words")
    )
    return measured.withColumn("base_failed", failed).drop("__hashes", "__windows", "__lines")


def _keyed(docs: DataFrame, host: str) -> DataFrame:
    """``docs`` with a key that survives null and repeated ids: id, host and a hash of the text."""
    return docs.withColumns(
        {
            "__id": F.col("doc_id"),
            "__host": F.coalesce(F.col(host).cast("string"), F.lit("")),
            "__text": F.xxhash64(whole_text()),
        }
    )


KEY = ["__id", "__host", "__text"]


def line_rows(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per line with a word: the document's key, the line's place, hash and words."""
    lines = _keyed(docs, host).select(*KEY, F.posexplode(F.split(whole_text(), "\n", -1)).alias("__at", "__line"))
    return lines.filter(F.col("__line").rlike(f"[^{SPACES}]")).select(
        *KEY,
        "__at",
        F.xxhash64(normalised(F.col("__line"))).alias("__hash"),
        F.size(words_of(F.col("__line"))).alias("__words"),
    )


def frequent_lines(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """(__host, __hash) of the lines that more distinct texts of a host hold than the limits allow.

    ``distinct`` and ``count`` combine before each shuffle: neither a hot host nor a hot line meets whole in one task.
    """
    counts = line_rows(docs, host).select("__host", "__hash", "__text").distinct()
    counts = counts.groupBy("__host", "__hash").agg(F.count(F.lit(1)).alias("__docs"))
    return counts.filter(F.col("__docs") > limits.line_docs).select("__host", "__hash")


def removed_lines(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """Per document key: words in removed lines, and the places of those lines."""
    hits = line_rows(docs, host).join(stored(frequent_lines(docs, host, limits), "frequent_lines"), ["__host", "__hash"])
    once = hits.groupBy(*KEY, "__at").agg(F.first("__words").alias("__words"))  # repeated rows share their key
    return once.groupBy(*KEY).agg(F.sum("__words").alias("__removed"), F.collect_list("__at").alias("__places"))


def judged(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """``docs`` with the base measures, n_removed_words, kept, and ``__places`` of the removed lines.

    Null text counts as empty (no words: rejected), a null host as the host "". Repeated rows get the same verdict.
    The document's own columns stay; a column named like a measure is replaced by the measure.
    """
    measured = _keyed(base_measures(docs, limits), host)
    removed = removed_lines(docs, host, limits).select(*(F.col(k).alias(f"{k}_r") for k in KEY), "__removed", "__places")
    same = [F.col(k).eqNullSafe(F.col(f"{k}_r")) for k in KEY]
    joined = measured.join(removed, same[0] & same[1] & same[2], "left")
    gone = F.coalesce("__removed", F.lit(0).cast("bigint"))
    left = F.col("n_words") - gone
    enough = (left >= limits.min_words) & (left >= limits.left_share * F.col("n_words"))
    return joined.withColumns({"n_removed_words": gone, "kept": ~F.col("base_failed") & enough}).drop(
        *KEY, *(f"{k}_r" for k in KEY), "__removed"
    )


def quality(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """Measures and verdict per document, without its text."""
    return judged(docs, host, limits).select("doc_id", *MEASURES)


def keep_good(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The documents that pass, without the removed lines, in the columns of ``docs``; n_chars follows the text.

    A column of the documents that is named like a measure keeps its values.
    """
    # Own columns of those names go under others while the measures are there.
    own = {name: f"__own_{name}" for name in docs.columns if name in MEASURES}
    passed = judged(docs.withColumnsRenamed(own), own.get(host, host), limits).filter("kept").drop(*MEASURES)
    passed = passed.withColumnsRenamed({held: name for name, held in own.items()})
    lines = F.filter(
        F.split("text", "\n", -1), lambda _, at: ~F.array_contains(F.col("__places"), at)
    )
    text = F.when(F.col("__places").isNull(), F.col("text")).otherwise(F.array_join(lines, "\n"))
    cleaned = passed.withColumn("text", text)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)
