"""A training corpus from ``documents``: quality rules, de-duplication at three levels, and packing.

Every stage takes all rows its predecessor kept and returns documents, the last one the packed pieces. Between stages the
rows are written as Parquet to the shared folder and read again, so a lost executor costs one stage's work at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skytracks.llm import exact_dedup, near_dedup, packing, passages, quality
from skytracks.llm.queries import VOCABULARY
from skytracks.llm.tables import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that are common on their host."""
    return quality.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that another text keeps."""
    return passages.drop_near_passages(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.pack(docs, VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("substring_dedup", repeated_passages),
    ("best_fit_packing", packed),
]

# Near duplicates and near passages have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
