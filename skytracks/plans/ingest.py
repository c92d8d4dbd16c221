"""Landed snapshot documents to bronze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skytracks.operators.clean import in_box
from skytracks.operators.snapshot import flatten_snapshots, with_ingest_hour
from skytracks.plans.runs import Counting, uncounted
from skytracks.schemas import BoundingBox
from skytracks.sources.lake import WriteMode, read_if_present, read_snapshots, write_bronze


def bronze_rows(
    documents: DataFrame,
    box: BoundingBox | None = BoundingBox(),
    on_malformed: str = "fail",
    seen: Counting = uncounted,
) -> DataFrame:
    """Flat rows inside ``box`` (``None`` keeps all), with their directory keys."""
    rows = seen(flatten_snapshots(documents, on_malformed=on_malformed), "rows_in")
    return with_ingest_hour(rows if box is None else in_box(rows, box))


def ingest(
    spark: SparkSession,
    landing_path: str,
    bronze_path: str,
    box: BoundingBox | None = BoundingBox(),
    one_per_line: bool = False,
    on_malformed: str = "fail",
    mode: WriteMode = "append",
) -> str | None:
    """Flatten every document under ``landing_path`` into bronze; None when there is nothing to read.

    Repeating a run with ``append`` repeats its rows (silver drops them); ``replace`` swaps the
    hours that the documents cover instead.
    """
    documents = read_if_present(lambda: read_snapshots(spark, landing_path, one_per_line))
    if documents is None:
        return None
    write_bronze(bronze_rows(documents, box, on_malformed), bronze_path, mode)
    return bronze_path
