"""Landed snapshot documents to bronze as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from skytracks.functions.times import HOUR, HourRange
from skytracks.operators.snapshot import with_ingest_hour
from skytracks.plans.ingest import bronze_rows
from skytracks.plans.runs import Counting, uncounted
from skytracks.schemas import BRONZE, BoundingBox
from skytracks.sources.lake import read_bronze, read_if_present, write_bronze
from skytracks.streaming.silver import touched_hours


def _not_yet_written(rows: DataFrame, bronze_path: str) -> DataFrame:
    """``rows`` without those their hours hold already, as often as they hold them."""
    hours = touched_hours(rows)
    if not hours:
        return rows
    span = HourRange(min(hours), max(hours) + HOUR)
    there = read_if_present(lambda: read_bronze(rows.sparkSession, bronze_path, span))
    if there is None:
        return rows
    return with_ingest_hour(rows.select(*BRONZE.names).exceptAll(there.select(*BRONZE.names)))


def stream_bronze(
    spark: SparkSession,
    landing_path: str,
    bronze_path: str,
    checkpoint: str,
    box: BoundingBox | None = BoundingBox(),
    one_per_line: bool = False,
    on_malformed: str = "fail",
    seen: Counting = uncounted,
    **source_options,
) -> StreamingQuery:
    """Append the rows of documents not seen before to bronze, then stop.

    Files are written as ``plans.ingest.ingest`` writes them, so both may write one table. A batch
    that an earlier start began is compared with what its hours hold, and only what they lack is
    written. A malformed document stops the stream, or is left out with ``on_malformed="skip"``.
    """
    documents = spark.readStream.options(**source_options).text(landing_path, wholetext=not one_per_line)

    def append(batch: DataFrame, number: int) -> None:
        # The batch has a session of its own, where adaptive execution may be off.
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", spark.conf.get("spark.sql.adaptive.enabled"))
        begun = f"{checkpoint.rstrip('/')}/begun/{number}"
        if read_if_present(lambda: spark.read.text(begun)) is None:
            spark.range(1).selectExpr("string(id) AS value").write.text(begun)
            rows = bronze_rows(batch, box, on_malformed, seen)
        else:
            # What a batch repeats was counted, if at all, by the run that began it.
            rows = _not_yet_written(bronze_rows(batch, box, on_malformed), bronze_path)
        write_bronze(seen(rows, "rows_out"), bronze_path)

    stream = documents.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()
