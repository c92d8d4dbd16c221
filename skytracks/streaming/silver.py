"""Bronze to silver as a stream."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from skytracks.functions.times import HOUR, HourRange
from skytracks.plans.silver import load_hours
from skytracks.schemas import BRONZE_TABLE, INGEST_HOUR_KEYS


def touched_hours(rows: DataFrame) -> list[datetime]:
    """The ingest hours that ``rows`` have, in UTC; their number is bounded by the calendar."""
    keys = rows.select(*INGEST_HOUR_KEYS).dropna().distinct().collect()
    return [datetime(*map(int, key), tzinfo=timezone.utc) for key in keys]


def stream_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint: str,
    overlap: timedelta = HOUR,
    **source_options,
) -> StreamingQuery:
    """Bring the hours of bronze files not seen before into silver, then stop.

    The stream only says which hours have changed; each batch replaces them, and ``overlap`` past
    them, by the batch load of those hours, so batch loads may write the same table. Repeats within
    ``overlap`` are found whatever the order of files and the size of batches; of repeats further
    apart, null position times among them, more may stay the smaller the batches are. Reports without a
    readable ``ingest_ts`` are left out. ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bounds a batch.
    """
    files = spark.readStream.schema(BRONZE_TABLE).options(**source_options).json(bronze_path)

    def load(batch: DataFrame, _: int) -> None:
        # The caller's session, so that its settings hold for the load.
        for hours in HourRange.around(touched_hours(batch), overlap):
            load_hours(spark, bronze_path, silver_path, hours, overlap)

    stream = files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return stream.trigger(availableNow=True).start()
