"""Typing, filtering and de-duplication of state reports."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytracks.functions.times import as_utc, calendar_parts, parse_time, since_hour
from skytracks.schemas import (
    GOLD_DAY_KEY,
    INGEST_HOUR_KEYS,
    LOOKBACK,
    MEASUREMENTS,
    REPORT_KEY,
    REPORT_TIMES,
    SILVER_HOUR_KEYS,
    BoundingBox,
)


def typed_times(bronze: DataFrame) -> DataFrame:
    """Text times to timestamps; ``ingest_ts`` always, so every load writes one type."""
    return bronze.withColumns({name: parse_time(F.col(name)) for name in REPORT_TIMES})


def in_box(reports: DataFrame, box: BoundingBox = BoundingBox()) -> DataFrame:
    """Reports inside the box, edges included; a report without a position is outside."""
    return reports.filter(
        F.col("lat").between(box.lamin, box.lamax) & F.col("lon").between(box.lomin, box.lomax)
    )


def recent(
    reports: DataFrame, as_of: datetime | str | None = None, lookback: timedelta = LOOKBACK
) -> DataFrame:
    """Reports ingested strictly after ``as_of - lookback``, with no upper bound.

    Without ``as_of`` the bound moves with ``current_timestamp()``. ``ingest_ts`` must be a timestamp.
    Where the rows carry the hour keys of bronze or silver, the bound is put on those as well, so
    that a scan skips the older directories.
    """
    earliest = as_utc(as_of) - lookback
    bound = F.lit(earliest) if as_of is not None else F.current_timestamp() - F.lit(lookback)
    fresh = F.col("ingest_ts") > bound
    for keys in (INGEST_HOUR_KEYS, SILVER_HOUR_KEYS):
        if set(keys) <= set(reports.columns):
            fresh = fresh & since_hour(keys, earliest)
    return reports.filter(fresh)


def valid_reports(reports: DataFrame) -> DataFrame:
    """Reports with an aircraft key, a position on the globe and all four measurements."""
    usable = (
        F.col("icao24").isNotNull()
        & F.col("lat").between(-90, 90)
        & F.col("lon").between(-180, 180)
    )
    for name in MEASUREMENTS:
        usable = usable & F.col(name).isNotNull()
    return reports.filter(usable)


def first_reports(reports: DataFrame) -> DataFrame:
    """One row per (aircraft, position time): the earliest report; null times are one group.

    ``row_number() = 1`` lets Spark keep the best row per key inside each map task before the
    shuffle (WindowGroupLimit), so a key with very many copies sends at most one row per task.
    Ordering by the remaining columns, lineage last, makes the survivor the same on every run
    and however the files were split.
    """
    leading = [name for name in ("ingest_ts", "last_contact") if name in reports.columns]
    others = [name for name in reports.columns if name not in (*REPORT_KEY, *leading, "source_file")]
    others += [name for name in reports.columns if name == "source_file"]
    order = [F.col(name).asc_nulls_last() for name in (*leading, *others)]
    ranked = reports.withColumn("_rank", F.row_number().over(Window.partitionBy(*REPORT_KEY).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def with_silver_hour(reports: DataFrame) -> DataFrame:
    return reports.select("*", *calendar_parts(F.col("ingest_ts"), SILVER_HOUR_KEYS))


def with_ingest_date(reports: DataFrame) -> DataFrame:
    """Swap the hour keys of silver for gold's day key."""
    if "ingest_ts" not in reports.columns:
        raise ValueError("gold needs an ingest_ts column")
    day = F.col("ingest_ts").cast("timestamp").cast("date")
    return reports.drop(*SILVER_HOUR_KEYS).withColumn(GOLD_DAY_KEY, day)
