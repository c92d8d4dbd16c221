from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from skytracks.functions.times import HOUR, HourRange, as_utc
from skytracks.schemas import SILVER_HOUR_KEYS
from skytracks.sources.lake import _named_dirs


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


def test_as_utc():
    assert as_utc("2024-01-15T12:00:00") == utc(2024, 1, 15, 12)
    assert as_utc("2024-01-15T12:00:00+02:00") == utc(2024, 1, 15, 10)
    assert as_utc(datetime(2024, 1, 15)) == utc(2024, 1, 15)
    assert abs(as_utc(None) - datetime.now(timezone.utc)) < timedelta(seconds=5)


def test_covering_hours():
    hours = HourRange.covering(utc(2024, 1, 15, 12, 30), HOUR)
    assert (hours.start, hours.end) == (utc(2024, 1, 15, 11), utc(2024, 1, 15, 13))
    wide = hours.widened(before=timedelta(minutes=30), after=timedelta(minutes=90))
    assert (wide.start, wide.end) == (utc(2024, 1, 15, 10), utc(2024, 1, 15, 15))
    days = hours.whole_days()
    assert (days.start, days.end) == (utc(2024, 1, 15), utc(2024, 1, 16))
    assert days.whole_days() == days


def test_directories_use_whole_days():
    hours = HourRange(utc(2023, 12, 31, 22), utc(2024, 1, 2, 1))
    assert _named_dirs(SILVER_HOUR_KEYS, hours) == [
        "year=2023/month=12/day=31/hour=22",
        "year=2023/month=12/day=31/hour=23",
        "year=2024/month=1/day=1",
        "year=2024/month=01/day=01",
        "year=2024/month=1/day=2/hour=0",
        "year=2024/month=01/day=02/hour=00",
    ]


@pytest.mark.parametrize(
    ("start", "end"),
    [
        (utc(2024, 1, 15, 11), utc(2024, 1, 15, 13)),
        (utc(2023, 12, 31, 22), utc(2024, 1, 1, 2)),
        (utc(2024, 2, 28), utc(2024, 3, 2, 5)),
        (utc(2023, 6, 1), utc(2025, 1, 1)),
    ],
)
def test_partition_predicate_equals_range(spark, start, end):
    hours = HourRange(start, end)
    every = spark.sql(
        "SELECT explode(sequence(timestamp'2023-05-30', timestamp'2025-01-05', interval 1 hour)) AS ts"
    ).select("ts", *(F.expr(f"{p}(ts)").alias(p) for p in SILVER_HOUR_KEYS))
    by_key = every.filter(hours.prunes(SILVER_HOUR_KEYS))
    by_time = every.filter(hours.contains(F.col("ts")))
    assert by_key.count() == by_time.count() == (end - start) // HOUR
    assert by_key.exceptAll(by_time).isEmpty()
