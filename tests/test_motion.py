from __future__ import annotations

import random
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skytracks.functions.times import HourRange
from skytracks.operators import motion
from skytracks.operators.clean import typed_times, with_silver_hour
from skytracks.operators.neighbours import with_neighbours
from skytracks.plans.histories import moving_reports
from skytracks.plans.train import training_set
from skytracks.schemas import FEATURES_8, FEATURES_14


def plain(df, back, ahead, steps):
    """The same lookups as one window per aircraft."""
    total = ["time_position", "ingest_ts", *(c for c in df.columns if c not in ("icao24", "time_position", "ingest_ts"))]
    w = Window.partitionBy("icao24").orderBy(*total)
    return df.select(
        "*",
        *(F.lag(s, 1).over(w).alias(n) for n, s in back.items()),
        *(F.lead(s, steps).over(w).alias(n) for n, s in ahead.items()),
    )


def reports(spark, rng, aircraft, rows, days):
    """Uneven histories: a hot aircraft, null times, equal times, days without reports."""
    data = []
    for i in range(rows):
        who = "hot" if rng.random() < 0.4 else f"a{rng.randrange(aircraft)}"
        day = rng.choice(range(1, days + 1))
        clock = None if rng.random() < 0.1 else f"2024-01-{day:02d} {rng.randrange(24):02d}:00:{rng.randrange(60):02d}"
        ingest = f"2024-01-{rng.randrange(1, 28):02d} {rng.randrange(24):02d}:00:00" if rng.random() < 0.95 else None
        data.append((who, clock, ingest, float(i)))
    df = spark.createDataFrame(data, "icao24 string, t string, i string, value double")
    return df.select(
        "icao24", F.col("t").cast("timestamp").alias("time_position"), F.col("i").cast("timestamp").alias("ingest_ts"), "value"
    )


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize(
    ("back", "ahead", "steps"),
    [
        ({"prev": "value"}, {}, 1),
        ({}, {"next": "value"}, 5),
        ({"prev": "value", "prev_time": "time_position"}, {"next": "value"}, 5),
        ({"prev": "value"}, {"next": "value"}, 1),
        ({"prev": "value"}, {"next": "value"}, 30),
    ],
)
def test_sliced_lookup_equals_plain_window(spark, seed, back, ahead, steps):
    df = reports(spark, random.Random(seed), aircraft=4, rows=300, days=random.Random(seed).choice([1, 3, 25]))
    order, slices = motion._history(df, "day")
    found = with_neighbours(df, "icao24", order, slices, back, ahead, steps)
    expected = plain(df, back, ahead, steps)
    assert found.columns == expected.columns
    key = lambda row: str(tuple(row))
    assert sorted(found.collect(), key=key) == sorted(expected.collect(), key=key)


@pytest.mark.parametrize("width", ["hour", "week", "month", None])
def test_slice_width_does_not_matter(spark, width):
    df = reports(spark, random.Random(9), aircraft=2, rows=400, days=20)
    order, slices = motion._history(df, width)
    found = with_neighbours(df, "icao24", order, slices, {"p": "value"}, {"n": "value"}, 3)
    assert found.exceptAll(plain(df, {"p": "value"}, {"n": "value"}, 3)).isEmpty()
    assert found.count() == 400


def test_one_data_shuffle_is_shared(spark, bronze):
    rows = motion.with_motion(motion.motion_inputs(typed_times(bronze({}, {"time_position": None}))), horizon=5)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1
    assert re.search(r"Exchange hashpartitioning\(icao24#\d+, _slice_0#\d+, _slice_1#\d+, 8\)", plan)


def track(bronze, *reports):
    return motion.motion_inputs(typed_times(bronze(*reports)))


def at(second, **fields):
    return {"time_position": f"2024-01-15T11:00:{second:02d}", **fields}


def by_time(df):
    return [r.asDict() for r in df.orderBy(F.asc_nulls_first("time_position"), "ingest_ts").collect()]


def test_rates(bronze):
    first, second, third = by_time(
        motion.with_motion(
            track(
                bronze,
                at(0, velocity=100.0, heading=359.0, baro_altitude=1000.0),
                at(10, velocity=120.0, heading=1.0, baro_altitude=900.0),
                at(14, velocity=110.0, heading=3.0, baro_altitude=900.0),
            )
        )
    )
    assert first["prev_time"] is None and first["time_diff_sec"] is None
    assert first["accel"] == 0.0 and first["turn_rate"] == 0.0 and first["altitude_change"] is None
    assert second["time_diff_sec"] == 10 and second["accel"] == 2.0
    assert second["turn_rate"] == -35.8  # 359 to 1 degree is not wrapped
    assert second["altitude_change"] == -100.0
    assert third["accel"] == -2.5 and third["prev_velocity"] == 120.0


def test_equal_and_null_times_have_zero_rates(bronze):
    rows = by_time(
        motion.with_motion(
            track(
                bronze,
                {"time_position": None, "velocity": 50.0},
                at(0, velocity=100.0, ingest_ts="2024-01-15T12:00:00"),
                at(0, velocity=120.0, ingest_ts="2024-01-15T13:00:00"),
            )
        )
    )
    assert [r["velocity"] for r in rows] == [50.0, 100.0, 120.0]
    assert [r["time_diff_sec"] for r in rows] == [None, None, 0]
    assert [r["accel"] for r in rows] == [0.0, 0.0, 0.0]
    assert [r["prev_velocity"] for r in rows] == [None, 50.0, 100.0]


@pytest.mark.parametrize(("n", "usable"), [(1, 0), (6, 0), (7, 1), (10, 4)])
def test_training_rows_per_history(bronze, n, usable):
    rows = track(bronze, *(at(i, lat=40.0 + i) for i in range(n)))
    kept = by_time(training_set(rows))
    assert len(kept) == usable
    if kept:
        assert kept[0]["lat"] == 41.0 and kept[0]["future_lat"] == 46.0
    assert training_set(rows, FEATURES_8).count() == max(0, n - 5)


def test_nan_rows_are_not_used(bronze):
    rows = track(bronze, at(0), at(1, velocity=float("nan")), at(2), at(3))
    moving = motion.with_motion(rows)
    assert len(by_time(motion.scoring_rows(moving, FEATURES_8))) == 2  # the NaN also spoils the next rate
    assert len(by_time(motion.scoring_rows(moving, FEATURES_14))) == 1


def test_previous_columns_needed():
    assert motion.previous_for(FEATURES_14) == tuple(motion.PREVIOUS)
    assert set(motion.previous_for(FEATURES_8)) == {"prev_velocity", "prev_heading", "prev_time"}


@pytest.mark.parametrize("horizon", [None, 2])
def test_reports_asked_for_keep_their_neighbours(spark, bronze, horizon):
    """A gap of months before the hours, a late report, a null position time, and an aircraft new in the hours."""
    asked = HourRange(*(datetime(2024, 6, 1, hour, tzinfo=timezone.utc) for hour in (10, 12)))
    rows = [("2024-01-01T00", "2024-01-01T00:00:00", 1.0), ("2024-02-01T00", "2024-02-01T00:00:00", 2.0),
            ("2024-06-01T10", "2024-06-01T10:00:00", 3.0), ("2024-06-01T11", "2024-06-01T11:00:00", 4.0),
            ("2024-06-01T13", "2024-06-01T10:30:00", 5.0), ("2024-06-01T14", "2024-06-01T14:00:00", 6.0),
            ("2024-06-01T15", "2024-06-01T15:00:00", 7.0), ("2024-06-01T16", "2024-06-01T16:00:00", 8.0)]
    reports = [{"icao24": "old", "ingest_ts": f"{hour}:00:00", "time_position": time, "lat": lat} for hour, time, lat in rows]
    reports += [{"icao24": "nul", "ingest_ts": f"{hour}:00:00", "time_position": None, "lat": lat} for hour, _, lat in rows]
    reports += [{"icao24": "new", "ingest_ts": "2024-06-01T10:00:00", "time_position": "2024-06-01T10:00:00"},
                {"icao24": "out", "ingest_ts": "2024-06-01T14:00:00", "time_position": "2024-06-01T14:00:00"}]
    silver = with_silver_hour(typed_times(bronze(*reports)))
    whole = motion.with_motion(motion.motion_inputs(silver), horizon=horizon).filter(asked.contains(F.col("ingest_ts")))
    found = moving_reports(silver, FEATURES_14, horizon, asked)
    expected = whole.select(*found.columns)
    assert expected.count() == 5
    assert expected.exceptAll(found).isEmpty() and found.exceptAll(expected).isEmpty()
    assert found.filter("icao24 = 'old' AND lat = 3").first().prev_lat == 2.0
    assert found.filter("icao24 = 'old' AND lat = 4").first().prev_lat == 5.0
