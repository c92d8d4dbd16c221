from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from skytracks.operators import clean
from skytracks.plans.silver import silver_rows
from skytracks.schemas import BoundingBox


def icaos(df):
    return sorted(r.icao24 for r in df.select("icao24").collect())


def test_times_are_typed_and_bad_text_is_null(bronze):
    rows = clean.typed_times(bronze({}, {"icao24": "bad", "time_position": "not a time", "ingest_ts": "2024-13-01"}))
    types = dict(rows.dtypes)
    assert [types[c] for c in ("ingest_ts", "time_position", "last_contact")] == ["timestamp"] * 3
    bad = rows.filter("icao24 = 'bad'").collect()[0]
    assert bad.time_position is None and bad.ingest_ts is None and bad.last_contact is not None


def test_times_are_read_as_utc(spark, bronze):
    row = clean.typed_times(bronze({})).select(F.unix_timestamp("ingest_ts").alias("t")).collect()[0]
    assert row.t == 1705320000


@pytest.mark.parametrize(
    ("lat", "lon", "kept"),
    [
        (90.0, 180.0, True), (-90.0, -180.0, True), (90.01, 0.0, False), (0.0, -180.01, False),
        (None, 0.0, False), (0.0, None, False), (float("nan"), 0.0, False), (0.0, float("nan"), False),
    ],
)
def test_coordinate_range(bronze, lat, lon, kept):
    assert clean.valid_reports(bronze({"lat": lat, "lon": lon})).count() == int(kept)


@pytest.mark.parametrize("name", ["icao24", "velocity", "heading", "vertical_rate", "baro_altitude"])
def test_required_fields(bronze, name):
    assert clean.valid_reports(bronze({name: None})).isEmpty()


def test_optional_fields(bronze):
    optional = {"callsign": None, "time_position": None, "last_contact": None, "on_ground": None, "origin_country": None}
    assert clean.valid_reports(bronze(optional)).count() == 1


def test_box_edges_and_missing_positions(bronze):
    rows = bronze(
        {"icao24": "edge", "lat": 41.0, "lon": 9.5}, {"icao24": "north", "lat": 51.51}, {"icao24": "none", "lat": None}
    )
    assert icaos(clean.in_box(rows)) == ["edge"]
    assert icaos(clean.in_box(rows, BoundingBox(50.0, 52.0, 0.0, 3.0))) == ["north"]


def test_recent_is_strict_and_open_ended(bronze):
    rows = clean.typed_times(
        bronze(
            {"icao24": "at", "ingest_ts": "2024-01-15T11:00:00"},
            {"icao24": "after", "ingest_ts": "2024-01-15T11:00:01"},
            {"icao24": "later", "ingest_ts": "2024-02-01T00:00:00"},
            {"icao24": "null", "ingest_ts": None},
        )
    )
    assert icaos(clean.recent(rows, "2024-01-15T12:00:00")) == ["after", "later"]
    assert icaos(clean.recent(rows, "2024-01-15T12:00:00", timedelta(hours=2))) == ["after", "at", "later"]
    assert icaos(clean.recent(rows, "2024-01-15T13:00:00+01:00")) == ["after", "later"]


def test_recent_defaults_to_now(spark):
    rows = spark.range(1).select(
        F.explode(F.array(F.current_timestamp(), F.current_timestamp() - F.expr("INTERVAL 61 MINUTES"))).alias("ingest_ts")
    )
    assert clean.recent(rows).count() == 1


def test_earliest_report_wins(bronze):
    rows = clean.typed_times(
        bronze(
            {"ingest_ts": "2024-01-15T13:00:00", "callsign": "late"},
            {"ingest_ts": "2024-01-15T12:00:00", "callsign": "early", "last_contact": "2024-01-15T11:59:51"},
            {"ingest_ts": "2024-01-15T12:00:00", "callsign": "second", "last_contact": "2024-01-15T11:59:52"},
            {"ingest_ts": None, "callsign": "undated"},
        )
    )
    assert [r.callsign for r in clean.first_reports(rows).collect()] == ["early"]


def test_null_times_collapse_per_aircraft(bronze):
    rows = clean.typed_times(
        bronze({"time_position": None}, {"time_position": None, "lat": 47.0}, {"icao24": "other", "time_position": None})
    )
    assert icaos(clean.first_reports(rows)) == ["abc123", "other"]


def test_survivor_does_not_depend_on_files(bronze):
    rows = clean.typed_times(bronze({"lat": 41.0}, {"lat": 42.0}))
    for first, second in (("a", "b"), ("b", "a")):
        named = rows.withColumn("source_file", F.when(F.col("lat") == 41.0, first).otherwise(second))
        assert clean.first_reports(named).collect()[0].lat == 41.0


def test_survivor_does_not_depend_on_partitioning(bronze):
    rows = clean.typed_times(bronze(*({"lat": 40.0 + i, "callsign": f"c{i}"} for i in range(20))))
    survivors = {tuple(clean.first_reports(rows.repartition(n)).collect()[0]) for n in (1, 3, 7)}
    assert len(survivors) == 1


def test_copies_are_dropped_before_the_shuffle(bronze):
    plan = clean.first_reports(clean.typed_times(bronze({})))._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("WindowGroupLimit") == 2 and physical.count("Exchange") == 1


def test_silver_columns(bronze):
    row = silver_rows(bronze({"ingest_ts": "2024-02-03T04:05:06"})).collect()[0]
    assert (row.year, row.month, row.day, row.hour) == (2024, 2, 3, 4)


def test_gold_needs_ingest_ts(bronze):
    with pytest.raises(ValueError, match="ingest_ts"):
        clean.with_ingest_date(bronze({}).drop("ingest_ts"))
    row = clean.with_ingest_date(silver_rows(bronze({}))).collect()[0]
    assert str(row.ingest_date) == "2024-01-15" and "hour" not in row.asDict()
