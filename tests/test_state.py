from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from skytracks.functions.times import DAY, HOUR, HourRange
from skytracks.operators.motion import motion_inputs
from skytracks.plans import silver
from skytracks.plans.histories import moving_reports
from skytracks.plans.predict import predict
from skytracks.plans.state import DayMotion, last_reports, note_changed, state_at
from skytracks.plans.train import train
from skytracks.schemas import FEATURES_14, SILVER_HOUR_KEYS
from skytracks.sources.lake import read_silver, write_bronze, write_silver
from skytracks.operators.snapshot import with_ingest_hour

START = datetime(2024, 1, 10, tzinfo=timezone.utc)


def report(at: datetime, aircraft: str, delay: timedelta, lat: float, timed: bool = True) -> dict:
    ingested = at + delay
    return {
        "ingest_ts": ingested.strftime("%Y-%m-%dT%H:%M:%S"), "icao24": aircraft, "lat": float(lat), "velocity": lat * 2.0,
        "time_position": at.strftime("%Y-%m-%dT%H:%M:%S") if timed else None,
    }


def flights(seed: int) -> list[dict]:
    """Eight days of reports; some come days late, some without a position time, some aircraft report rarely."""
    made, rows = random.Random(seed), []
    for number in range(14):
        count = made.choice([3, 8, 120])
        for _ in range(count):
            at = START + timedelta(seconds=made.randrange(8 * 86400))
            late = made.choice([60, 60, 60, 60, 3600, 100_000, 300_000]) if number % 2 else 60
            rows.append(report(at, f"a{number:02d}", timedelta(seconds=late), made.randint(1, 80), made.random() > 0.05))
    return rows


@pytest.fixture
def lake(spark, bronze, tmp_path):
    def build(rows):
        path = str(tmp_path / "silver")
        write_silver(silver.silver_rows(with_ingest_hour(bronze(*rows)).withColumn("source_file", F.lit("x"))), path, "overwrite")
        return path

    return build


def plain(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("horizon", [None, 5])
def test_motion_from_state_is_that_of_the_whole_history(spark, lake, tmp_path, horizon):
    path = lake(flights(1))
    for day in (2, 3, 5):
        hours = HourRange(START + day * DAY + 5 * HOUR, START + day * DAY + 9 * HOUR)
        found = DayMotion(spark, path, str(tmp_path / "state"), hours, horizon).motion(FEATURES_14)
        whole = read_silver(spark, path).filter(F.col("ingest_ts") < F.lit(hours.whole_days().end))
        expected = moving_reports(whole, FEATURES_14, horizon, hours.whole_days())
        assert plain(found.select(*sorted(found.columns))) == plain(expected.select(*sorted(found.columns)))
        assert not found.isEmpty()


def test_a_state_moved_on_is_the_state_made_at_once(spark, lake, tmp_path):
    path = lake(flights(2))
    at_once = state_at(spark, path, str(tmp_path / "one"), START + 6 * DAY)
    for day in range(1, 7):
        moved = state_at(spark, path, str(tmp_path / "two"), START + day * DAY)
    assert plain(at_once) == plain(moved)
    assert at_once.groupBy("icao24").count().agg(F.max("count")).first()[0] <= 8


def test_files_read_are_those_of_the_day_and_the_state(spark, lake, tmp_path):
    path, kept = lake([r for r in flights(3) if r["icao24"] < "a01"] + flights(4)[:40]), str(tmp_path / "state")
    hours = HourRange(START + 4 * DAY, START + 4 * DAY + HOUR)
    punctual = [report(START + timedelta(hours=3 * i), f"p{i % 4}", timedelta(seconds=30), i) for i in range(60)]
    path = lake(punctual)
    found = DayMotion(spark, path, kept, hours).motion(FEATURES_14)
    files = found.inputFiles()
    assert any("/state/" in name for name in files)
    assert all("/state/" in name or "/month=1/day=14/" in name for name in files), files
    assert found.count() == 8


def test_changed_silver_puts_later_states_out_of_use(spark, lake, tmp_path):
    rows, kept = [r for r in flights(5) if r["ingest_ts"] < "2024-01-14"], str(tmp_path / "state")
    path = lake(rows)
    before = state_at(spark, path, kept, START + 4 * DAY)
    early = state_at(spark, path, kept, START + 2 * DAY)
    count = before.count()
    lake([*rows, report(START + 3 * DAY, "new", timedelta(seconds=9), 1)])
    assert state_at(spark, path, kept, START + 4 * DAY).count() == count
    note_changed(spark, kept, HourRange(START + 3 * DAY, START + 3 * DAY + HOUR))
    assert state_at(spark, path, kept, START + 4 * DAY).count() == count + 1
    assert state_at(spark, path, kept, START + 2 * DAY).inputFiles() == early.inputFiles()
    note_changed(spark, kept)
    assert state_at(spark, path, kept, START + 2 * DAY).inputFiles() != early.inputFiles()


def test_a_late_report_has_the_following_one_scored_again(spark, bronze, tmp_path):
    """Loads hour by hour with a report that is a day late give the predictions of a whole run."""
    raw, path, kept = str(tmp_path / "bronze"), str(tmp_path / "silver"), str(tmp_path / "state")
    rows = [report(START + timedelta(hours=2 * i), f"p{i % 3}", timedelta(seconds=30), 10 + i) for i in range(30)]
    late = report(START + timedelta(hours=13, minutes=30), "p0", timedelta(hours=30), 70)
    write_bronze(with_ingest_hour(bronze(*rows, late)), raw)
    silver.load_silver(spark, raw, path, "full")
    train(spark, path, str(tmp_path / "models"), num_trees=2, horizon=1, maxDepth=4)
    predict(spark, path, str(tmp_path / "models"), str(tmp_path / "expected"))

    write_silver(read_silver(spark, path).limit(0), path, "overwrite")
    for day in range(3):
        moment = START + day * DAY + 23 * HOUR
        silver.load_silver(spark, raw, path, "incremental", moment, 23 * HOUR)
        hours = silver.written_hours(moment, 23 * HOUR, HOUR)
        note_changed(spark, kept, hours)
        found = DayMotion(spark, path, kept, hours)
        assert [h.start for h in found.repaired_days(hours)] == ([START] if day == 1 else [])
        predict(spark, path, str(tmp_path / "models"), str(tmp_path / "scored"), hours, kept)
    assert plain(spark.read.parquet(str(tmp_path / "scored"))) == plain(spark.read.parquet(str(tmp_path / "expected")))


def test_ties_nulls_and_an_empty_table(spark, lake):
    same = report(START, "x", timedelta(0), 1.0)
    path = lake([same, same | {"lat": 2.0}, same | {"time_position": None}, same | {"time_position": None, "lat": 3.0}])
    assert last_reports(read_silver(spark, path)).count() == 2
    assert last_reports(read_silver(spark, path).limit(0)).count() == 0
    assert set(SILVER_HOUR_KEYS).isdisjoint(last_reports(read_silver(spark, path)).columns)
    assert motion_inputs(read_silver(spark, path)).columns == last_reports(read_silver(spark, path)).columns
