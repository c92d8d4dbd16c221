from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException

from conftest import SMALL
from skytracks.functions.times import HOUR, HourRange, as_utc
from skytracks.operators.snapshot import with_ingest_hour
from skytracks.plans import fixtures
from skytracks.plans.gold import load_gold
from skytracks.plans.ingest import ingest
from skytracks.plans.silver import load_silver, silver_rows
from skytracks.sources.lake import read_bronze, read_silver, write_bronze
from skytracks.streaming.bronze import stream_bronze
from skytracks.streaming.silver import stream_silver


def test_stream_keeps_the_batch_keys(spark, tmp_path):
    bronze, silver, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "checkpoint"))
    reports = fixtures.bronze_reports(spark, SMALL)
    write_bronze(with_ingest_hour(reports), bronze)
    stream_silver(spark, bronze, silver, checkpoint).awaitTermination()
    rows = read_silver(spark, silver)
    assert rows.count() == 888
    key = ("icao24", "time_position")
    assert rows.select(*key).exceptAll(silver_rows(reports).select(*key)).isEmpty()


def test_stream_in_order_without_repeats_equals_batch(spark, tmp_path):
    bronze, silver, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "checkpoint"))
    reports = fixtures.bronze_reports(spark, SMALL).dropDuplicates(["icao24", "time_position"])
    write_bronze(with_ingest_hour(reports), bronze)
    stream_silver(spark, bronze, silver, checkpoint).awaitTermination()
    expected = silver_rows(reports)
    assert read_silver(spark, silver).select(*expected.columns).exceptAll(expected).isEmpty()
    assert read_silver(spark, silver).count() == expected.count()


def test_stream_reads_each_file_once_and_drops_repeats(spark, bronze, tmp_path):
    path, silver, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "checkpoint"))

    def arrive(*reports):
        write_bronze(with_ingest_hour(bronze(*reports)), path)
        stream_silver(spark, path, silver, checkpoint).awaitTermination()
        return sorted((r.icao24, str(r.time_position)) for r in read_silver(spark, silver).collect())

    first = arrive({}, {"time_position": None}, {"icao24": None}, {"ingest_ts": None, "icao24": "undated"})
    assert first == [("abc123", "2024-01-15 11:59:50"), ("abc123", "None")]
    again = {"ingest_ts": "2024-01-15T12:40:00"}
    second = arrive(again, again | {"time_position": None}, again | {"icao24": "def456"})
    assert second == first + [("def456", "2024-01-15 11:59:50")]
    stream_silver(spark, path, silver, checkpoint).awaitTermination()
    assert read_silver(spark, silver).count() == 3


def test_stream_ingest_takes_documents_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    bronze, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")
    vector = ["abc123", "FL1", "France", 1705320000, 1705320000, 2.0, 48.0, 1.0, False, 1.0, 1.0, 1.0]
    for i in range(2):
        (landing / f"{i}.json").write_text(json.dumps({"time": 1705320000 + 3600 * i, "states": [vector]}))
        for _ in range(2):
            stream_bronze(spark, str(landing), bronze, checkpoint).awaitTermination()
        assert read_bronze(spark, bronze).count() == i + 1


def rows_of(table, columns):
    return sorted(map(str, table.select(*columns).collect()))


def test_bounded_batches_newest_first_equal_batch(spark, bronze, tmp_path):
    path, silver, checkpoint = (str(tmp_path / n) for n in ("bronze", "silver", "checkpoint"))
    reports = [{"ingest_ts": f"2024-01-15T{hour}:00:00", "icao24": f"a{hour}"} for hour in (15, 12, 9)]
    # A copy an hour later that arrives first, and must go when the earlier one comes.
    reports.insert(0, {"ingest_ts": "2024-01-15T13:00:00", "icao24": "a12"})
    for report in reports:
        write_bronze(with_ingest_hour(bronze(report)), path)
    stream_silver(spark, path, silver, checkpoint, maxFilesPerTrigger=1).awaitTermination()
    expected = silver_rows(bronze(*reports))
    assert rows_of(read_silver(spark, silver), expected.columns) == rows_of(expected, expected.columns)
    assert expected.count() == 3


def test_stream_then_back_fill(spark, bronze, tmp_path):
    path, silver, checkpoint, gold = (str(tmp_path / n) for n in ("bronze", "silver", "checkpoint", "gold"))
    write_bronze(with_ingest_hour(bronze({})), path)
    stream_silver(spark, path, silver, checkpoint).awaitTermination()
    write_bronze(with_ingest_hour(bronze({"ingest_ts": "2024-01-15T07:10:00", "icao24": "late"})), path)
    load_silver(spark, path, silver, "incremental", "2024-01-15T07:30:00")
    hours = HourRange.covering(as_utc("2024-01-15T12:30:00"), 6 * HOUR)
    assert read_silver(spark, silver).count() == read_silver(spark, silver, hours).count() == 2
    load_gold(spark, silver, gold, "full")
    assert spark.read.parquet(gold).count() == 2


def test_hours_apart_are_ranges_apart():
    hours = [as_utc(text) for text in ("2024-01-15T12:00:00", "2024-01-15T03:00:00", "2020-02-29T23:00:00")]
    old, new = HourRange.around(hours, HOUR)
    assert (old.start, old.end) == (hours[2], hours[2] + 2 * HOUR)
    assert (new.start, new.end) == (hours[1], hours[0] + 2 * HOUR)
    assert HourRange.around([], HOUR) == []


VECTOR = ["abc123", "FL1", "France", 1705320000, 1705320000, 2.0, 48.0, 1.0, False, 1.0, 1.0, 1.0]


def test_stream_and_batch_ingest_share_a_table(spark, tmp_path):
    landing, other = tmp_path / "landing", tmp_path / "other"
    bronze, checkpoint, silver = (str(tmp_path / n) for n in ("bronze", "checkpoint", "silver"))
    for at, folder in enumerate((landing, other)):
        folder.mkdir()
        (folder / "0.json").write_text(json.dumps({"time": 1705320000, "states": [[f"a{at}", *VECTOR[1:]]]}))
    stream_bronze(spark, str(landing), bronze, checkpoint).awaitTermination()
    ingest(spark, str(other), bronze)
    assert read_bronze(spark, bronze).count() == 2
    load_silver(spark, bronze, silver, "full")
    assert read_silver(spark, silver).count() == 2


def test_a_replayed_batch_adds_nothing(spark, tmp_path):
    landing, checkpoint, bronze = tmp_path / "landing", tmp_path / "checkpoint", str(tmp_path / "bronze")
    landing.mkdir()
    # The same vector twice is two rows of bronze, also after a replay.
    (landing / "0.json").write_text(json.dumps({"time": 1705320000, "states": [VECTOR, VECTOR]}))
    stream_bronze(spark, str(landing), bronze, str(checkpoint)).awaitTermination()
    assert read_bronze(spark, bronze).count() == 2
    # As after a failure between the write and the commit of the batch.
    for name in ("0", ".0.crc"):
        if (checkpoint / "commits" / name).exists():
            (checkpoint / "commits" / name).unlink()
    stream_bronze(spark, str(landing), bronze, str(checkpoint)).awaitTermination()
    assert read_bronze(spark, bronze).count() == 2


def test_a_broken_document_can_be_left_out(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "0.json").write_text("{ broken")
    (landing / "1.json").write_text(json.dumps({"time": 1705320000, "states": [VECTOR]}))
    with pytest.raises(StreamingQueryException):
        stream_bronze(spark, str(landing), str(tmp_path / "b1"), str(tmp_path / "c1")).awaitTermination()
    skipping = stream_bronze(spark, str(landing), str(tmp_path / "b2"), str(tmp_path / "c2"), on_malformed="skip")
    skipping.awaitTermination()
    assert read_bronze(spark, str(tmp_path / "b2")).count() == 1
