"""Results must not depend on how much is read at once, nor on the size of the cluster."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest

from skytracks.functions.times import DAY, HOUR, HourRange
from skytracks.plans.gold import load_gold
from skytracks.plans.predict import predict
from skytracks.plans.silver import load_silver
from skytracks.plans.train import fit_and_evaluate, training_set
from skytracks.operators.snapshot import with_ingest_hour
from skytracks.plans import fixtures
from skytracks.plans.silver import silver_rows
from skytracks.session import fresh_dir
from skytracks.sources.lake import read_silver, write_bronze

SMALL = "/root/testdata/sf0.001"
NOON = datetime(2024, 1, 15, 12, tzinfo=timezone.utc)


def test_a_range_is_named_by_few_directories():
    steps = list(HourRange(NOON - 8 * 365 * DAY, NOON).steps())
    assert len(steps) < 160
    at = NOON - 8 * 365 * DAY
    for begin, level in steps:
        assert begin == at
        at = {1: begin.replace(year=begin.year + 1), 2: (begin + 32 * DAY).replace(day=1), 3: begin + DAY, 4: begin + HOUR}[level]
    assert at == NOON


@pytest.fixture
def silver_path(spark, bronze):
    source, path = fresh_dir(spark, "bronze"), fresh_dir(spark, "silver")
    write_bronze(with_ingest_hour(bronze({})), source)
    load_silver(spark, source, path, "full")
    return path


@pytest.mark.parametrize("width", [DAY, 8 * 365 * DAY])
def test_a_range_without_rows_is_empty_at_every_width(spark, silver_path, width):
    end = datetime(2015, 1, 1, tzinfo=timezone.utc)
    assert read_silver(spark, silver_path, HourRange(end - width, end)).count() == 0
    assert read_silver(spark, silver_path, HourRange(NOON - width, NOON + HOUR)).count() == 1


@pytest.mark.parametrize("width", [DAY, 8 * 365 * DAY])
def test_padded_keys_are_found_at_every_width(spark, silver_path, width):
    padded = fresh_dir(spark, "padded")
    rows = read_silver(spark, silver_path).drop("source_file", "year", "month", "day", "hour")
    rows.write.parquet(f"{padded}/year=2024/month=01/day=02/hour=09")
    end = datetime(2024, 1, 2, 10, tzinfo=timezone.utc)
    assert read_silver(spark, padded, HourRange(end - width, end)).count() == 1


def test_models_do_not_depend_on_partitions(spark):
    rows = training_set(silver_rows(fixtures.bronze_reports(spark, SMALL)))
    errors = []
    for parts in (2, 7):
        _, found = fit_and_evaluate(rows.repartition(parts), num_trees=3)
        errors.append(sorted(map(tuple, found.collect())))
    assert errors[0] == errors[1]


def test_gold_publishes_the_whole_hours_silver_wrote(spark, bronze):
    source, silver, gold = (fresh_dir(spark, name) for name in ("bronze", "silver", "gold"))
    write_bronze(with_ingest_hour(bronze({"ingest_ts": "2024-01-15T09:10:00"})), source)
    as_of = "2024-01-15T10:30:00"
    load_silver(spark, source, silver, "incremental", as_of, timedelta(hours=1))
    assert load_gold(spark, silver, gold, "incremental", as_of, timedelta(hours=1)) == gold
    assert spark.read.parquet(gold).count() == 1


def test_predict_without_silver(spark):
    missing = fresh_dir(spark, "missing")
    assert predict(spark, missing, missing, missing) is None
