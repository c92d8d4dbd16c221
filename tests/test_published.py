from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from skytracks.functions.times import DAY, HOUR, HourRange
from skytracks.operators.snapshot import with_ingest_hour
from skytracks.plans import gold, silver
from skytracks.plans.pipeline import Lake, run
from skytracks.plans.runs import read_runs
from skytracks.plans.train import fit_and_evaluate, training_set
from skytracks.schemas import GOLD_TABLE, SILVER_HOUR_KEYS, SILVER_TABLE
from skytracks.sources.lake import read_bronze, read_gold, read_silver, write_bronze
from skytracks.sources.published import compact_manifest, last_load, live_files, publish, read_published, remove_unused
from skytracks.sources.staged import StagedFile, StagedWriter, committed, read_loads
from skytracks.sources.tables import write_load
from skytracks.streaming.silver import stream_silver

START = datetime(2024, 3, 1, tzinfo=timezone.utc)


def report(position: datetime, ingested: datetime, aircraft: str, timed: bool = True, lat: float = 1.0) -> dict:
    text = "%Y-%m-%dT%H:%M:%S"
    return {"icao24": aircraft, "time_position": position.strftime(text) if timed else None, "ingest_ts": ingested.strftime(text), "lat": lat}


def copies(seed: int, count: int = 250) -> list[dict]:
    """Reports of three days, each with up to three copies from a minute to two days later; some without a position time."""
    made, rows = random.Random(seed), []
    for _ in range(count):
        at = START + timedelta(seconds=made.randrange(2 * 86400))
        name, timed = f"a{made.randrange(9)}", made.random() > 0.1
        for _ in range(made.choice([1, 1, 2, 3])):
            rows.append(report(at, at + timedelta(seconds=made.choice([60, 3600, 30 * 3600, 2 * 86400])), name, timed, float(made.randrange(5))))
    return rows


def plain(df):
    return sorted(str(row) for row in df.drop("source_file").collect())


@pytest.fixture
def write(spark, bronze):
    def build(path, rows):
        write_bronze(with_ingest_hour(bronze(*rows)), path, "overwrite")
        return path

    return build


def full(spark, bronze_path, tmp_path):
    silver.load_silver(spark, bronze_path, str(tmp_path / "whole"), "full")
    return plain(read_silver(spark, str(tmp_path / "whole")))


@pytest.mark.parametrize("seed", [1, 2])
def test_loads_in_any_order_give_the_full_load(spark, write, tmp_path, seed):
    made, rows = random.Random(seed), copies(seed)
    raw, path = write(str(tmp_path / "bronze"), rows), str(tmp_path / "silver")
    loads = [HourRange(START + 9 * HOUR * step, START + 9 * HOUR * (step + 1)) for step in range(12)]
    made.shuffle(loads)
    for hours in loads:
        silver.replace_hours(spark, raw, path, hours)
    assert plain(read_silver(spark, path)) == full(spark, raw, tmp_path)
    number = last_load(spark, path)
    silver.replace_hours(spark, raw, path, loads[3])
    assert last_load(spark, path) == number + 1 and plain(read_silver(spark, path)) == full(spark, raw, tmp_path)

    # Bronze loses half of its rows of one load, and another load becomes empty.
    fewer = [r for i, r in enumerate(rows) if i % 2 or not START + 18 * HOUR <= datetime.fromisoformat(r["ingest_ts"]).replace(tzinfo=timezone.utc) < START + 27 * HOUR]
    fewer = [r for r in fewer if not START + 36 * HOUR <= datetime.fromisoformat(r["ingest_ts"]).replace(tzinfo=timezone.utc) < START + 45 * HOUR]
    write(raw, fewer)
    for step in (2, 4):
        silver.load_silver(spark, raw, path, as_of=START + 9 * HOUR * (step + 1) - HOUR, lookback=8 * HOUR, overlap=0 * HOUR)
    assert plain(read_silver(spark, path)) == full(spark, raw, tmp_path)


def test_the_stream_finds_repeats_however_far_apart(spark, write, tmp_path):
    raw, path = write(str(tmp_path / "bronze"), copies(3, 60)), str(tmp_path / "silver")
    publish(spark.createDataFrame([], SILVER_TABLE), path, SILVER_HOUR_KEYS, [], F.col("ingest_ts"))
    stream_silver(spark, raw, path, str(tmp_path / "progress"), maxFilesPerTrigger=15).awaitTermination()
    assert plain(read_silver(spark, path)) == full(spark, raw, tmp_path)


def test_a_load_that_dies_leaves_the_old_state(spark, write, tmp_path):
    raw, path = write(str(tmp_path / "bronze"), copies(4, 60)), str(tmp_path / "silver")
    silver.load_silver(spark, raw, path, "full", published=True)
    before, number = plain(read_silver(spark, path)), last_load(spark, path)
    rows = read_silver(spark, path)
    # Some hours are written before the write fails.
    failing = rows.withColumn("lat", F.when(F.col("ingest_ts") > F.lit(START + DAY), F.raise_error(F.lit("lost"))).otherwise(F.col("lat") + 1))
    with pytest.raises(PySparkException):
        publish(failing, path, SILVER_HOUR_KEYS, None, F.date_trunc("hour", "ingest_ts"))
    # All hours are written, but the load does not get as far as its manifest.
    rows.withColumn("lat", F.col("lat") + 1).write.partitionBy(*SILVER_HOUR_KEYS).parquet(f"{path}/load=000000009-x")
    assert plain(read_silver(spark, path)) == before and last_load(spark, path) == number
    assert "load=000000009-x" in remove_unused(spark, path)
    assert plain(read_silver(spark, path)) == before


def test_a_reader_keeps_the_state_it_began_with(spark, write, tmp_path):
    raw, path = write(str(tmp_path / "bronze"), copies(5, 60)), str(tmp_path / "silver")
    silver.load_silver(spark, raw, path, "full", published=True)
    reading = read_silver(spark, path)
    before = reading.count()
    write(raw, copies(6, 20))
    silver.load_silver(spark, raw, path, "full")
    assert reading.count() == before != read_silver(spark, path).count()
    assert len(remove_unused(spark, path)) == 1


def test_of_two_loads_begun_at_once_the_later_fails(spark, write, tmp_path, monkeypatch):
    raw, path = write(str(tmp_path / "bronze"), copies(7, 30)), str(tmp_path / "silver")
    silver.load_silver(spark, raw, path, "full", published=True)
    before = plain(read_silver(spark, path))
    monkeypatch.setattr("skytracks.sources.published.last_load", lambda *_: None)
    with pytest.raises(PySparkException, match="PATH_ALREADY_EXISTS|already exists"):
        publish(read_silver(spark, path).limit(1), path, SILVER_HOUR_KEYS, None, F.date_trunc("hour", "ingest_ts"))
    monkeypatch.undo()
    assert plain(read_silver(spark, path)) == before


def test_compacted_manifest(spark, write, tmp_path):
    raw, path = write(str(tmp_path / "bronze"), copies(8, 60)), str(tmp_path / "silver")
    silver.load_silver(spark, raw, path, "full", published=True)
    for hour in range(3):
        silver.replace_hours(spark, raw, path, HourRange(START + hour * HOUR, START + (hour + 1) * HOUR))
    before, files = plain(read_silver(spark, path)), live_files(spark, path).count()
    compact_manifest(spark, path)
    assert plain(read_silver(spark, path)) == before and live_files(spark, path).count() == files
    silver.replace_hours(spark, raw, path, HourRange(START, START + HOUR))
    assert plain(read_silver(spark, path)) == before


def test_a_few_aircraft_need_a_few_files(spark, write, tmp_path):
    path, name = str(tmp_path / "silver"), "spark.sql.adaptive.enabled"
    rows = [report(START + timedelta(seconds=i), START + timedelta(seconds=i), f"x{i % 60:02d}") for i in range(600)]
    made = silver.silver_rows(read_bronze(spark, write(str(tmp_path / "bronze"), rows))).select(*SILVER_TABLE.names)
    before = spark.conf.get(name)
    try:
        # Without merging, each range of aircraft is a file.
        spark.conf.set(name, "false")
        publish(made, path, SILVER_HOUR_KEYS, None, F.date_trunc("hour", "ingest_ts"), ranged=True)
    finally:
        spark.conf.set(name, before)
    whole = read_silver(spark, path)
    few = read_silver(spark, path, aircraft=["x03", "x04"])
    assert plain(few) == plain(whole.filter("icao24 in ('x03', 'x04')")) and few.count() == 20
    assert 0 < len(few.inputFiles()) <= 3 < len(whole.inputFiles())
    assert read_silver(spark, path, aircraft=["nobody"]).count() == 0
    hour = HourRange(START + 5 * HOUR, START + 6 * HOUR)
    assert read_silver(spark, path, hour).count() == read_silver(spark, path, hour, aircraft=["x03"]).count() == 0


def test_gold_follows_silver(spark, write, tmp_path):
    raw, path, published = write(str(tmp_path / "bronze"), copies(9, 80)), str(tmp_path / "silver"), str(tmp_path / "gold")
    assert gold.load_gold(spark, path, published) is None
    silver.replace_hours(spark, raw, path, HourRange(START, START + 30 * HOUR))
    assert gold.load_gold(spark, path, published, table="t_gold") == published
    assert gold.load_gold(spark, path, published) is None
    silver.replace_hours(spark, raw, path, HourRange(START + 30 * HOUR, START + 5 * DAY))
    gold.load_gold(spark, path, published, table="t_gold")
    assert plain(read_gold(spark, published)) == plain(gold.gold_rows(read_silver(spark, path)).select(*GOLD_TABLE.names))
    assert plain(spark.table("t_gold").select(*GOLD_TABLE.names)) == plain(read_gold(spark, published))
    write(raw, [])
    silver.replace_hours(spark, raw, path, HourRange(START, START + 5 * DAY))
    gold.load_gold(spark, path, published)
    assert read_silver(spark, path).isEmpty() and read_gold(spark, published).isEmpty()


def test_plain_tables_are_not_published(spark, write, tmp_path):
    raw, path = write(str(tmp_path / "bronze"), copies(10, 10)), str(tmp_path / "silver")
    silver.load_silver(spark, raw, path, "full")
    assert last_load(spark, path) is None and read_published(spark, path, SILVER_TABLE) is None
    assert silver.replace_hours(spark, str(tmp_path / "nothing"), path, HourRange(START, START + HOUR)) is None


# --- the sink and the run table -------------------------------------------------------------------------------------


def test_a_load_is_taken_once(spark, tmp_path):
    path, rows = str(tmp_path / "sink"), spark.range(100).selectExpr("id", "string(id) as name")
    write_load(rows, "staged_loads", path=path)
    write_load(rows.repartition(7), "staged_loads", path=path)
    assert read_loads(spark, path, rows.schema).count() == 100 and len(committed(path)) == 1
    write_load(rows.filter("id < 10"), "staged_loads", path=path)
    write_load(rows, "staged_loads", path=path, load="named")
    write_load(rows.limit(0), "staged_loads", path=path, load="nothing")
    assert read_loads(spark, path, rows.schema).count() == 210
    assert [entry["rows"] for entry in committed(path)] == [100, 10, 100, 0]


def test_a_failed_or_repeated_task_leaves_nothing(spark, tmp_path):
    path, rows = str(tmp_path / "sink"), spark.range(8).repartition(4)
    with pytest.raises(PySparkException):
        write_load(rows.withColumn("bad", F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(1)), "staged_loads", path=path, load="one")
    assert committed(path) == []
    write_load(rows, "staged_loads", path=path, load="one")
    writer = StagedWriter(path, "one", False)
    twice = writer.write(iter(rows.toArrow().to_batches()))
    writer.commit([twice, StagedFile(None, 0), None])
    assert read_loads(spark, path, rows.schema).count() == 8


def test_run_table_published_lake_and_connector(spark, tmp_path, write):
    root, sink = str(tmp_path / "lake"), str(tmp_path / "sink")
    lake = Lake(root)
    write(lake.bronze, copies(11, 100))
    options = {"with_predictions": False, "connector": "staged_loads", "connector_options": {"path": sink}}
    run(spark, root, mode="full", as_of=START + DAY, published=True, **options)
    run(spark, root, as_of=START + DAY, **options)
    rows = {(row["mode"], row["stage"], row["measure"]): row["value"] for row in read_runs(spark, lake.runs).collect()}
    assert rows["full", "silver", "rows_in"] == read_bronze(spark, lake.bronze).count()
    assert rows["full", "silver", "rows_out"] == rows["full", "gold", "rows_out"] == read_silver(spark, lake.silver).count()
    assert plain(read_gold(spark, lake.gold)) == plain(gold.gold_rows(read_silver(spark, lake.silver)).select(*GOLD_TABLE.names))
    assert committed(sink)[0]["rows"] == read_gold(spark, lake.gold).count()


def test_fits_read_training_rows_without_an_exchange(spark, write, tmp_path, monkeypatch):
    from skytracks.plans import train

    plans = []
    fit = train.fit_forests
    monkeypatch.setattr(train, "fit_forests", lambda rows, *a, **k: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or fit(rows, *a, **k))
    rows = [report(START + timedelta(seconds=9 * i), START + timedelta(seconds=9 * i), f"a{i % 3}", lat=float(i % 50)) for i in range(90)]
    path = write(str(tmp_path / "bronze"), rows)
    fit_and_evaluate(training_set(silver.silver_rows(read_bronze(spark, path))), num_trees=2, maxDepth=2)
    assert len(plans) == 1 and "Exchange" not in plans[0] and "Sort" not in plans[0]
