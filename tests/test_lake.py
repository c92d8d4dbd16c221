from __future__ import annotations

from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL
from skytracks.functions.times import HOUR, HourRange, as_utc
from skytracks.operators.clean import in_box, recent, typed_times, valid_reports
from skytracks.operators.counts import counted
from skytracks.operators.snapshot import with_ingest_hour
from skytracks.operators.split import in_train_part
from skytracks.plans import fixtures
from skytracks.plans.gold import load_gold
from skytracks.plans.silver import load_silver, recent_silver_rows, silver_rows
from skytracks.plans.train import training_set
from skytracks.schemas import GOLD_TABLE, SILVER_HOUR_KEYS, SILVER_TABLE, BoundingBox
from skytracks.sources import lake
from skytracks.sources.tables import write_connector, write_table

AS_OF = "2024-01-15T12:00:00"


def put(df, path):
    lake.write_bronze(with_ingest_hour(df), str(path))
    return str(path)


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    """Bronze and a full silver load of the smallest fixture."""
    root = tmp_path_factory.mktemp("lake")
    bronze = put(fixtures.bronze_reports(spark, SMALL), root / "bronze")
    load_silver(spark, bronze, str(root / "silver"), "full")
    return bronze, str(root / "silver")


def test_reports_without_ingest_time_stay_in_a_full_load(spark, bronze, tmp_path):
    path = put(bronze({}, {"ingest_ts": "unknown", "icao24": "undated"}), tmp_path / "bronze")
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    load_silver(spark, path, silver, "full")
    load_gold(spark, silver, gold, "full")
    for rows in (lake.read_silver(spark, silver), spark.read.parquet(gold)):
        assert sorted((r.icao24, r.ingest_ts is None) for r in rows.collect()) == [("abc123", False), ("undated", True)]


def same(left, right):
    columns = left.columns
    return left.exceptAll(right.select(*columns)).isEmpty() and right.select(*columns).exceptAll(left).isEmpty()


def test_bad_bronze_lines_and_fields(spark, tmp_path):
    hour = tmp_path / "ingest_year=2024/ingest_month=01/ingest_day=15/ingest_hour=09"
    hour.mkdir(parents=True)
    good = (
        '"ingest_ts":"2024-01-15T09:00:00","icao24":"%s","lon":1.0,"velocity":1,"heading":1.0,'
        '"vertical_rate":0.0,"baro_altitude":10.0,"unknown":[1],"lat":%s'
    )
    lines = [good % ("ok", "45"), good % ("text", '"45.0"'), good % ("nan", '"NaN"')]
    (hour / "x.ndjson").write_text("\n".join(["{broken", *("{" + line + "}" for line in lines)]))
    rows = lake.read_bronze(spark, str(tmp_path))
    assert rows.count() == 4 and rows.filter("icao24 IS NULL").count() == 1
    assert rows.filter("icao24 = 'text'").collect()[0].lat is None
    kept = silver_rows(rows).collect()
    assert [(r.icao24, r.velocity, r.ingest_month, r.callsign) for r in kept] == [("ok", 1.0, 1, None)]
    assert kept[0].source_file.endswith("ingest_hour=09/x.ndjson")


def test_full_load_layout(spark, full):
    silver = lake.read_silver(spark, full[1])
    assert silver.columns == SILVER_TABLE.names
    assert spark.read.parquet(full[1]).schema["ingest_ts"].dataType.typeName() == "timestamp"
    assert silver.count() == 888
    assert silver.groupBy("icao24", "time_position").count().filter("count > 1").isEmpty()
    parts = silver.filter("year <> year(ingest_ts) OR month <> month(ingest_ts) OR day <> day(ingest_ts) OR hour <> hour(ingest_ts)")
    assert parts.isEmpty()


def test_full_load_replaces_everything(spark, full, tmp_path, bronze):
    silver = str(tmp_path / "silver")
    load_silver(spark, full[0], silver, "full")
    load_silver(spark, put(bronze({}), tmp_path / "bronze"), silver, "full")
    assert lake.read_silver(spark, silver).count() == 1


def test_one_file_per_hour(full):
    hours = {f.parent for f in Path(full[1]).rglob("*.parquet")}
    files = list(Path(full[1]).rglob("*.parquet"))
    assert len(files) == len(hours)


def test_a_large_directory_is_split(spark, tmp_path):
    """A third and more of all rows in one hour is written by several tasks."""
    rows = spark.range(0, 400_000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("icao24"), F.lit("x").alias("time_position"),
        F.lit(2024).alias("year"), F.lit(1).alias("month"), F.lit(1).alias("day"),
        F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 24).cast("int").alias("hour"),
    )
    name, size = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m"
    before = spark.conf.get(name)
    spark.conf.set(name, size)
    try:
        lake.write_silver(rows, str(tmp_path), "overwrite")
    finally:
        spark.conf.set(name, before)
    assert len(list((tmp_path / "year=2024/month=1/day=1/hour=5").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path)).count() == 400_000


def incremental(spark, bronze, silver, as_of, hours=1):
    return load_silver(spark, bronze, silver, "incremental", as_of, hours * HOUR)


def test_repeating_a_load_changes_nothing(spark, full, tmp_path):
    silver = str(tmp_path / "silver")
    incremental(spark, full[0], silver, AS_OF, 6)
    once = [tuple(r) for r in lake.read_silver(spark, silver).collect()]
    incremental(spark, full[0], silver, AS_OF, 6)
    twice = [tuple(r) for r in lake.read_silver(spark, silver).collect()]
    assert once and sorted(map(str, once)) == sorted(map(str, twice))


def test_increments_add_up_to_the_full_load(spark, full, tmp_path):
    silver = str(tmp_path / "silver")
    moment, end = as_utc("2024-01-01T10:00:00"), as_utc("2024-01-31T12:00:00")
    while moment < end + 47 * HOUR:
        incremental(spark, full[0], silver, moment, 47)
        moment += 48 * HOUR
    incremental(spark, full[0], silver, "2024-01-15T15:00:00", 3)  # a back-fill inside
    timed = "time_position IS NOT NULL"
    assert same(lake.read_silver(spark, silver).filter(timed), lake.read_silver(spark, full[1]).filter(timed))


def test_repeat_across_the_hour_boundary(spark, bronze, tmp_path):
    path = put(bronze({"ingest_ts": "2024-01-15T09:59:00"}, {"ingest_ts": "2024-01-15T10:00:00"}), tmp_path / "bronze")
    silver = str(tmp_path / "silver")
    incremental(spark, path, silver, "2024-01-15T09:59:30", 0)
    incremental(spark, path, silver, "2024-01-15T10:00:30", 0)
    rows = lake.read_silver(spark, silver).collect()
    assert [(r.hour, r.ingest_ts.minute) for r in rows] == [(9, 59)]


def test_back_fill_removes_a_later_copy(spark, bronze, tmp_path):
    path, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    put(bronze({"ingest_ts": "2024-01-15T10:00:00"}), path)
    put(bronze({"ingest_ts": "2024-01-15T10:30:00", "icao24": "other"}), path)
    incremental(spark, path, silver, "2024-01-15T10:30:00", 0)
    assert lake.read_silver(spark, silver).count() == 2
    put(bronze({"ingest_ts": "2024-01-15T09:50:00"}), path)
    incremental(spark, path, silver, "2024-01-15T09:55:00", 0)
    assert sorted((r.icao24, r.hour) for r in lake.read_silver(spark, silver).collect()) == [("abc123", 9), ("other", 10)]


def test_nothing_to_load(spark, full, tmp_path):
    assert load_silver(spark, str(tmp_path / "none"), str(tmp_path / "silver"), "full") is None
    assert incremental(spark, full[0], str(tmp_path / "silver"), "2031-01-01T00:00:00") is None
    assert load_gold(spark, str(tmp_path / "none"), str(tmp_path / "gold"), "full") is None
    assert load_gold(spark, full[1], str(tmp_path / "gold"), "incremental", "2031-01-01T00:00:00") is None
    assert not (tmp_path / "silver").exists() and not (tmp_path / "gold").exists()


def test_other_read_problems_are_raised(spark):
    def broken():
        return spark.range(1).select("no_such_column")

    with pytest.raises(Exception, match="no_such_column"):
        lake.read_if_present(broken)


def test_hours_limit_listing_and_reading(spark, full):
    hours = HourRange.covering(as_utc(AS_OF), 3 * HOUR)
    for rows, key in (
        (lake.read_bronze(spark, full[0], hours), "ingest_year"),
        (lake.read_silver(spark, full[1], hours), "year"),
    ):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert f"({key}#" in plan.split("PartitionFilters: [")[1]
        assert all("day=15" in f for f in rows.inputFiles()) and len(rows.inputFiles()) <= 4
    whole = lake.read_silver(spark, full[1])
    assert same(lake.read_silver(spark, full[1], hours), whole.filter(hours.contains(F.col("ingest_ts"))))


def test_recent_rows_skip_older_directories(spark, full):
    silver = lake.read_silver(spark, full[1])
    rows = recent(silver, "2024-01-29T12:30:00")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "(year#" in plan.split("PartitionFilters: [")[1] and "GreaterThan(ingest_ts" in plan
    assert same(rows, silver.filter("ingest_ts > timestamp'2024-01-29 11:30:00'")) and not rows.isEmpty()
    bronze = lake.read_bronze(spark, full[0])
    fresh = recent_silver_rows(bronze, "2024-01-29T12:30:00")
    assert "(ingest_year#" in fresh._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1]
    unpruned = silver_rows(bronze.filter("ingest_ts > '2024-01-29T11:30:00'"))
    assert same(fresh, unpruned)
    assert recent(silver).isEmpty()


def test_a_long_range_lists_the_table_instead(spark, full):
    hours = HourRange(as_utc("2010-01-01T01:00:00"), as_utc("2024-01-15T13:00:00"))
    rows = lake.read_silver(spark, full[1], hours)
    assert same(rows, lake.read_silver(spark, full[1]).filter(hours.contains(F.col("ingest_ts"))))


def test_columns_reach_the_scan(spark, full):
    plan = lake.read_silver(spark, full[1]).filter("lat > 45").select("icao24")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<icao24:string,lat:double>" in plan and "GreaterThan(lat,45.0)" in plan


def test_gold_full_and_recursive_scan(spark, full, tmp_path):
    gold = str(tmp_path / "gold")
    assert load_gold(spark, full[1], gold, "full") == gold
    rows = spark.read.parquet(gold)
    assert rows.columns == GOLD_TABLE.names and rows.count() == 888
    flat = lake.read_flat(spark, full[1])
    assert not set(SILVER_HOUR_KEYS) & set(flat.columns)
    assert same(flat, rows.drop("ingest_date"))
    load_gold(spark, full[1], gold, "full", merge_schema=True)
    assert spark.read.parquet(gold).count() == 888


def test_gold_increment_rebuilds_whole_days(spark, full, tmp_path):
    gold = str(tmp_path / "gold")
    for _ in range(2):
        load_gold(spark, full[1], gold, "incremental", AS_OF)
    rows = spark.read.parquet(gold)
    assert {str(r.ingest_date) for r in rows.select("ingest_date").distinct().collect()} == {"2024-01-15"}
    assert rows.count() == lake.read_silver(spark, full[1]).filter("month = 1 AND day = 15").count()


def test_gold_skips_when_nothing_is_recent(spark, bronze, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    load_silver(spark, put(bronze({"ingest_ts": "2024-01-15T09:00:00"}), tmp_path / "bronze"), silver, "full")
    assert load_gold(spark, silver, gold, "incremental", AS_OF) is None


def test_missing_columns_are_covered(spark, full, tmp_path):
    old = lake.read_silver(spark, full[1]).drop("origin_country").filter("day = 1")
    lake.write_silver(old, str(tmp_path), "overwrite")
    lake.write_silver(lake.read_silver(spark, full[1]).filter("day = 2"), str(tmp_path), "append")
    for rows in (lake.read_silver(spark, str(tmp_path)), lake.read_silver(spark, str(tmp_path), merge_schema=True)):
        assert not rows.filter("day = 1").isEmpty()
        assert rows.filter("day = 1 AND origin_country IS NOT NULL").isEmpty()
        assert rows.filter("day = 2 AND origin_country IS NULL").isEmpty()


def test_table_modes(spark, full, tmp_path):
    silver = lake.read_silver(spark, full[1])
    rows = silver.select("icao24", "lat", F.col("ingest_ts").cast("date").alias("ingest_date"))
    write_table(rows, "t_modes", partition_by="ingest_date")
    assert spark.table("t_modes").count() == 888
    one_day = rows.filter("ingest_date = date'2024-01-15'")
    write_table(one_day.select("lat", "ingest_date", "icao24"), "t_modes", "replace")
    assert spark.table("t_modes").count() == 888
    assert spark.table("t_modes").filter("length(icao24) <> 6").isEmpty()
    write_table(one_day, "t_modes", "append")
    assert spark.table("t_modes").count() == 888 + one_day.count()
    with pytest.raises(ValueError, match="columns"):
        write_table(one_day.drop("lat"), "t_modes", "append")
    write_table(one_day, "t_modes", "overwrite", partition_by="ingest_date")
    assert spark.table("t_modes").count() == one_day.count()


def test_gold_to_table(spark, full, tmp_path):
    for _ in range(2):
        load_gold(spark, full[1], str(tmp_path / "gold"), "full", table="t_gold")
    assert spark.table("t_gold").count() == 888
    load_gold(spark, full[1], str(tmp_path / "gold"), "incremental", AS_OF, table="t_gold")
    assert spark.table("t_gold").count() == 888


def test_connector_failures_are_raised(spark, tmp_path):
    write_connector(spark.range(3), "parquet", "append", path=str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    with pytest.raises(Exception, match="no_such_connector"):
        write_connector(spark.range(3), "no_such_connector", table="a.b")


def test_counts_come_with_the_work(spark, full, tmp_path):
    rows, seen = counted(lake.read_silver(spark, full[1]), "silver")
    rows.write.parquet(str(tmp_path / "copy"))
    assert seen.get["rows"] == 888


def test_silver_from_files_equals_silver_from_rows(spark, full):
    direct = silver_rows(fixtures.bronze_reports(spark, SMALL))
    assert same(direct, lake.read_silver(spark, full[1]))


def test_lookback_is_a_parameter(spark, full, tmp_path):
    load_silver(spark, full[0], str(tmp_path / "s"), "incremental", AS_OF, timedelta(minutes=150))
    hours = {r.hour for r in lake.read_silver(spark, str(tmp_path / "s")).select("hour").distinct().collect()}
    assert hours <= {9, 10, 11, 12, 13}


def test_known_counts(spark):
    bronze = fixtures.bronze_reports(spark, MEDIUM).cache()
    silver = silver_rows(bronze).cache()
    assert bronze.count() == 11_000 and valid_reports(bronze).count() == 9_801
    assert bronze.select("ingest_ts").distinct().count() == 721
    assert in_box(bronze).count() == 10_608 and in_box(bronze, BoundingBox(43, 48, 0, 6)).count() == 2_056
    assert recent(typed_times(bronze), AS_OF).count() == 5_702
    assert silver.count() == 8_891 and silver.filter("time_position IS NULL").count() == 71
    histories = silver.groupBy("icao24").count()
    usable = histories.agg(F.sum(F.greatest(F.lit(0), F.col("count") - 6)).alias("n")).collect()[0].n
    assert histories.count() == 150 and training_set(silver).count() == usable == 7_991
    flags = training_set(silver).select(in_train_part().alias("t")).groupBy("t").count()
    assert {r.t: r["count"] for r in flags.collect()} == {True: 6_426, False: 1_565}
