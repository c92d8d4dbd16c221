from __future__ import annotations

import json

import pytest

from skytracks.operators.snapshot import flatten_snapshots, with_ingest_hour
from skytracks.plans.ingest import ingest
from skytracks.schemas import BRONZE, BoundingBox
from skytracks.sources.lake import read_bronze, read_snapshots

VECTOR = ["abc123", "AFR1  ", "France", 1705320000, 1705320001, 2.5, 48.25, 1000.0, False, 200.5, 90.0, -1.5]
TIME = 1705320030  # 2024-01-15T12:00:30


def documents(spark, *docs):
    texts = [doc if isinstance(doc, str) else json.dumps(doc, ensure_ascii=False) for doc in docs]
    return spark.createDataFrame([(text,) for text in texts], "value string")


def flat(spark, *docs, **options):
    return [row.asDict() for row in flatten_snapshots(documents(spark, *docs), **options).collect()]


def one(spark, **slots):
    names = [n for n in BRONZE.names if n != "ingest_ts"]
    vector = [slots.get(name, value) for name, value in zip(names, VECTOR, strict=True)]
    return flat(spark, {"time": TIME, "states": [vector]})[0]


def test_layout_and_values(spark):
    rows = flatten_snapshots(documents(spark, {"time": TIME, "states": [VECTOR]}))
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in BRONZE]
    assert rows.collect() == [
        ("2024-01-15T12:00:30", "abc123", "AFR1", "France", "2024-01-15T12:00:00", "2024-01-15T12:00:01",
         2.5, 48.25, 1000.0, False, 200.5, 90.0, -1.5)
    ]


@pytest.mark.parametrize("doc", [{"time": TIME, "states": None}, {"time": TIME}, {"time": TIME, "states": []}])
def test_no_states_no_rows(spark, doc):
    assert flat(spark, doc) == []


def test_short_and_long_vectors(spark):
    short, long = flat(spark, {"time": TIME, "states": [VECTOR[:2], VECTOR + [[1, 2], 900.0, "7000", False, 0] + [1] * 3]})
    assert short["icao24"] == "abc123" and short["callsign"] == "AFR1"
    assert all(short[name] is None for name in BRONZE.names[3:])
    assert long["vertical_rate"] == -1.5


@pytest.mark.parametrize("epoch", [0, 0.0, None])
def test_missing_epochs(spark, epoch):
    row = one(spark, time_position=epoch, last_contact=epoch)
    assert row["time_position"] is None and row["last_contact"] is None
    assert row["ingest_ts"] == "2024-01-15T12:00:30"


def test_epoch_fractions_are_cut(spark):
    assert one(spark, time_position=1705320000.9)["time_position"] == "2024-01-15T12:00:00"
    assert flat(spark, {"time": TIME + 0.7, "states": [VECTOR]})[0]["ingest_ts"] == "2024-01-15T12:00:30"


@pytest.mark.parametrize(
    ("raw", "clean"),
    [(None, ""), ("AFR1  ", "AFR1"), ("\tAFR 1\n", "AFR 1"), (" AFR1 ", "AFR1"), ("\x1cX\x85", "X"), ("  ", "")],
)
def test_callsign(spark, raw, clean):
    assert one(spark, callsign=raw)["callsign"] == clean


def test_mistyped_slots_become_null(spark):
    row = one(spark, lat="north", on_ground="yes", velocity=None)
    assert row["lat"] is None and row["on_ground"] is None and row["velocity"] is None
    assert row["lon"] == 2.5


def test_quoted_numbers_and_flags_become_null(spark):
    row = one(spark, lat="2.0", lon="1d", on_ground="true", time_position="1705320000", velocity=12, heading=1e2)
    assert [row[name] for name in ("lat", "lon", "on_ground", "time_position")] == [None] * 4
    assert (row["velocity"], row["heading"], row["vertical_rate"] is not None) == (12.0, 100.0, True)
    assert one(spark, lat=True)["lat"] is None and one(spark, on_ground=1)["on_ground"] is None


def test_unicode_and_quotes_survive(spark):
    assert one(spark, origin_country='Côte d\'Ivoire "CI"')["origin_country"] == 'Côte d\'Ivoire "CI"'


@pytest.mark.parametrize("bad", ["{broken", '{"states":[["a"]]}', '{"time":1,"states":[1,2]}', '{"time":"5","states":[["a"]]}'])
def test_malformed_documents(spark, bad):
    good = {"time": TIME, "states": [VECTOR]}
    with pytest.raises(Exception, match="malformed snapshot document"):
        flat(spark, good, bad)
    assert len(flat(spark, good, bad, on_malformed="skip")) == 1


def test_ingest_writes_padded_hours_and_nulls(spark, tmp_path):
    landing, bronze = tmp_path / "landing", tmp_path / "bronze"
    landing.mkdir()
    early = 1704157505  # 2024-01-02T01:05:05
    vector = VECTOR[:3] + [None] + VECTOR[4:]
    (landing / "a.json").write_text(json.dumps({"time": early, "states": [vector]}, indent=1))
    (landing / "b.json").write_text(json.dumps({"time": TIME, "states": [VECTOR, VECTOR[:6] + [60.0] + VECTOR[7:]]}))
    assert ingest(spark, str(landing), str(bronze)) == str(bronze)

    files = list((bronze / "ingest_year=2024/ingest_month=01/ingest_day=02/ingest_hour=01").glob("*.json"))
    assert len(files) == 1
    written = json.loads(files[0].read_text())
    assert written["time_position"] is None and list(written) == BRONZE.names

    rows = read_bronze(spark, str(bronze))
    assert rows.columns[-5:] == ["ingest_year", "ingest_month", "ingest_day", "ingest_hour", "source_file"]
    keys = {(r.ingest_year, r.ingest_month, r.ingest_day, r.ingest_hour) for r in rows.collect()}
    assert keys == {(2024, 1, 2, 1), (2024, 1, 15, 12)}
    assert rows.count() == 2  # the report at 60 degrees north is outside the default box
    assert all(r.source_file.endswith(".json") for r in rows.collect())


def test_ingest_replace_is_repeatable(spark, tmp_path):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    landing.mkdir()
    (landing / "lines.json").write_text("\n".join(json.dumps({"time": TIME + i, "states": [VECTOR]}) for i in range(3)))
    for _ in range(2):
        ingest(spark, str(landing), bronze, box=None, one_per_line=True, mode="replace")
    assert read_bronze(spark, bronze).count() == 3


def test_ingest_without_landing(spark, tmp_path):
    assert ingest(spark, str(tmp_path / "none"), str(tmp_path / "bronze")) is None
    assert not (tmp_path / "bronze").exists()


def test_custom_box(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text(json.dumps({"time": TIME, "states": [VECTOR]}))
    ingest(spark, str(landing), str(tmp_path / "b"), box=BoundingBox(48.25, 49.0, 2.5, 3.0))
    assert read_bronze(spark, str(tmp_path / "b")).count() == 1


def test_hour_keys_are_text(spark):
    rows = with_ingest_hour(flatten_snapshots(documents(spark, {"time": 1704157505, "states": [VECTOR]})))
    row = rows.collect()[0]
    assert (row.ingest_year, row.ingest_month, row.ingest_day, row.ingest_hour) == ("2024", "01", "02", "01")


def test_whole_file_or_lines(spark, tmp_path):
    (tmp_path / "two.json").write_text('{"time":1,\n"states":[]}\n')
    assert read_snapshots(spark, str(tmp_path)).count() == 1
    assert read_snapshots(spark, str(tmp_path), one_per_line=True).count() == 2
