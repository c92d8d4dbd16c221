"""Table layouts, feature lists and defaults."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import types as T

# Field names, feature order and defaults shared by every table and model.

BRONZE = T.StructType(
    [
        T.StructField("ingest_ts", T.StringType()),
        T.StructField("icao24", T.StringType()),
        T.StructField("callsign", T.StringType()),
        T.StructField("origin_country", T.StringType()),
        T.StructField("time_position", T.StringType()),
        T.StructField("last_contact", T.StringType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("baro_altitude", T.DoubleType()),
        T.StructField("on_ground", T.BooleanType()),
        T.StructField("velocity", T.DoubleType()),
        T.StructField("heading", T.DoubleType()),
        T.StructField("vertical_rate", T.DoubleType()),
    ]
)

INGEST_HOUR_KEYS = ("ingest_year", "ingest_month", "ingest_day", "ingest_hour")
SILVER_HOUR_KEYS = ("year", "month", "day", "hour")
GOLD_DAY_KEY = "ingest_date"

REPORT_TIMES = ("ingest_ts", "time_position", "last_contact")
REPORT_KEY = ("icao24", "time_position")
MEASUREMENTS = ("velocity", "heading", "vertical_rate", "baro_altitude")

FEATURES_14 = (
    "lat", "lon", "baro_altitude",
    "prev_lat", "prev_lon", "prev_alt",
    "velocity", "prev_velocity",
    "heading", "prev_heading",
    "vertical_rate",
    "accel", "turn_rate", "altitude_change",
)
FEATURES_8 = ("lat", "lon", "baro_altitude", "velocity", "heading", "vertical_rate", "accel", "turn_rate")

TARGETS = {"lat": "future_lat", "lon": "future_lon", "alt": "future_alt"}
HORIZON_ROWS = 5
NUM_TREES = 50
TRAIN_PERCENT = 80
SEED = 42

PREDICTION_COLUMNS = (
    "icao24", "time_position", "lat", "lon", "baro_altitude",
    "predicted_lat", "predicted_lon", "predicted_alt",
)

LOOKBACK = timedelta(hours=1)


@dataclass(frozen=True)
class BoundingBox:
    lamin: float = 41.0
    lamax: float = 51.5
    lomin: float = -5.5
    lomax: float = 9.5


def _int_fields(names) -> list[T.StructField]:
    return [T.StructField(name, T.IntegerType()) for name in names]


BRONZE_TABLE = T.StructType(BRONZE.fields + _int_fields(INGEST_HOUR_KEYS))

_TYPED = [
    T.StructField(f.name, T.TimestampType() if f.name in REPORT_TIMES else f.dataType) for f in BRONZE.fields
]
_STATES = _TYPED + _int_fields(INGEST_HOUR_KEYS) + [T.StructField("source_file", T.StringType())]

SILVER_TABLE = T.StructType(_STATES + _int_fields(SILVER_HOUR_KEYS))
GOLD_TABLE = T.StructType(_STATES + [T.StructField(GOLD_DAY_KEY, T.DateType())])
