"""The registered queries as SQL for a second engine (DuckDB) over the same tables."""

from __future__ import annotations

from skytracks.schemas import FEATURES_8, FEATURES_14, TARGETS


def _iso(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%dT%H:%M:%S')"


_BRONZE = f"""
WITH reported AS (
  SELECT event_id, user_id, value, date_trunc('second', ts) AS tp,
         date_trunc('hour', ts) + INTERVAL 1 HOUR AS snap FROM events
  UNION ALL
  SELECT event_id, user_id, value, date_trunc('second', ts),
         date_trunc('hour', ts) + INTERVAL 2 HOUR FROM events WHERE event_id % 10 = 0
), bronze AS (
  SELECT {_iso('snap')} AS ingest_ts,
    CASE WHEN event_id % 97 = 0 THEN NULL
         ELSE lpad(CAST(user_id AS VARCHAR), 6, '0') END AS icao24,
    CASE WHEN event_id % 11 = 0 THEN '' ELSE 'FL' || CAST(user_id AS VARCHAR) END AS callsign,
    CASE user_id % 4 WHEN 0 THEN 'France' WHEN 1 THEN 'Spain' WHEN 2 THEN 'Italy'
         ELSE 'Germany' END AS origin_country,
    CASE WHEN event_id % 101 = 0 THEN NULL ELSE {_iso('tp')} END AS time_position,
    {_iso('tp')} AS last_contact,
    CASE WHEN event_id % 79 = 0 THEN NULL
         ELSE CAST((event_id * 104729) % 1500 AS DOUBLE) / CAST(100 AS DOUBLE)
              - CAST(5.5 AS DOUBLE) END AS lon,
    CASE WHEN event_id % 83 = 0 THEN NULL
         WHEN event_id % 89 = 0 THEN CAST(95 AS DOUBLE)
         ELSE CAST(41 AS DOUBLE)
              + CAST((event_id * 7919) % 1050 AS DOUBLE) / CAST(100 AS DOUBLE) END AS lat,
    CASE WHEN event_id % 53 = 0 THEN NULL ELSE value * CAST(20 AS DOUBLE) END AS baro_altitude,
    event_id % 13 = 0 AS on_ground,
    CASE WHEN event_id % 59 = 0 THEN NULL ELSE value END AS velocity,
    CASE WHEN event_id % 61 = 0 THEN NULL
         ELSE CAST((event_id * 31) % 360 AS DOUBLE) END AS heading,
    CASE WHEN event_id % 67 = 0 THEN NULL
         ELSE CAST(event_id % 41 - 20 AS DOUBLE) / CAST(2 AS DOUBLE) END AS vertical_rate
  FROM reported
), typed AS (
  SELECT * REPLACE (CAST(ingest_ts AS TIMESTAMP) AS ingest_ts,
                    CAST(time_position AS TIMESTAMP) AS time_position,
                    CAST(last_contact AS TIMESTAMP) AS last_contact)
  FROM bronze
), valid AS (
  SELECT * FROM typed
  WHERE icao24 IS NOT NULL AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180
    AND velocity IS NOT NULL AND heading IS NOT NULL
    AND vertical_rate IS NOT NULL AND baro_altitude IS NOT NULL
)"""

_FIRST = """row_number() OVER (PARTITION BY icao24, time_position
    ORDER BY ingest_ts, last_contact, callsign, origin_country, lon, lat, baro_altitude,
             on_ground, velocity, heading, vertical_rate) = 1"""


def _hour_keys(*names: str) -> str:
    parts = zip(("year", "month", "day", "hour"), names, strict=True)
    return ", ".join(f"CAST({part}(ingest_ts) AS INTEGER) AS {name}" for part, name in parts)


_INGEST_HOUR = _hour_keys("ingest_year", "ingest_month", "ingest_day", "ingest_hour")
_SILVER_HOUR = _hour_keys("year", "month", "day", "hour")

_SILVER = f"""{_BRONZE}, silver AS (
  SELECT *, {_SILVER_HOUR} FROM valid QUALIFY {_FIRST}
)"""

_MOTION = f"""{_SILVER}, looked_up AS (
  SELECT icao24, time_position, ingest_ts, lat, lon, baro_altitude, velocity, heading, vertical_rate,
    lag(lat) OVER w AS prev_lat, lag(lon) OVER w AS prev_lon, lag(baro_altitude) OVER w AS prev_alt,
    lag(velocity) OVER w AS prev_velocity, lag(heading) OVER w AS prev_heading,
    lag(time_position) OVER w AS prev_time,
    lead(lat, 5) OVER w AS future_lat, lead(lon, 5) OVER w AS future_lon,
    lead(baro_altitude, 5) OVER w AS future_alt
  FROM silver WINDOW w AS (PARTITION BY icao24 ORDER BY time_position NULLS FIRST)
), elapsed AS (
  SELECT *, CAST(epoch(time_position) AS BIGINT) - CAST(epoch(prev_time) AS BIGINT) AS time_diff_sec
  FROM looked_up
), motion AS (
  SELECT *,
    CASE WHEN time_diff_sec <> 0 THEN (velocity - prev_velocity) / time_diff_sec
         ELSE CAST(0 AS DOUBLE) END AS accel,
    CASE WHEN time_diff_sec <> 0 THEN (heading - prev_heading) / time_diff_sec
         ELSE CAST(0 AS DOUBLE) END AS turn_rate,
    baro_altitude - prev_alt AS altitude_change
  FROM elapsed
)"""


def _complete(features) -> str:
    return " AND ".join(f"{name} IS NOT NULL" for name in (*features, *TARGETS.values()))


_TRAINING = f"""{_MOTION}, training AS (SELECT * FROM motion WHERE {_complete(FEATURES_14)}),
flagged AS (
  SELECT *, CAST('0x' || substr(md5(icao24 || '|'
           || coalesce(CAST(CAST(epoch(time_position) AS BIGINT) AS VARCHAR), '')), 1, 8) AS BIGINT)
           % 100 < 80 AS is_train
  FROM training
)"""

_TIMES = ", ".join(f"{_iso(name)} AS {name}" for name in ("ingest_ts", "time_position", "last_contact"))
_MOTION_TIMES = ", ".join(f"{_iso(name)} AS {name}" for name in ("ingest_ts", "time_position", "prev_time"))
_POSITION_TIME = f"{_iso('time_position')} AS time_position"
_GOLD = f"* EXCLUDE (year, month, day, hour) REPLACE ({_TIMES}), " \
        f"CAST(CAST(ingest_ts AS DATE) AS VARCHAR) AS ingest_date"
_WITH_INGEST_HOUR = f"SELECT * REPLACE ({_TIMES}), {_INGEST_HOUR} FROM typed"
_IN_DEFAULT_BOX = "lat BETWEEN 41 AND 51.5 AND lon BETWEEN -5.5 AND 9.5"
_RECENT = "ingest_ts > TIMESTAMP '2024-01-15 11:00:00'"
_SILVER_WITH_INGEST = f"SELECT * REPLACE ({_TIMES}), {_INGEST_HOUR} FROM silver"


def _slots(features) -> str:
    return ", ".join(f"{name} AS f{i}" for i, name in enumerate(features))


def _stay_error(name: str, now: str, label: str) -> str:
    return f"SELECT '{name}' AS target, round(sqrt(avg(pow({label} - {now}, 2))), 6) AS rmse, " \
           f"count(*) AS rows FROM training"


def _mean_error(name: str, label: str) -> str:
    return f"SELECT '{name}' AS target, round(sqrt(avg(pow({label} - mean_{name}, 2))), 6) AS rmse, " \
           f"count(*) AS rows FROM flagged, means WHERE NOT is_train"


_MEANS = f"""{_TRAINING}, means AS (
  SELECT {', '.join(f'avg({label}) AS mean_{name}' for name, label in TARGETS.items())} FROM flagged WHERE is_train
)"""
_SCORABLE = " AND ".join(f"{name} IS NOT NULL" for name in FEATURES_14)
_LOADED_HOURS = "ingest_ts >= TIMESTAMP '2024-01-15 00:00:00' AND ingest_ts < TIMESTAMP '2024-01-15 14:00:00'"
_LOADED = f"""{_BRONZE}, overlapping AS (
  SELECT * FROM valid
  WHERE ingest_ts >= TIMESTAMP '2024-01-14 23:00:00' AND ingest_ts < TIMESTAMP '2024-01-15 14:00:00'
  QUALIFY {_FIRST}
), silver AS (
  SELECT *, {_SILVER_HOUR} FROM overlapping WHERE ingest_ts >= TIMESTAMP '2024-01-15 00:00:00'
)"""


# Every seventh report once more thirty hours later, and an hour that bronze has lost.
_COPIED = _BRONZE.replace("), bronze AS (", """  UNION ALL
  SELECT event_id, user_id, value, tp, snap + INTERVAL 30 HOUR FROM twice WHERE event_id % 7 = 0
), bronze AS (""").replace("WITH reported AS (", """WITH twice AS (
  SELECT event_id, user_id, value, date_trunc('second', ts) AS tp, date_trunc('hour', ts) + INTERVAL 1 HOUR AS snap FROM events
  UNION ALL
  SELECT event_id, user_id, value, date_trunc('second', ts), date_trunc('hour', ts) + INTERVAL 2 HOUR
  FROM events WHERE event_id % 10 = 0
), reported AS (""")
_EMPTIED = f"""{_COPIED}, left_over AS (
  SELECT * FROM valid WHERE date_trunc('hour', ingest_ts) <> TIMESTAMP '2024-01-15 12:00:00'
), silver AS (
  SELECT *, {_SILVER_HOUR} FROM left_over QUALIFY {_FIRST}
)"""


# The same tables of the reports inside the default box, which is what a whole run takes.
_BOXED_MEANS = _MEANS.replace("AND velocity IS NOT NULL", f"AND {_IN_DEFAULT_BOX} AND velocity IS NOT NULL", 1)


def _measure(stage: str, measure: str, value: str, table: str) -> str:
    return f"SELECT '{stage}' AS stage, '{measure}' AS measure, CAST({value} AS DOUBLE) AS value FROM {table}"


_RUN_COUNTS = " UNION ALL ".join(
    (
        _measure("bronze", "rows_in", "count(*)", "bronze"),
        _measure("bronze", "rows_out", "count(*)", f"bronze WHERE {_IN_DEFAULT_BOX}"),
        _measure("silver", "rows_in", "count(*)", f"bronze WHERE {_IN_DEFAULT_BOX}"),
        _measure("silver", "rows_out", "count(*)", "silver"),
        _measure("models", "test_rows", "count(*)", "flagged WHERE NOT is_train"),
        *(_measure("models", f"rmse_{name}", f"round(sqrt(avg(pow({label} - mean_{name}, 2))), 6)", "flagged, means WHERE NOT is_train")
          for name, label in TARGETS.items()),
        _measure("predictions", "rows_out", "count(*)", f"motion WHERE {_SCORABLE}"),
        _measure("gold", "rows_out", "count(*)", "silver"),
    )
)


ORACLES: dict[str, str] = {
    "run_counts": f"{_BOXED_MEANS} {_RUN_COUNTS}",
    "whole_run_predictions": f"""{_BOXED_MEANS} SELECT icao24, {_POSITION_TIME}, lat, lon, baro_altitude,
        {', '.join(f'round(mean_{name}, 6) AS predicted_{name}' for name in TARGETS)},
        CAST(CAST(ingest_ts AS DATE) AS VARCHAR) AS ingest_date FROM motion, means WHERE {_SCORABLE}""",
    "bronze_scan": f"{_BRONZE} SELECT * FROM bronze",
    "bronze_roundtrip": f"{_BRONZE} {_WITH_INGEST_HOUR}",
    "snapshot_flatten": f"{_BRONZE} SELECT * FROM bronze",
    "snapshot_mistyped": f"""{_BRONZE.replace("SELECT " + _iso("snap") + " AS ingest_ts", "SELECT event_id, " + _iso("snap") + " AS ingest_ts")}
        SELECT * EXCLUDE (event_id) REPLACE (
          CASE WHEN event_id % 5 <> 0 THEN lon END AS lon, CASE WHEN event_id % 7 <> 0 THEN last_contact END AS last_contact,
          CASE WHEN event_id % 8 <> 0 THEN velocity END AS velocity, CASE WHEN event_id % 6 <> 0 THEN on_ground END AS on_ground)
        FROM bronze""",
    "silver_merged_scan": f"""{_SILVER} SELECT * REPLACE ({_TIMES}),
        CASE WHEN ingest_ts >= TIMESTAMP '2024-01-15 12:00:00' THEN upper(icao24) END AS squawk FROM silver""",
    "gold_from_table": f"{_SILVER} SELECT {_GOLD}, {_INGEST_HOUR} FROM silver",
    "silver_since_now": f"""{_BRONZE} SELECT * REPLACE ({_TIMES}) FROM typed
        WHERE ingest_ts > (SELECT max(ingest_ts) FROM typed) - INTERVAL 12 HOUR""",
    "snapshot_ingest": f"{_BRONZE} {_WITH_INGEST_HOUR} WHERE {_IN_DEFAULT_BOX}",
    "stream_ingest": f"{_BRONZE} {_WITH_INGEST_HOUR} WHERE {_IN_DEFAULT_BOX}",
    "bbox_filter": f"{_BRONZE} SELECT * FROM bronze WHERE {_IN_DEFAULT_BOX}",
    "bbox_narrow": f"{_BRONZE} SELECT * FROM bronze WHERE lat BETWEEN 43 AND 48 AND lon BETWEEN 0 AND 6",
    "incremental_window": f"{_BRONZE} SELECT * REPLACE ({_TIMES}) FROM typed WHERE {_RECENT}",
    "quality_filter": f"{_BRONZE} SELECT * REPLACE ({_TIMES}) FROM valid",
    "silver_full": f"{_SILVER} SELECT * REPLACE ({_TIMES}) FROM silver",
    "silver_recent": f"""{_BRONZE}, fresh AS (
        SELECT * FROM valid WHERE {_RECENT} QUALIFY {_FIRST}
      ) SELECT * REPLACE ({_TIMES}), {_SILVER_HOUR} FROM fresh""",
    "silver_parts": f"{_SILVER} SELECT year, month, day, hour, count(*) AS rows FROM silver "
                    "GROUP BY year, month, day, hour",
    "silver_roundtrip": f"{_SILVER} {_SILVER_WITH_INGEST}",
    "silver_incremental": f"{_LOADED} {_SILVER_WITH_INGEST}",
    "stream_silver_rows": f"{_SILVER} {_SILVER_WITH_INGEST}",
    "gold_incremental": f"{_LOADED} SELECT {_GOLD}, {_INGEST_HOUR} FROM silver",
    "whole_run": f"""{_BRONZE}, silver AS (
        SELECT *, {_SILVER_HOUR} FROM valid WHERE {_IN_DEFAULT_BOX} QUALIFY {_FIRST}
      ) SELECT {_GOLD}, {_INGEST_HOUR} FROM silver""",
    "forest_mean_rmse": f"{_MEANS} " + " UNION ALL ".join(_mean_error(*target) for target in TARGETS.items()),
    "forest_mean_predictions": f"""{_MEANS} SELECT icao24, {_POSITION_TIME}, lat, lon, baro_altitude,
        {', '.join(f'round(mean_{name}, 6) AS predicted_{name}' for name in TARGETS)}
        FROM motion, means WHERE {_SCORABLE}""",
    "forest_mean_days": f"""{_MEANS} SELECT icao24, {_POSITION_TIME}, lat, lon, baro_altitude,
        {', '.join(f'round(mean_{name}, 6) AS predicted_{name}' for name in TARGETS)},
        CAST(CAST(ingest_ts AS DATE) AS VARCHAR) AS ingest_date FROM motion, means WHERE {_SCORABLE}""",
    "scoring_incremental": f"""{_MOTION} SELECT icao24, {_POSITION_TIME}, {', '.join(FEATURES_14)}
        FROM motion WHERE {_SCORABLE} AND {_LOADED_HOURS}""",
    "scoring_from_state": f"""{_MOTION} SELECT icao24, {_POSITION_TIME}, {', '.join(FEATURES_14)}
        FROM motion WHERE {_SCORABLE} AND {_LOADED_HOURS}""",
    "training_incremental": f"""{_TRAINING} SELECT icao24, {_POSITION_TIME},
        {', '.join((*FEATURES_14, *TARGETS.values()))} FROM training WHERE {_LOADED_HOURS}""",
    "feature_vector_complete": f"{_MOTION} SELECT icao24, {_POSITION_TIME}, {_slots(FEATURES_14)} FROM motion "
                               f"WHERE {_SCORABLE}",
    "bronze_lineage": f"""{_BRONZE} SELECT strftime(CAST(ingest_ts AS TIMESTAMP),
        'ingest_year=%Y/ingest_month=%m/ingest_day=%d/ingest_hour=%H') AS directory, count(*) AS rows
        FROM bronze GROUP BY ALL""",
    "snapshot_files": f"{_BRONZE} {_WITH_INGEST_HOUR}",
    "predictions_in_range": f"{_MOTION} SELECT icao24, {_POSITION_TIME}, TRUE AS in_range FROM motion WHERE {_SCORABLE}",
    "stream_silver_keys": f"{_BRONZE} SELECT DISTINCT icao24, {_POSITION_TIME} FROM valid",
    "motion_features": f"""{_MOTION}
        SELECT * EXCLUDE (future_lat, future_lon, future_alt) REPLACE ({_MOTION_TIMES}) FROM motion""",
    "scoring_features": f"{_MOTION} SELECT icao24, {_POSITION_TIME}, {', '.join(FEATURES_8)} FROM motion",
    "future_targets": f"{_MOTION} SELECT icao24, {_POSITION_TIME}, future_lat, future_lon, future_alt FROM motion",
    "training_rows": f"""{_TRAINING} SELECT icao24, {_POSITION_TIME},
        {', '.join((*FEATURES_14, *TARGETS.values()))} FROM training""",
    "split_flags": f"{_TRAINING} SELECT icao24, {_POSITION_TIME}, is_train FROM flagged",
    "split_counts": f"{_TRAINING} SELECT is_train, count(*) AS rows FROM flagged GROUP BY is_train",
    "feature_vector": f"{_TRAINING} SELECT icao24, {_POSITION_TIME}, {_slots(FEATURES_14)} FROM training",
    "feature_vector_short": f"""{_MOTION} SELECT icao24, {_POSITION_TIME}, {_slots(FEATURES_8)}
        FROM motion WHERE {_complete(FEATURES_8)}""",
    "stage_counts": f"""{_TRAINING}
        SELECT 'bronze' AS stage, count(*) AS rows FROM bronze
        UNION ALL SELECT 'valid', count(*) FROM valid
        UNION ALL SELECT 'silver', count(*) FROM silver
        UNION ALL SELECT 'training', count(*) FROM training""",
    "gold_states": f"{_SILVER} SELECT {_GOLD} FROM silver",
    "gold_recent": f"{_SILVER} SELECT {_GOLD} FROM silver WHERE {_RECENT}",
    "gold_roundtrip": f"{_SILVER} SELECT {_GOLD}, {_INGEST_HOUR} FROM silver",
    "silver_published": f"{_EMPTIED} {_SILVER_WITH_INGEST}",
    "gold_published": f"{_EMPTIED} SELECT {_GOLD}, {_INGEST_HOUR} FROM silver",
    "gold_connector": f"{_SILVER} SELECT {_GOLD}, {_INGEST_HOUR} FROM silver",
    "gold_merged_scan": f"{_SILVER} SELECT {_GOLD} FROM silver",
    "gold_table": f"{_SILVER} SELECT {_GOLD} FROM silver",
    "bronze_append_table": f"{_BRONZE} SELECT * FROM bronze",
    "rmse_metric": f"{_TRAINING} " + " UNION ALL ".join(
        (
            _stay_error("lat", "lat", "future_lat"),
            _stay_error("lon", "lon", "future_lon"),
            _stay_error("alt", "baro_altitude", "future_alt"),
        )
    ),
}
