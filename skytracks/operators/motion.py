"""Per-aircraft motion features, future-position targets and the rows a model can use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytracks.operators.neighbours import with_neighbours
from skytracks.schemas import FEATURES_14, HORIZON_ROWS, TARGETS

# New column names and the column each is read from.
PREVIOUS = {
    "prev_lat": "lat",
    "prev_lon": "lon",
    "prev_alt": "baro_altitude",
    "prev_velocity": "velocity",
    "prev_heading": "heading",
    "prev_time": "time_position",
}
FUTURE = {"future_lat": "lat", "future_lon": "lon", "future_alt": "baro_altitude"}
RATE_INPUTS = ("prev_velocity", "prev_heading", "prev_time")

# The report columns features and targets are computed from; ingest_ts orders equal times.
MOTION_INPUTS = (
    "icao24", "time_position", "ingest_ts",
    "lat", "lon", "baro_altitude", "velocity", "heading", "vertical_rate",
)


# De-duplicated reports are at most one per second, so a month of one aircraft is under 2.7 million rows, while few of
# its rows stand next to a slice's edge. Any other unit that date_trunc knows gives the same result.
SLICE = "month"


def _history(reports: DataFrame, slice_by: str | None) -> tuple[list[str], list[Column]]:
    """Row order of an aircraft's history, and calendar slices along it.

    Null position times come first and are sliced by ingest time, the next order column.
    """
    at = F.col("time_position")
    order = [name for name in ("time_position", "ingest_ts") if name in reports.columns]
    if slice_by is None:
        return order, []
    slices = [F.date_trunc(slice_by, at)]
    if "ingest_ts" in order:
        slices.append(F.when(at.isNull(), F.date_trunc(slice_by, F.col("ingest_ts"))))
    return order, slices


def previous_for(features: Sequence[str]) -> tuple[str, ...]:
    """The previous-report columns that ``features`` need, directly or through rates."""
    needed = set(RATE_INPUTS).union(features)
    if "altitude_change" in needed:
        needed.add("prev_alt")
    return tuple(name for name in PREVIOUS if name in needed)


def with_motion(
    reports: DataFrame,
    previous: Sequence[str] = tuple(PREVIOUS),
    horizon: int | None = None,
    slice_by: str | None = SLICE,
) -> DataFrame:
    """Add previous-report columns, rates, and with ``horizon`` the position that many rows ahead.

    ``slice_by`` only decides how the work is divided; ``None`` puts each history into one task.
    """
    order, slices = _history(reports, slice_by)
    looked_up = with_neighbours(
        reports,
        "icao24",
        order,
        slices,
        previous={name: PREVIOUS[name] for name in previous},
        ahead=FUTURE if horizon else None,
        steps=horizon or 1,
    )
    return with_rates(looked_up)


def with_future(reports: DataFrame, horizon: int = HORIZON_ROWS, slice_by: str | None = SLICE) -> DataFrame:
    """Add only the position ``horizon`` rows ahead (rows, not seconds)."""
    order, slices = _history(reports, slice_by)
    return with_neighbours(reports, "icao24", order, slices, ahead=FUTURE, steps=horizon)


def with_neighbour_times(reports: DataFrame, slice_by: str | None = SLICE) -> DataFrame:
    """Add ``_next_ingest``, when the report after each one was ingested."""
    order, slices = _history(reports, slice_by)
    return with_neighbours(reports, "icao24", order, slices, ahead={"_next_ingest": "ingest_ts"})


def with_rates(reports: DataFrame) -> DataFrame:
    """Add ``time_diff_sec``, ``accel`` and ``turn_rate``, and ``altitude_change`` where ``prev_alt`` exists.

    A zero or unknown time difference gives rate 0.0. Heading change is not wrapped at 360 degrees.
    """
    elapsed = F.col("time_diff_sec")

    def per_second(now: str, before: str) -> Column:
        return F.when(elapsed != 0, (F.col(now) - F.col(before)) / elapsed).otherwise(F.lit(0.0))

    timed = reports.withColumn(
        "time_diff_sec", F.unix_timestamp("time_position") - F.unix_timestamp("prev_time")
    )
    rates = {"accel": per_second("velocity", "prev_velocity"), "turn_rate": per_second("heading", "prev_heading")}
    if "prev_alt" in reports.columns:
        rates["altitude_change"] = F.col("baro_altitude") - F.col("prev_alt")
    return timed.withColumns(rates)


def training_rows(reports: DataFrame, features: Sequence[str] = FEATURES_14) -> DataFrame:
    """Rows whose rates, features and targets are all present (neither null nor NaN)."""
    present = F.col("accel").isNotNull() & F.col("turn_rate").isNotNull()
    return reports.filter(present).dropna(subset=[*features, *TARGETS.values()])


def scoring_rows(reports: DataFrame, features: Sequence[str] = FEATURES_14) -> DataFrame:
    """Rows whose features are all present (neither null nor NaN)."""
    return reports.dropna(subset=list(features))


def motion_inputs(silver: DataFrame) -> DataFrame:
    """Only the columns motion needs, so the scan, shuffle and sort carry nothing else."""
    return silver.select(*MOTION_INPUTS)


def marked_inputs(silver: DataFrame, asked: Column) -> DataFrame:
    """The columns motion needs, and whether a report is one of those asked for."""
    return silver.select(*MOTION_INPUTS, asked.alias("_asked"))


def asked_spans(marked: DataFrame) -> DataFrame:
    """First and last place, in the order of its history, of each aircraft's reports asked for."""
    place = F.struct("time_position", "ingest_ts")
    asked = marked.filter("_asked")
    return asked.groupBy("icao24").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))


def needed_history(marked: DataFrame, spans: DataFrame, horizon: int | None = None) -> DataFrame:
    """Of the aircraft in ``spans``: all reports within the span, the one before it, and ``horizon`` after it.

    However long ago the one before was, it is found: only one row per aircraft leaves a map task for it.
    """
    place = F.struct("time_position", "ingest_ts")
    order = [name for name in marked.columns if name != "icao24"]
    joined = marked.join(spans, "icao24")
    within = joined.filter(place.between(F.col("_first"), F.col("_last"))).select(*marked.columns)
    before = joined.filter(place < F.col("_first")).groupBy("icao24").agg(F.max(F.struct(*order)).alias("row"))
    needed = within.unionByName(before.select("icao24", "row.*"))
    if horizon:
        rank = F.row_number().over(Window.partitionBy("icao24").orderBy(*order))
        after = joined.filter(place > F.col("_last")).withColumn("_rank", rank).filter(F.col("_rank") <= horizon)
        needed = needed.unionByName(after.select(*marked.columns))
    return needed


def asked_motion(
    marked: DataFrame,
    spans: DataFrame,
    previous: Sequence[str] = tuple(PREVIOUS),
    horizon: int | None = None,
    slice_by: str | None = SLICE,
) -> DataFrame:
    """``with_motion`` of the reports asked for, as the whole history gives it."""
    moving = with_motion(needed_history(marked, spans, horizon), previous, horizon, slice_by)
    return moving.filter("_asked").drop("_asked")
