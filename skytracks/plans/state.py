"""Each aircraft's last reports at the start of a day, so that a day is scored from itself and them.

A state holds, for every aircraft, what a later report can have beside it: its last reports with a position time (one more
than the rows that targets look ahead), its last one without, and its first with one, which follows those without. States are
small: they grow with the aircraft, not with time. The state of a day is made from an earlier one and the silver in between,
and kept; a load that changes older hours puts the states after them out of use.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytracks.functions.times import DAY, HourRange, since_hour
from skytracks.operators.motion import (
    MOTION_INPUTS, SLICE, asked_motion, asked_spans, marked_inputs, motion_inputs, previous_for, with_motion,
    with_neighbour_times,
)
from skytracks.schemas import HORIZON_ROWS, SILVER_HOUR_KEYS, SILVER_TABLE
from skytracks.session import cut_lineage, fresh_name
from skytracks.sources.files import exists
from skytracks.sources.lake import read_silver

KEPT = HORIZON_ROWS + 1
_PLACE = ("time_position", "ingest_ts")
_LOG = "number LONG, kind STRING, at STRING, path STRING"


def last_reports(reports: DataFrame, kept: int = KEPT) -> DataFrame:
    """Of each aircraft the last ``kept`` reports with a position time, the last one without and the first with one.

    ``row_number`` is bounded, so a map task sends no more than those rows of an aircraft.
    """
    rows = reports.select(*MOTION_INPUTS)
    names = [*_PLACE, *(name for name in MOTION_INPUTS if name not in ("icao24", *_PLACE))]
    untimed = F.col("time_position").isNull()
    later = Window.partitionBy("icao24", untimed).orderBy(*(F.col(name).desc_nulls_last() for name in names))
    earlier = Window.partitionBy("icao24").orderBy(*(F.col(name).asc_nulls_first() for name in names))
    ends = rows.withColumn("_rank", F.row_number().over(later)).filter(F.col("_rank") <= kept)
    last = ends.filter(~untimed | (F.col("_rank") == 1)).drop("_rank")
    timed = rows.filter(~untimed).withColumn("_rank", F.row_number().over(earlier)).filter("_rank = 1").drop("_rank")
    return last.unionByName(timed).distinct()


# --- states of a table ----------------------------------------------------------------------------------------------


def _log(spark: SparkSession, state_path: str) -> DataFrame | None:
    path = f"{state_path.rstrip('/')}/log"
    return spark.read.schema(_LOG).json(path) if exists(spark, path) else None


def _noted(spark: SparkSession, state_path: str, kind: str, at: datetime, path: str | None = None) -> None:
    log = _log(spark, state_path)
    row = (0 if log is None else log.count(), kind, at.isoformat(), path)
    spark.createDataFrame([row], _LOG).coalesce(1).write.mode("append").json(f"{state_path.rstrip('/')}/log")


def note_changed(spark: SparkSession, state_path: str, hours: HourRange | None = None) -> None:
    """Silver has changed from the start of ``hours`` on (or wholly): later states are made anew when they are asked for."""
    _noted(spark, state_path, "changed", datetime(1, 1, 1, tzinfo=timezone.utc) if hours is None else hours.start)


def _latest(spark: SparkSession, state_path: str, moment: datetime) -> tuple[datetime, str] | None:
    """The last state up to ``moment`` that nothing has changed before since it was made."""
    log = _log(spark, state_path)
    if log is None:
        return None
    made = log.filter("kind = 'made'").filter(F.col("at") <= moment.isoformat()).alias("made")
    changed = log.filter("kind = 'changed'").alias("changed")
    stale = (F.col("changed.number") > F.col("made.number")) & (F.col("changed.at") < F.col("made.at"))
    found = made.join(changed, stale, "left_anti").orderBy(F.col("at").desc(), F.col("number").desc()).first()
    return None if found is None else (datetime.fromisoformat(found["at"]), found["path"])


def state_at(spark: SparkSession, silver_path: str, state_path: str, moment: datetime) -> DataFrame:
    """The state of silver's reports ingested before ``moment``, kept for the next time.

    It reads the silver since the last state that holds; without one, all silver before ``moment``.
    """
    schema = SILVER_TABLE
    layout = ", ".join(f"{name} {schema[name].dataType.simpleString()}" for name in MOTION_INPUTS)
    latest = _latest(spark, state_path, moment)
    if latest is not None and latest[0] == moment:
        return spark.read.schema(layout).parquet(latest[1])
    if latest is None:
        rows = motion_inputs(read_silver(spark, silver_path).filter(~since_hour(SILVER_HOUR_KEYS, moment)))
    else:
        since = motion_inputs(read_silver(spark, silver_path, HourRange(latest[0], moment)))
        rows = since.unionByName(spark.read.schema(layout).parquet(latest[1]))
    path = f"{state_path.rstrip('/')}/{fresh_name(moment.strftime('%Y%m%dT%H'))}"
    # Neighbours in one file, so that a few aircraft are found by the files' key ranges.
    last_reports(rows).hint("rebalance", "icao24").sortWithinPartitions("icao24").write.parquet(path)
    _noted(spark, state_path, "made", moment, path)
    return spark.read.schema(layout).parquet(path)


# --- motion from a state --------------------------------------------------------------------------------------------


def _place() -> Column:
    return F.struct(*_PLACE)


def _unsettled(asked: DataFrame, state: DataFrame, horizon: int | None) -> DataFrame:
    """Aircraft with a report asked for that may stand before all that the state keeps of them."""
    timed = F.col("time_position").isNotNull()
    held = state.groupBy("icao24").agg(
        F.count("time_position").alias("_held"),
        # The first report of all stands apart from the last ones: the lowest of those is the KEPT-th from the end.
        F.get(F.sort_array(F.collect_set(F.when(timed, _place())), False), F.lit(KEPT - 1)).alias("_low"),
    )
    wanted = asked.groupBy("icao24").agg(F.min(F.when(timed, _place())).alias("_least"), F.count_if(~timed).alias("_untimed"))
    beyond = F.col("_least") <= F.col("_low")
    if horizon:
        beyond = beyond | (F.col("_untimed") > 0)
    return wanted.join(held.filter(F.col("_held") >= KEPT), "icao24").filter(beyond).select("icao24")


class DayMotion:
    """Reports of the whole days of ``hours`` with their neighbours, as silver stood at the end of these days."""

    def __init__(self, spark: SparkSession, silver_path: str, state_path: str, hours: HourRange, horizon: int | None = None):
        self.days, self.horizon = hours.whole_days(), horizon
        self._spark, self._silver = spark, silver_path
        state = state_at(spark, silver_path, state_path, self.days.start)
        asked = marked_inputs(read_silver(spark, silver_path, self.days), F.lit(True))
        known = state.join(asked.select("icao24").distinct(), "icao24", "left_semi")
        # An aircraft that reports long after its position time: one row for each such aircraft of these days.
        self._late = cut_lineage(_unsettled(asked, known, horizon))
        self._any_late = not self._late.isEmpty()
        rows = asked.unionByName(known.withColumn("_asked", F.lit(False)))
        self._near = rows.join(self._late, "icao24", "left_anti") if self._any_late else rows

    def _history(self) -> DataFrame:
        """All reports until the end of the days of the late aircraft: the one read that grows with silver."""
        silver = read_silver(self._spark, self._silver).filter(~since_hour(SILVER_HOUR_KEYS, self.days.end))
        return marked_inputs(silver, self.days.prunes(SILVER_HOUR_KEYS)).join(self._late, "icao24", "left_semi")

    def motion(self, features: Sequence[str], slice_by: str | None = SLICE) -> DataFrame:
        """Motion (and with a horizon targets) of the days' reports, as their whole history until then gives it."""
        previous = previous_for(features)
        moving = with_motion(self._near, previous, self.horizon, slice_by).filter("_asked").drop("_asked")
        if self._any_late:
            marked = self._history()
            moving = moving.unionByName(asked_motion(marked, asked_spans(marked), previous, self.horizon, slice_by))
        return moving

    def repaired_days(self, hours: HourRange, slice_by: str | None = SLICE) -> list[HourRange]:
        """Earlier days, in order, with a report right after one that came in ``hours``: its previous report has changed."""
        rows = self._near if not self._any_late else self._near.unionByName(self._history())
        followed = with_neighbour_times(rows, slice_by).filter("_asked").filter(hours.contains(F.col("ingest_ts")))
        before = followed.filter(F.col("_next_ingest") < F.lit(self.days.start))
        # Their number is bounded by the calendar.
        found = before.select(F.date_trunc("day", "_next_ingest").cast("string").alias("day")).distinct().collect()
        starts = sorted(datetime.fromisoformat(row["day"]).replace(tzinfo=timezone.utc) for row in found)
        return [HourRange(start, start + DAY) for start in starts]
