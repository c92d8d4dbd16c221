"""All stages in order, in one session and with one point in time."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import SparkSession

from skytracks.functions.times import HOUR, HourRange, as_utc
from skytracks.plans.gold import load_gold
from skytracks.plans.predict import predict
from skytracks.plans.runs import Counting, RunTable
from skytracks.plans.silver import LoadMode, load_silver, written_hours
from skytracks.plans.state import note_changed
from skytracks.plans.train import train
from skytracks.schemas import HORIZON_ROWS, LOOKBACK, BoundingBox
from skytracks.session import cut_lineage, pin_utc
from skytracks.sources.lake import read_if_present, read_silver, read_snapshots
from skytracks.sources.published import covered_since, last_load, rows_since
from skytracks.streaming.bronze import stream_bronze


@dataclass(frozen=True)
class Lake:
    """Where the tables of one lake are."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def bronze(self) -> str:
        return self.path("bronze")

    @property
    def silver(self) -> str:
        return self.path("silver/flight_states")

    @property
    def gold(self) -> str:
        return self.path("gold/flight_states")

    @property
    def predictions(self) -> str:
        return self.path("gold/trajectory_predictions")

    @property
    def models(self) -> str:
        return self.path("models")

    @property
    def state(self) -> str:
        return self.path("state/last_reports")

    @property
    def runs(self) -> str:
        return self.path("runs")

    @property
    def errors(self) -> str:
        return self.path("models/position_errors")


def run(
    spark: SparkSession,
    root: str,
    landing_path: str | None = None,
    mode: LoadMode = "incremental",
    as_of: datetime | str | None = None,
    lookback: timedelta = LOOKBACK,
    box: BoundingBox | None = BoundingBox(),
    one_per_line: bool = False,
    with_training: bool = False,
    with_predictions: bool = True,
    table: str | None = None,
    overlap: timedelta = HOUR,
    on_malformed: str = "fail",
    horizon: int = HORIZON_ROWS,
    published: bool = False,
    connector: str | None = None,
    connector_options: Mapping[str, str] | None = None,
    forest_params: Mapping[str, Any] | None = None,
) -> dict[str, str | None]:
    """Ingest, silver, optional training and scoring, gold. Returns where each stage wrote.

    An incremental run scores the days that silver may have changed, also with a model it has just trained. It reads these
    days and the state of last reports kept at ``Lake.state``. With ``published`` silver and gold are tables that readers follow by
    their manifests; a lake that has begun so goes on so.

    Landed documents are taken once, also by repeated runs. The errors of a training, a row per
    target, are kept at ``Lake.errors``. The rows that each stage read and wrote, and the errors, are kept at ``Lake.runs``.
    A stage without input writes nothing and gives None.
    """
    pin_utc(spark)
    lake, moment = Lake(root), as_utc(as_of)
    done: dict[str, str | None] = {}
    runs = RunTable(spark, lake.runs, moment, mode)

    def finish(stage: str, path: str | None) -> None:
        done[stage] = path
        runs.finish(stage, path is not None)

    if landing_path is not None:
        finish("bronze", _ingest_new(spark, landing_path, lake, box, one_per_line, on_malformed, runs.counting("bronze")))
    before = last_load(spark, lake.silver)
    finish("silver", load_silver(spark, lake.bronze, lake.silver, mode, moment, lookback, overlap, published, runs.counting("silver")))
    _note_published(spark, runs, "silver", lake.silver, before)
    changed = None if mode == "full" else _changed_hours(spark, lake.silver, before, written_hours(moment, lookback, overlap))
    if done["silver"] is not None:
        note_changed(spark, lake.state, changed)
    if with_training:
        trained = None
        if read_if_present(lambda: read_silver(spark, lake.silver)) is not None:
            errors = train(spark, lake.silver, lake.models, horizon=horizon, **(forest_params or {}))
            errors = cut_lineage(errors)
            errors.write.mode("overwrite").parquet(lake.errors)
            for row in errors.collect():
                runs.note("models", "test_rows", row["rows"])
                runs.note("models", f"rmse_{row['target']}", row["rmse"])
            trained = lake.models
        finish("models", trained)
    if with_predictions:
        scored = predict(spark, lake.silver, lake.models, lake.predictions, changed, lake.state, runs.counting("predictions"))
        finish("predictions", scored)
    before = last_load(spark, lake.gold)
    finish(
        "gold",
        load_gold(
            spark, lake.silver, lake.gold, mode, moment, lookback, overlap, table,
            connector=connector, connector_options=connector_options, seen=runs.counting("gold"),
        ),
    )
    _note_published(spark, runs, "gold", lake.gold, before)
    runs.save()
    return done


def _note_published(spark: SparkSession, runs: RunTable, stage: str, path: str, before: int | None) -> None:
    """Of a published table the manifest has the rows written."""
    rows = rows_since(spark, path, before)
    if rows is not None:
        runs.note(stage, "rows_out", rows)


def _changed_hours(spark: SparkSession, silver_path: str, before: int | None, asked: HourRange) -> HourRange:
    """The hours a load has changed: those asked for, and of a published table any others that its loads cover."""
    if last_load(spark, silver_path) is None:
        return asked
    places, _ = covered_since(spark, silver_path, before)
    hours = [as_utc(f"{place}:00:00") for place in places]
    return HourRange(min([asked.start, *hours]), max([asked.end, *(hour + HOUR for hour in hours)]))


def _ingest_new(
    spark: SparkSession, landing_path: str, lake: Lake, box: BoundingBox | None, one_per_line: bool, on_malformed: str,
    seen: Counting,
) -> str | None:
    if read_if_present(lambda: read_snapshots(spark, landing_path, one_per_line)) is None:
        return None
    stream_bronze(
        spark, landing_path, lake.bronze, lake.path("ingest_progress"), box, one_per_line, on_malformed, seen
    ).awaitTermination()
    return lake.bronze
