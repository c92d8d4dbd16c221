"""Silver and a saved model to predicted positions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from skytracks.functions.times import HourRange
from skytracks.operators.clean import with_ingest_date
from skytracks.operators.forest import feature_list, predictions
from skytracks.operators.motion import SLICE, scoring_rows
from skytracks.plans.histories import moving_reports
from skytracks.plans.runs import Counting, uncounted
from skytracks.plans.state import DayMotion
from skytracks.schemas import GOLD_DAY_KEY
from skytracks.sources.lake import WriteMode, read_if_present, read_silver, write_predictions
from skytracks.sources.models import load_model


def predicted_positions(
    model: PipelineModel, silver: DataFrame, slice_by: str | None = SLICE, hours: HourRange | None = None
) -> DataFrame:
    """Predictions for every report (of ``hours``) with the features the model was fitted on."""
    return predictions(model, _scorable(model, silver, slice_by, hours))


def _scorable(model: PipelineModel, silver: DataFrame, slice_by: str | None, hours: HourRange | None) -> DataFrame:
    features = feature_list(model)
    return scoring_rows(moving_reports(silver, features, hours=hours, slice_by=slice_by), features)


def predict(
    spark: SparkSession,
    silver_path: str,
    models_path: str,
    predictions_path: str,
    hours: HourRange | None = None,
    state_path: str | None = None,
    seen: Counting = uncounted,
) -> str | None:
    """Score silver and replace the predictions, or with ``hours`` only those of the days they touch.

    None when there is no silver (of those days) yet. Without ``state_path`` a report's previous one is looked for in all of
    silver. With it the days are read alone, and with the state of last reports kept there (``plans.state``); earlier
    days where a report of ``hours`` has come in before another are scored again.
    """
    days = None if hours is None else hours.whole_days()
    silver = read_if_present(lambda: read_silver(spark, silver_path, days))
    if silver is None or (days is not None and silver.isEmpty()):
        return None
    model = load_model(models_path)
    features = feature_list(model)

    def write(rows: DataFrame, mode: WriteMode) -> None:
        scored = predictions(model, with_ingest_date(rows), GOLD_DAY_KEY)
        write_predictions(seen(scored, "rows_out"), predictions_path, mode)

    if days is None:
        write(_scorable(model, silver, SLICE, None), "overwrite")
        return predictions_path
    again = [days]
    if state_path is not None:
        found = DayMotion(spark, silver_path, state_path, days)
        write(scoring_rows(found.motion(features), features), "replace")
        again = found.repaired_days(hours)
    for day in again:
        write(_scorable(model, read_silver(spark, silver_path), SLICE, day), "replace")
    return predictions_path
