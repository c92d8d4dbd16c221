"""Silver to position models."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytracks.functions.times import HourRange
from skytracks.operators.forest import apply_forests, assembler, fit_forests, rmse_by_target
from skytracks.operators.motion import SLICE, training_rows
from skytracks.operators.split import in_train_part, random_parts
from skytracks.plans.histories import moving_reports
from skytracks.schemas import FEATURES_14, HORIZON_ROWS, TARGETS
from skytracks.session import cut_lineage, keep_layout
from skytracks.sources.lake import read_silver
from skytracks.sources.models import save_model

Split = Literal["hash", "random"]


def training_set(
    silver: DataFrame,
    features: Sequence[str] = FEATURES_14,
    horizon: int = HORIZON_ROWS,
    slice_by: str | None = SLICE,
    hours: HourRange | None = None,
) -> DataFrame:
    """Report rows (of ``hours``) with complete features and targets, which may lie outside the hours."""
    return training_rows(moving_reports(silver, features, horizon, hours, slice_by), features)


# Rows of one part of the training table. Parts follow from the rows alone, so that a model does not depend on the cluster.
ROWS_PER_PART = 20_000


def fit_and_evaluate(
    rows: DataFrame, features: Sequence[str] = FEATURES_14, split: Split = "hash", **forest_params
) -> tuple[PipelineModel, DataFrame]:
    """Models fitted on the train part of ``rows`` and their error on the rest.

    The assembled rows are stored once in the shared folder: all fits and the evaluation read
    that copy instead of repeating the windows, also after an executor is lost.
    """
    columns = ["icao24", "time_position", "features", *TARGETS.values()]
    if split == "hash":
        columns.append(in_train_part().alias("is_train"))
    keys = ["icao24", "time_position", *TARGETS.values()]
    # Stored once more as the fits read them: none of them shuffles or sorts again.
    assembled = cut_lineage(assembler(features).transform(rows).select(*columns))
    parts = max(1, -(-assembled.count() // ROWS_PER_PART))
    stored = keep_layout(assembled.repartition(parts, *keys).sortWithinPartitions(*keys))
    if split == "hash":
        train, test = stored.filter("is_train"), stored.filter(~F.col("is_train"))
    else:
        train, test = random_parts(stored)
    model = fit_forests(train, features, **forest_params)
    return model, rmse_by_target(apply_forests(model, test))


def train(
    spark: SparkSession,
    silver_path: str,
    models_path: str,
    features: Sequence[str] = FEATURES_14,
    horizon: int = HORIZON_ROWS,
    split: Split = "hash",
    hours: HourRange | None = None,
    **forest_params,
) -> DataFrame:
    """Fit on silver (or the ``hours`` of it), save the model and return (target, rmse, rows).

    ``at_once`` forests are fitted side by side, which pays while the rows leave cores idle.
    """
    rows = training_set(read_silver(spark, silver_path), features, horizon, hours=hours)
    model, errors = fit_and_evaluate(rows, features, split, **forest_params)
    save_model(model, models_path)
    return errors
