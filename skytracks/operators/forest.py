"""Random-forest position models: fit, evaluate and apply."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from skytracks.schemas import FEATURES_14, NUM_TREES, PREDICTION_COLUMNS, SEED, TARGETS


def assembler(features: Sequence[str] = FEATURES_14) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")


def fit_forests(
    assembled: DataFrame,
    features: Sequence[str] = FEATURES_14,
    targets: Mapping[str, str] = TARGETS,
    num_trees: int = NUM_TREES,
    seed: int = SEED,
    at_once: int = 1,
    **forest_params,
) -> PipelineModel:
    """Fit one forest per target on the ``features`` vector, ``at_once`` of them side by side.

    The result holds the assembler and all forests, each with its own prediction column, so a
    model always scores the feature list it was fitted on.
    """

    def fit(target: tuple[str, str]):
        name, label = target
        forest = RandomForestRegressor(
            featuresCol="features",
            labelCol=label,
            predictionCol=f"predicted_{name}",
            numTrees=num_trees,
            seed=seed,
            **forest_params,
        )
        return forest.fit(assembled.select("features", label))

    with ThreadPool(at_once) as pool:
        forests = pool.map(inheritable_thread_target(assembled.sparkSession)(fit), targets.items())
    return PipelineModel(stages=[assembler(features), *forests])


def feature_list(model: PipelineModel) -> list[str]:
    return model.stages[0].getInputCols()


def apply_forests(model: PipelineModel, assembled: DataFrame) -> DataFrame:
    """Score rows that already carry the ``features`` vector."""
    scored = assembled
    for forest in model.stages[1:]:
        scored = forest.transform(scored)
    return scored


def rmse_by_target(scored: DataFrame, targets: Mapping[str, str] = TARGETS) -> DataFrame:
    """Root mean squared error of every target in one pass: (target, rmse, rows)."""
    errors = [
        F.sqrt(F.avg(F.pow(F.col(label) - F.col(f"predicted_{name}"), 2))).alias(name)
        for name, label in targets.items()
    ]
    wide = scored.agg(*errors, F.count(F.lit(1)).alias("rows"))
    pairs = [F.struct(F.lit(name).alias("target"), F.col(name).alias("rmse")) for name in targets]
    return wide.select(F.explode(F.array(*pairs)).alias("pair"), "rows").select("pair.*", "rows")


def predictions(model: PipelineModel, rows: DataFrame, *more: str) -> DataFrame:
    """Score report rows and keep the published columns, and ``more`` of the rows' own."""
    return model.transform(rows).select(*PREDICTION_COLUMNS, *more)
