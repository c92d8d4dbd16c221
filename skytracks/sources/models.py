"""Saving and loading position models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel

from skytracks.operators.forest import assembler
from skytracks.schemas import FEATURES_14, TARGETS


def save_model(model: PipelineModel, root: str) -> str:
    """Save assembler and forests together, replacing an earlier save."""
    path = f"{root.rstrip('/')}/position_model"
    model.write().overwrite().save(path)
    return path


def load_model(root: str) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/position_model")


def save_forests(model: PipelineModel, root: str) -> list[str]:
    """Save each forest on its own as ``rf_<target>_model``."""
    paths = [f"{root.rstrip('/')}/rf_{name}_model" for name in TARGETS]
    for forest, path in zip(model.stages[1:], paths, strict=True):
        forest.write().overwrite().save(path)
    return paths


def load_forests(root: str, features: Sequence[str] = FEATURES_14) -> PipelineModel:
    """Build a model from separately saved forests fitted on ``features``, in that order."""
    forests = []
    for name in TARGETS:
        forest = RandomForestRegressionModel.load(f"{root.rstrip('/')}/rf_{name}_model")
        if forest.numFeatures != len(features):
            raise ValueError(f"the {name} forest has {forest.numFeatures} features, {len(features)} were named")
        forests.append(forest.setPredictionCol(f"predicted_{name}"))
    return PipelineModel(stages=[assembler(features), *forests])
