"""Row counts measured while other work runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row counter attached; ``observation.get["rows"]`` once an action has run."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
