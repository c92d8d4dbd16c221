"""What a run did: rows in and out of every stage and the errors of a training, counted while the stages write."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession

from skytracks.operators.counts import counted

# Gives a frame back with its rows counted under a name while they are written; a stage's frame is counted in one action only.
Counting = Callable[[DataFrame, str], DataFrame]

RUNS = "run STRING, as_of STRING, mode STRING, stage STRING, measure STRING, value DOUBLE"


def uncounted(rows: DataFrame, measure: str) -> DataFrame:
    return rows


class RunTable:
    """Measures of the stages of one run, appended to a table of all runs: a row per stage and measure."""

    def __init__(self, spark: SparkSession, path: str, as_of: datetime, mode: str):
        self._spark, self._path = spark, path
        self._run = (uuid.uuid4().hex, as_of.isoformat(), mode)
        self._open: dict[tuple[str, str], list[Observation]] = {}
        self._values: dict[tuple[str, str], float] = {}

    def counting(self, stage: str) -> Counting:
        """Counts rows of a stage; frames counted under one name are added up."""

        def count(rows: DataFrame, measure: str) -> DataFrame:
            seen, observation = counted(rows, f"{stage}_{measure}_{uuid.uuid4().hex}")
            self._open.setdefault((stage, measure), []).append(observation)
            return seen

        return count

    def note(self, stage: str, measure: str, value: float) -> None:
        self._values[stage, measure] = float(value)

    def finish(self, stage: str, wrote: bool) -> None:
        """Take the counts of a stage that has written; one that had nothing to do has none, and would never have."""
        for key in [key for key in self._open if key[0] == stage]:
            observations = self._open.pop(key)
            if wrote:
                self.note(*key, sum(observation.get["rows"] for observation in observations))

    def save(self) -> None:
        rows = [(*self._run, *key, value) for key, value in self._values.items()]
        self._spark.createDataFrame(rows, RUNS).coalesce(1).write.mode("append").json(self._path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).json(path)
