"""Train / test split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytracks.schemas import SEED, TRAIN_PERCENT


def in_train_part(percent: int = TRAIN_PERCENT) -> Column:
    """True for about ``percent`` of reports, decided by a hash of (aircraft, position time).

    The same report falls on the same side whatever the partitioning, and on a recomputed task.
    """
    epoch = F.coalesce(F.unix_timestamp("time_position").cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.col("icao24"), F.lit("|"), epoch))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return bucket < percent


def random_parts(rows: DataFrame, percent: int = TRAIN_PERCENT, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Spark's own random split. Which rows fall where depends on the physical partitioning."""
    train, test = rows.randomSplit([float(percent), float(100 - percent)], seed=seed)
    return train, test
