"""What all file tables share: reading a table that may not be there, and bringing rows together for a write."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def read_if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame, or None when its path does not exist yet. Any other problem is raised."""
    try:
        return read()
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, on any file system that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def clustered(rows: DataFrame, keys: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Bring rows of one output directory together before a partitioned write.

    Rebalancing gives few, full files, and adaptive execution splits a directory that holds
    far more than the others over several tasks. Sorting by ``within`` inside the directories
    (the writer sorts by ``keys`` anyway) tightens the column statistics of each file.
    """
    return rows.hint("rebalance", *keys).sortWithinPartitions(*keys, *within)
