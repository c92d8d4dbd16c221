"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytracks.session import fresh_dir

# Fixed: the white space that separates words, as a character class.
SPACES = " \\t-\\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Shuffle files of a finished write go at once, not when the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there."""
    return _written(df, fresh_dir(df.sparkSession, name))


class Scratch:
    """Stored tables that are removed again: all that are left at the end of a ``with``, or some once their readers are done."""

    def __init__(self):
        self._paths: list[tuple[DataFrame, str]] = []

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = fresh_dir(df.sparkSession, name)
        found = _written(df, path)
        self._paths.append((found, path))
        return found

    def remove(self, *frames: DataFrame) -> None:
        gone = [pair for pair in self._paths if any(pair[0] is frame for frame in frames)]
        for pair in gone:
            context = pair[0].sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(pair[1])
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
            self._paths.remove(pair)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.remove(*(frame for frame, _ in self._paths))


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Maximal runs of anything but space, tab, line feed, vertical tab, form feed, carriage return."""
    return F.filter(F.split(text, f"[{SPACES}]+"), lambda word: word != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where lambdas inside ``body`` refer to it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
