"""Reading and writing the file tables of the lake."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skytracks.functions.times import HourRange
from skytracks.schemas import BRONZE_TABLE, GOLD_DAY_KEY, GOLD_TABLE, INGEST_HOUR_KEYS, SILVER_HOUR_KEYS, SILVER_TABLE
from skytracks.sources.files import clustered, read_if_present
from skytracks.sources.published import of_aircraft, read_published

WriteMode = Literal["append", "overwrite", "replace"]


def read_snapshots(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Landed snapshot documents as rows with a ``value`` column: one per file, or one per line."""
    return spark.read.text(path, wholetext=not one_per_line)


def read_bronze(spark: SparkSession, path: str, hours: HourRange | None = None) -> DataFrame:
    """Bronze rows with their hour keys and ``source_file``; ``hours`` limits both listing and reading."""
    rows = _read_hours(spark, "json", BRONZE_TABLE, path, INGEST_HOUR_KEYS, hours)
    return rows.select("*", F.col("_metadata.file_path").alias("source_file"))


def read_silver(
    spark: SparkSession,
    path: str,
    hours: HourRange | None = None,
    merge_schema: bool = False,
    aircraft: Sequence[str] | None = None,
) -> DataFrame:
    """Silver rows with their hour keys.

    A published table is read by its manifest; for a few ``aircraft`` only the files that may hold them are named. The declared layout already covers files that lack a column, without opening every
    footer; ``merge_schema`` asks Spark to collect unknown extra columns as well.
    """
    if aircraft is not None:
        listed = F.col("icao24").isin(list(aircraft))
        published = read_published(spark, path, SILVER_TABLE, hours, of_aircraft(aircraft))
        return (read_silver(spark, path, hours, merge_schema) if published is None else published).filter(listed)
    published = read_published(spark, path, SILVER_TABLE, hours)
    if published is not None:
        return published
    if merge_schema:
        whole = spark.read.option("mergeSchema", True).parquet(path)
        return whole if hours is None else whole.filter(hours.prunes(SILVER_HOUR_KEYS))
    return _read_hours(spark, "parquet", SILVER_TABLE, path, SILVER_HOUR_KEYS, hours)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold rows with their day key, by the manifest where the table is published."""
    published = read_published(spark, path, GOLD_TABLE)
    return spark.read.schema(GOLD_TABLE).parquet(path) if published is None else published


def read_flat(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below ``path`` with merged schema and without the directory keys."""
    return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(path)


def _read_hours(
    spark: SparkSession,
    fmt: str,
    schema: StructType,
    path: str,
    keys: Sequence[str],
    hours: HourRange | None,
) -> DataFrame:
    """All rows, or those of ``hours``: an empty frame when the table has none of them, whatever their number."""
    reader = spark.read.format(fmt).schema(schema)
    if hours is None:
        return reader.load(path)
    root = path.rstrip("/")
    # One pattern, so that hours without data are simply absent.
    pattern = f"{root}/{{{','.join(_named_dirs(keys, hours))}}}"
    named = read_if_present(lambda: spark.read.format(fmt).schema(schema).option("basePath", root).load(pattern))
    rows = reader.load(root) if named is None else named
    return rows.filter(hours.prunes(keys))


def _named_dirs(keys: Sequence[str], hours: HourRange) -> list[str]:
    """The directories of a range in both forms of their keys: about 150 of either at most, and one per whole year."""
    dirs = []
    for at, level in hours.steps():
        parts = list(zip(keys, (at.year, at.month, at.day, at.hour)[:level]))
        dirs.append("/".join(f"{key}={value}" for key, value in parts))
        dirs.append("/".join(f"{key}={value:02d}" for key, value in parts))
    return list(dict.fromkeys(dirs))


def write_partitioned(
    rows: DataFrame, path: str, keys: Sequence[str], mode: WriteMode, fmt: str = "parquet", **options
) -> None:
    """``append`` adds files, ``overwrite`` replaces the table, ``replace`` replaces the directories written."""
    overwrite = {"overwrite": "static", "replace": "dynamic"}
    writer = rows.write.format(fmt).options(**options).partitionBy(*keys)
    if mode in overwrite:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", overwrite[mode])
    else:
        writer = writer.mode("append")
    writer.save(path)


def write_bronze(rows: DataFrame, path: str, mode: WriteMode = "append") -> None:
    """Bronze rows with padded hour keys as NDJSON; nulls are written out."""
    by_hour = clustered(rows, INGEST_HOUR_KEYS)
    write_partitioned(by_hour, path, INGEST_HOUR_KEYS, mode, "json", ignoreNullFields="false")


def write_silver(rows: DataFrame, path: str, mode: WriteMode) -> None:
    write_partitioned(clustered(rows, SILVER_HOUR_KEYS, ("icao24", "time_position")), path, SILVER_HOUR_KEYS, mode)


def write_gold(rows: DataFrame, path: str, mode: WriteMode) -> None:
    write_partitioned(clustered(rows, (GOLD_DAY_KEY,), ("icao24", "time_position")), path, (GOLD_DAY_KEY,), mode)


def write_predictions(rows: DataFrame, path: str, mode: WriteMode = "overwrite") -> None:
    write_partitioned(clustered(rows, (GOLD_DAY_KEY,), ("icao24", "time_position")), path, (GOLD_DAY_KEY,), mode)
