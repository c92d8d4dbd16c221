"""Silver to gold: the published daily tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytracks.functions.times import DAY, HOUR, as_utc
from skytracks.operators.clean import recent, with_ingest_date
from skytracks.plans.runs import Counting, uncounted
from skytracks.plans.silver import LoadMode, written_hours
from skytracks.schemas import GOLD_DAY_KEY, GOLD_TABLE, LOOKBACK, SILVER_HOUR_KEYS, SILVER_TABLE
from skytracks.sources.files import read_if_present
from skytracks.sources.lake import read_silver, write_gold
from skytracks.sources.published import covered_since, last_load, manifest, publish, read_published
from skytracks.sources.tables import write_load, write_table


def gold_rows(silver: DataFrame) -> DataFrame:
    return with_ingest_date(silver)


def recent_gold_rows(
    silver: DataFrame, as_of: datetime | str | None = None, lookback: timedelta = LOOKBACK
) -> DataFrame:
    """Gold rows of the reports ingested after ``as_of - lookback``."""
    return with_ingest_date(recent(silver, as_of, lookback))


def load_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    mode: LoadMode = "incremental",
    as_of: datetime | str | None = None,
    lookback: timedelta = LOOKBACK,
    overlap: timedelta = HOUR,
    table: str | None = None,
    merge_schema: bool = False,
    connector: str | None = None,
    connector_options: Mapping[str, str] | None = None,
    seen: Counting = uncounted,
) -> str | None:
    """Write gold, then from it ``table`` and the ``connector`` if named; None when there is nothing to publish.

    ``incremental`` rebuilds, from all of silver, every whole day that the silver load with the
    same ``as_of``, ``lookback`` and ``overlap`` may have changed. From a published silver (``sources.published``) gold is
    published as well, and ``incremental`` rebuilds the days of the silver loads that gold does not have yet.

    The table and the connector get the days just written. A connector gets them as a load named by days and contents
    (option ``load``), so that a sink can tell a repeated one.
    """
    if last_load(spark, silver_path) is not None:
        days = _publish_days(spark, silver_path, gold_path, mode)
    else:
        days = _write_days(spark, silver_path, gold_path, mode, as_of, lookback, overlap, merge_schema, seen)
    if days is None:
        return None
    if table is not None or connector is not None:
        rows = days(gold_files(spark, gold_path))
        if table is not None:
            write_table(rows, table, "overwrite" if mode == "full" else "replace", partition_by=GOLD_DAY_KEY)
        if connector is not None:
            write_load(rows, connector, **(connector_options or {}))
    return gold_path


def gold_files(spark: SparkSession, gold_path: str) -> DataFrame:
    """All of gold as it was written, with any columns that silver had beyond the declared ones."""
    published = read_published(spark, gold_path, GOLD_TABLE)
    return spark.read.parquet(gold_path) if published is None else published


def _write_days(
    spark: SparkSession, silver_path: str, gold_path: str, mode: LoadMode,
    as_of: datetime | str | None, lookback: timedelta, overlap: timedelta, merge_schema: bool,
    seen: Counting,
) -> Callable[[DataFrame], DataFrame] | None:
    """Write the days of a plain table; returns what selects them from it, None when there is nothing to write."""
    if mode == "full":
        silver = read_if_present(lambda: read_silver(spark, silver_path, merge_schema=merge_schema))
        if silver is None or silver.isEmpty():
            return None
        write_gold(seen(gold_rows(silver), "rows_out"), gold_path, "overwrite")
        return lambda gold: gold
    hours = written_hours(as_utc(as_of), lookback, overlap)
    days = hours.whole_days()
    silver = read_if_present(lambda: read_silver(spark, silver_path, days, merge_schema))
    # What silver may have written: its whole hours, which begin before as_of - lookback.
    if silver is None or silver.filter(hours.prunes(SILVER_HOUR_KEYS)).isEmpty():
        return None
    write_gold(seen(gold_rows(silver), "rows_out"), gold_path, "replace")
    first, last = days.start.date(), (days.end - DAY).date()
    return lambda gold: gold.filter(F.col(GOLD_DAY_KEY).between(F.lit(first), F.lit(last)))


def _publish_days(
    spark: SparkSession, silver_path: str, gold_path: str, mode: LoadMode
) -> Callable[[DataFrame], DataFrame] | None:
    """Publish the days that silver has changed since gold's last load; a day that has become empty becomes so in gold."""
    entries = manifest(spark, gold_path)
    known = None if entries is None else entries.agg(F.max("source")).first()[0]
    places, whole = covered_since(spark, silver_path, known)
    if mode == "full" or entries is None:
        whole = True
    if not places and not whole:
        return None
    number = last_load(spark, silver_path)
    names = sorted({place[:10] for place in places})
    wanted = None if whole else F.substring("at", 1, 10).isin(names)
    silver = read_published(spark, silver_path, SILVER_TABLE, wanted=wanted)
    covered = None if whole else [as_utc(name) for name in names]
    publish(gold_rows(silver), gold_path, (GOLD_DAY_KEY,), covered, F.date_trunc("day", "ingest_ts"), number)
    return (lambda gold: gold) if whole else (lambda gold: gold.filter(F.col(GOLD_DAY_KEY).cast("string").isin(names)))
