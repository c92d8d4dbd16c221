"""Writing to catalog tables or any other connector Spark has."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytracks.sources.files import clustered
from skytracks.sources.lake import WriteMode
from skytracks.sources.staged import StagedLoads


def write_table(
    rows: DataFrame,
    table: str,
    mode: WriteMode = "append",
    fmt: str = "parquet",
    partition_by: str | None = None,
    **options,
) -> None:
    """Write ``rows`` to a catalog table. Failures are raised.

    An existing table keeps its layout: columns are matched by name and a different column
    set is refused. ``replace`` swaps only the partitions that ``rows`` holds. Name the partition
    column of an existing table too, so that its rows are brought together before the write.
    """
    spark = rows.sparkSession
    if partition_by is not None:
        rows = clustered(rows, (partition_by,))
    if mode != "overwrite" and spark.catalog.tableExists(table):
        target = spark.table(table).columns
        if set(target) != set(rows.columns):
            raise ValueError(f"{table} has columns {target}, rows have {rows.columns}")
        writer = rows.select(*target).write
        if mode == "replace":
            with _replacing_partitions(spark):
                writer.insertInto(table, overwrite=True)
        else:
            writer.insertInto(table)
        return
    writer = rows.write.format(fmt).options(**options)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.mode("overwrite" if mode == "overwrite" else "errorifexists").saveAsTable(table)


@contextmanager
def _replacing_partitions(spark: SparkSession) -> Iterator[None]:
    """insertInto takes the overwrite mode from the session only, not from a writer option."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_connector(rows: DataFrame, fmt: str, mode: str = "append", **options) -> None:
    """Write through a connector named by ``fmt``, such as a warehouse data source on the class path."""
    rows.write.format(fmt).options(**options).mode(mode).save()


def load_name(rows: DataFrame) -> str:
    """A name that equal rows share, whatever their order and the files they lie in."""
    held = F.xxhash64(*(F.col(name) for name in sorted(rows.columns)))
    sums = [F.sum(part.cast("decimal(38, 0)")) for part in (held, F.xxhash64(held, F.lit(1)))]
    count, *found = rows.agg(F.count(F.lit(1)), *sums).first()
    return "-".join(str(value) for value in (count, *found))


def write_load(rows: DataFrame, fmt: str, **options) -> None:
    """Append ``rows`` through a connector as one load; the option ``load`` names it, by its contents if not given."""
    if fmt == StagedLoads.name():
        rows.sparkSession.dataSource.register(StagedLoads)
    write_connector(rows, fmt, **({"load": load_name(rows)} | options))
