"""Tables whose readers follow a manifest: each load names the hours (or days) it covers and the files it brings.

A load writes its files into a folder of its own, ``load=<name>``, and becomes visible when its manifest does, by the one rename
that commits a write of one file. A file counts while no later load covers its place. So readers see the table before or after a
load and nothing between, an hour that a load covers without rows is empty, and a load that dies leaves nothing but unseen
files. Beside each file stand the range of its aircraft and the days of its position times, so that a few aircraft, or the
copies of some reports, are looked for in the files that may hold them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skytracks.functions.times import HourRange
from skytracks.session import fresh_name
from skytracks.sources.files import clustered, exists

# ``at`` is the start of a place, an hour or a day. Rows without a path say what a load covers, and everything where at is null too.
_ENTRY = (
    "number LONG, at STRING, path STRING, rows LONG, least STRING, most STRING, days ARRAY<STRING>, untimed LONG, source LONG"
)
_AT = "yyyy-MM-dd'T'HH"


def place_name(moment: datetime) -> str:
    return moment.strftime("%Y-%m-%dT%H")


def manifest(spark: SparkSession, root: str) -> DataFrame | None:
    """All entries of a published table; None for any other table."""
    path = f"{root.rstrip('/')}/_manifest"
    return spark.read.schema(_ENTRY).json(f"{path}/*") if exists(spark, path) else None


def last_load(spark: SparkSession, root: str) -> int | None:
    entries = manifest(spark, root)
    return None if entries is None else entries.agg(F.max("number")).first()[0]


def rows_since(spark: SparkSession, root: str, number: int | None) -> int | None:
    """Rows that the loads after ``number`` have brought, as their manifests say; None if the table is not published."""
    entries = manifest(spark, root)
    if entries is None:
        return None
    return entries.filter(F.col("number") > (-1 if number is None else number)).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def live_files(spark: SparkSession, root: str) -> DataFrame | None:
    """The entries of the files that make up the table now."""
    entries = manifest(spark, root)
    if entries is None:
        return None
    covers = entries.filter("path is null")
    whole = covers.filter("at is null").agg(F.max("number")).first()[0]
    since = entries.filter(F.col("number") >= (0 if whole is None else whole))
    latest = since.filter("path is null and at is not null").groupBy("at").agg(F.max("number").alias("latest"))
    files = since.filter("path is not null").join(latest, "at", "left")
    return files.filter("latest is null or number >= latest").drop("latest")


def covered_since(spark: SparkSession, root: str, number: int | None) -> tuple[list[str], bool]:
    """The places that loads after ``number`` cover (bounded by the calendar), and whether one of them covers everything."""
    covers = manifest(spark, root).filter("path is null")
    if number is not None:
        covers = covers.filter(F.col("number") > number)
    found = [row["at"] for row in covers.select("at").distinct().collect()]
    return sorted(at for at in found if at), None in found


def read_published(
    spark: SparkSession, root: str, schema: StructType, hours: HourRange | None = None, wanted: Column | None = None
) -> DataFrame | None:
    """The rows of the table's live files, or of those in ``hours`` and, by their entries, ``wanted``; None if it is not published."""
    files = live_files(spark, root)
    if files is None:
        return None
    if hours is not None:
        files = files.filter(F.col("at").between(place_name(hours.start), place_name(hours.end)) & (F.col("at") < place_name(hours.end)))
    if wanted is not None:
        files = files.filter(wanted)
    base = root.rstrip("/")
    # Spark lists the files of a table on the driver in any case.
    paths = [f"{base}/{row['path']}" for row in files.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def of_aircraft(names: Iterable[str]) -> Column:
    """Entries of files that may hold one of the aircraft."""
    listed = F.array(*(F.lit(name) for name in names))
    return F.exists(listed, lambda name: (F.col("least") <= name) & (name <= F.col("most")))


def of_position_days(days: Sequence[str], untimed: bool) -> Column:
    """Entries of files that may hold a report with a position time of one of the days, or with none."""
    listed = F.array(*(F.lit(day) for day in days)).cast("array<string>")
    found = F.arrays_overlap("days", listed)
    return found | (F.col("untimed") > 0) if untimed else found


def publish(
    rows: DataFrame,
    root: str,
    keys: Sequence[str],
    covered: Iterable[datetime] | None,
    place: Column,
    source: int | None = None,
    ranged: bool = False,
) -> int:
    """Write ``rows`` as one load that covers the places ``covered``, or everything, and make it visible. Returns its number.

    ``place`` is the hour or day a row belongs to; all rows lie in covered places. ``source`` notes the load of another table
    that this one was made from. With ``ranged`` the files of a place hold ranges of aircraft, for rows that are cheap to read twice.
    Of two loads begun at once the later one fails.
    """
    spark, base = rows.sparkSession, root.rstrip("/")
    before = last_load(spark, root)
    number = 0 if before is None else before + 1
    folder = f"{base}/load={fresh_name(f'{number:09d}')}"
    within = ("icao24", "time_position")
    # Ranges that adaptive execution merges stay in order, so a file holds neighbours only.
    placed = rows.repartitionByRange(*keys, "icao24").sortWithinPartitions(*keys, *within) if ranged else clustered(rows, keys, within)
    placed.write.partitionBy(*keys).parquet(folder)
    written = spark.read.schema(rows.schema).parquet(folder)
    name = F.regexp_extract(F.col("_metadata.file_path"), "(load=.*)$", 1)
    entries = written.select("*", name.alias("_file"), F.date_format(place, _AT).alias("_at")).groupBy("_file").agg(
        F.min("_at").alias("at"),
        F.count(F.lit(1)).alias("rows"),
        F.min("icao24").alias("least"),
        F.max("icao24").alias("most"),
        F.sort_array(F.collect_set(F.col("time_position").cast("date").cast("string"))).alias("days"),
        F.count_if(F.col("time_position").isNull()).alias("untimed"),
    )
    numbered = entries.withColumnRenamed("_file", "path").withColumn("number", F.lit(number)).withColumn("source", F.lit(source).cast("long"))
    # A load that covers nothing has a mark all the same, of no place.
    places = [None] if covered is None else sorted({place_name(moment) for moment in covered}) or [""]
    marks = spark.createDataFrame([(number, at, source) for at in places], "number LONG, at STRING, source LONG")
    # One task and one file: the rename that commits it is the moment of the load.
    numbered.unionByName(marks, allowMissingColumns=True).coalesce(1).write.json(f"{base}/_manifest/{number:09d}")
    return number


def compact_manifest(spark: SparkSession, root: str) -> None:
    """One manifest that says what all of them say; the older ones and folders without live files can go (``remove_unused``)."""
    base, number = root.rstrip("/"), last_load(spark, root) + 1
    sources = manifest(spark, root).agg(F.max("source")).first()[0]
    live = live_files(spark, root).withColumn("number", F.lit(number).cast("long"))
    mark = spark.createDataFrame([(number, None, sources)], "number LONG, at STRING, source LONG")
    live.unionByName(mark, allowMissingColumns=True).coalesce(1).write.json(f"{base}/_manifest/{number:09d}")


def remove_unused(spark: SparkSession, root: str) -> list[str]:
    """Delete load folders without a live file, also those of loads that died. No load and no reader of an older state may be at work."""
    base = root.rstrip("/")
    live = live_files(spark, root).select(F.regexp_extract("path", "^(load=[^/]*)/", 1).alias("folder")).distinct()
    used = {row["folder"] for row in live.collect()}
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    removed = []
    for entry in files.listStatus(path):
        name = entry.getPath().getName()
        if name.startswith("load=") and name not in used:
            files.delete(entry.getPath(), True)
            removed.append(name)
    return sorted(removed)
