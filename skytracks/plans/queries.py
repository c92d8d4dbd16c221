"""Registered queries: every operator run over reports derived from the ``events`` table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytracks.functions.times import DAY, HOUR, ISO_SECONDS, HourRange, as_utc
from skytracks.operators import clean, motion
from skytracks.operators.counts import counted
from skytracks.operators.forest import assembler, rmse_by_target
from skytracks.operators.snapshot import flatten_snapshots, with_ingest_hour
from skytracks.operators.split import in_train_part
from skytracks.plans import fixtures, gold, silver
from skytracks.plans.histories import moving_reports
from skytracks.plans.ingest import ingest
from skytracks.plans.pipeline import Lake, run
from skytracks.plans.runs import read_runs
from skytracks.plans.predict import predict, predicted_positions
from skytracks.plans.state import DayMotion, state_at
from skytracks.plans.train import fit_and_evaluate, train, training_set
from skytracks.schemas import BRONZE, FEATURES_8, FEATURES_14, GOLD_DAY_KEY, GOLD_TABLE, SILVER_HOUR_KEYS, TARGETS, BoundingBox
from skytracks.session import cut_lineage, fresh_dir, fresh_name, pin_utc
from skytracks.sources.lake import read_bronze, read_flat, read_gold, read_silver, write_bronze, write_silver
from skytracks.sources.staged import read_loads
from skytracks.sources.tables import write_table
from skytracks.streaming.bronze import stream_bronze
from skytracks.streaming.silver import stream_silver

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-15T12:00:00"
# Longer than the time between any two reports of the table.
EVER = timedelta(days=3660)
NARROW_BOX = BoundingBox(43.0, 48.0, 0.0, 6.0)
# A forest of one tree without splits predicts the mean of its train part.
MEAN_FOREST = {"num_trees": 1, "maxDepth": 0, "bootstrap": False}
QUERIES: dict[str, Query] = {}


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _published(query(pin_utc(spark), sf_dir))

    run.__doc__ = query.__doc__
    QUERIES[query.__name__] = run
    return query


def _published(df: DataFrame) -> DataFrame:
    """Times and dates as zone-less text, so that no client's time zone can shift them."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, ISO_SECONDS).alias(field.name)
        elif isinstance(field.dataType, T.DateType):
            column = column.cast("string").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.bronze_reports(spark, sf_dir)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_rows(_bronze(spark, sf_dir))


def _bronze_table(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_dir(spark, "bronze")
    write_bronze(with_ingest_hour(_bronze(spark, sf_dir)), path)
    return path


def _silver_table(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_dir(spark, "silver")
    silver.load_silver(spark, _bronze_table(spark, sf_dir), path, "full")
    return path


# --- ingest -------------------------------------------------------------------------------


@_registered
def bronze_scan(spark, sf_dir):
    """Bronze rows in the fixed bronze layout."""
    return _bronze(spark, sf_dir).to(BRONZE)


@_registered
def bronze_roundtrip(spark, sf_dir):
    """NDJSON by ingest hour, written and scanned back with its directory keys."""
    return read_bronze(spark, _bronze_table(spark, sf_dir)).drop("source_file")


@_registered
def snapshot_flatten(spark, sf_dir):
    """Raw snapshot documents to flat rows."""
    return flatten_snapshots(fixtures.snapshot_documents(spark, sf_dir))


@_registered
def snapshot_mistyped(spark, sf_dir):
    """Documents with quoted numbers and flags and with text for numbers: such slots are null."""
    return flatten_snapshots(fixtures.snapshot_documents(spark, sf_dir, mistyped=True))


@_registered
def snapshot_ingest(spark, sf_dir):
    """Landed documents to bronze files inside the default box."""
    landing, bronze = fresh_dir(spark, "landing"), fresh_dir(spark, "bronze")
    fixtures.snapshot_documents(spark, sf_dir).write.text(landing)
    ingest(spark, landing, bronze, one_per_line=True)
    return read_bronze(spark, bronze).drop("source_file")


@_registered
def snapshot_files(spark, sf_dir):
    """Documents landed one per file, to bronze files of any place."""
    landing, bronze = fresh_dir(spark, "landing"), fresh_dir(spark, "bronze")
    fixtures.snapshot_documents(spark, sf_dir).write.option("maxRecordsPerFile", 1).text(landing)
    ingest(spark, landing, bronze, box=None)
    return read_bronze(spark, bronze).drop("source_file")


@_registered
def stream_ingest(spark, sf_dir):
    """The same documents to bronze through the file stream."""
    landing, bronze = fresh_dir(spark, "landing"), fresh_dir(spark, "bronze")
    fixtures.snapshot_documents(spark, sf_dir).write.text(landing)
    checkpoint = fresh_dir(spark, "stream")
    stream_bronze(spark, landing, bronze, checkpoint, one_per_line=True).awaitTermination()
    return read_bronze(spark, bronze).drop("source_file")


@_registered
def bbox_filter(spark, sf_dir):
    return clean.in_box(_bronze(spark, sf_dir))


@_registered
def bbox_narrow(spark, sf_dir):
    return clean.in_box(_bronze(spark, sf_dir), NARROW_BOX)


# --- silver -------------------------------------------------------------------------------


@_registered
def incremental_window(spark, sf_dir):
    """Typed reports ingested after one hour before a fixed point in time."""
    return clean.recent(clean.typed_times(_bronze(spark, sf_dir)), AS_OF)


@_registered
def quality_filter(spark, sf_dir):
    return clean.valid_reports(clean.typed_times(_bronze(spark, sf_dir)))


@_registered
def silver_full(spark, sf_dir):
    """Clean silver: typed, valid, one row per aircraft and position time."""
    return _silver(spark, sf_dir)


@_registered
def silver_recent(spark, sf_dir):
    """Silver of one incremental window, de-duplicated within it."""
    return silver.recent_silver_rows(_bronze(spark, sf_dir), AS_OF)


@_registered
def silver_parts(spark, sf_dir):
    """Rows per silver directory."""
    return _silver(spark, sf_dir).groupBy(*SILVER_HOUR_KEYS).agg(F.count(F.lit(1)).alias("rows"))


@_registered
def silver_roundtrip(spark, sf_dir):
    """Full load from bronze files to silver files, scanned back."""
    return read_silver(spark, _silver_table(spark, sf_dir)).drop("source_file")


@_registered
def silver_incremental(spark, sf_dir):
    """Twelve hours loaded into an empty silver table, and then the same load again."""
    bronze, path = _bronze_table(spark, sf_dir), fresh_dir(spark, "silver")
    for _ in range(2):
        silver.load_silver(spark, bronze, path, "incremental", AS_OF, lookback=12 * silver.HOUR)
    return read_silver(spark, path).drop("source_file")


@_registered
def stream_silver_keys(spark, sf_dir):
    """Keys that the streaming form of silver keeps; which copy it keeps is not defined."""
    bronze, path = _bronze_table(spark, sf_dir), fresh_dir(spark, "silver")
    stream_silver(spark, bronze, path, fresh_dir(spark, "stream")).awaitTermination()
    return read_silver(spark, path).select("icao24", "time_position")


@_registered
def stream_silver_rows(spark, sf_dir):
    """Silver through the file stream, in several batches, with repeats found across all of the table."""
    bronze, path = _bronze_table(spark, sf_dir), fresh_dir(spark, "silver")
    stream_silver(spark, bronze, path, fresh_dir(spark, "stream"), EVER, maxFilesPerTrigger=400).awaitTermination()
    return read_silver(spark, path).drop("source_file")


@_registered
def bronze_lineage(spark, sf_dir):
    """Rows per directory that the lineage column of a bronze scan names."""
    parts = F.regexp_extract("source_file", r"(ingest_year=\d+/ingest_month=\d+/ingest_day=\d+/ingest_hour=\d+)/", 1)
    return read_bronze(spark, _bronze_table(spark, sf_dir)).groupBy(parts.alias("directory")).agg(
        F.count(F.lit(1)).alias("rows")
    )


# --- motion and training rows -------------------------------------------------------------


@_registered
def motion_features(spark, sf_dir):
    """Previous-report columns and rates of every silver row."""
    return motion.with_motion(motion.motion_inputs(_silver(spark, sf_dir)))


@_registered
def scoring_features(spark, sf_dir):
    """Rows that can be scored with the short feature list."""
    moving = motion.with_motion(motion.motion_inputs(_silver(spark, sf_dir)), motion.previous_for(FEATURES_8))
    return motion.scoring_rows(moving, FEATURES_8).select("icao24", "time_position", *FEATURES_8)


@_registered
def future_targets(spark, sf_dir):
    """Positions five rows ahead."""
    ahead = motion.with_future(motion.motion_inputs(_silver(spark, sf_dir)))
    return ahead.select("icao24", "time_position", *TARGETS.values())


@_registered
def training_rows(spark, sf_dir):
    """Rows with complete features and targets."""
    rows = training_set(_silver(spark, sf_dir))
    return rows.select("icao24", "time_position", *FEATURES_14, *TARGETS.values())


@_registered
def split_flags(spark, sf_dir):
    """Side of the train / test split of every training row."""
    rows = training_set(_silver(spark, sf_dir))
    return rows.select("icao24", "time_position", in_train_part().alias("is_train"))


@_registered
def split_counts(spark, sf_dir):
    flagged = training_set(_silver(spark, sf_dir)).select(in_train_part().alias("is_train"))
    return flagged.groupBy("is_train").agg(F.count(F.lit(1)).alias("rows"))


def _slots(rows: DataFrame, features) -> DataFrame:
    slots = vector_to_array("features")
    assembled = assembler(features).transform(rows)
    return assembled.select(
        "icao24", "time_position", *(F.get(slots, F.lit(i)).alias(f"f{i}") for i in range(len(features)))
    )


@_registered
def feature_vector(spark, sf_dir):
    """The assembled vector of fourteen features, one column per slot."""
    return _slots(training_set(_silver(spark, sf_dir)), FEATURES_14)


@_registered
def feature_vector_complete(spark, sf_dir):
    """Vectors of all silver rows with motion: rows that lack a feature are left out by the assembler."""
    return _slots(motion.with_motion(motion.motion_inputs(_silver(spark, sf_dir))), FEATURES_14)


@_registered
def feature_vector_short(spark, sf_dir):
    """The assembled vector of eight features, one column per slot."""
    return _slots(training_set(_silver(spark, sf_dir), FEATURES_8), FEATURES_8)


@_registered
def stage_counts(spark, sf_dir):
    """Rows left after each stage, counted in the one pass that makes the training rows."""
    seen = {}

    def count(rows: DataFrame, stage: str) -> DataFrame:
        rows, seen[stage] = counted(rows, f"{stage}_{fresh_name('rows')}")
        return rows

    typed = clean.typed_times(count(_bronze(spark, sf_dir), "bronze"))
    valid = count(clean.valid_reports(typed), "valid")
    rows = count(clean.with_silver_hour(clean.first_reports(valid)), "silver")
    count(training_set(cut_lineage(rows)), "training").write.format("noop").mode("overwrite").save()
    found = [(stage, observation.get["rows"]) for stage, observation in seen.items()]
    return spark.createDataFrame(found, "stage STRING, rows LONG")


@_registered
def run_counts(spark, sf_dir):
    """The run table of a whole run: rows that its stages read and wrote, and the errors of its training."""
    root = _whole_run(spark, sf_dir, with_training=True)
    runs = read_runs(spark, Lake(root).runs).filter("mode = 'full'")
    return runs.select("stage", "measure", F.round("value", 6).alias("value"))


@_registered
def whole_run_predictions(spark, sf_dir):
    """Predictions of a whole run with training, and then of an incremental run over its last days, by the state of last reports."""
    root = _whole_run(spark, sf_dir, with_training=True)
    run(spark, root, mode="incremental", as_of=AS_OF, lookback=12 * HOUR)
    names = [f"predicted_{name}" for name in TARGETS]
    return spark.read.parquet(Lake(root).predictions).withColumns({name: F.round(name, 6) for name in names})


def _whole_run(spark: SparkSession, sf_dir: str, **options) -> str:
    landing, root = fresh_dir(spark, "landing"), fresh_dir(spark, "lake")
    fixtures.snapshot_documents(spark, sf_dir).write.text(landing)
    run(spark, root, landing, "full", AS_OF, one_per_line=True, forest_params=MEAN_FOREST, **options)
    return root


# --- gold ---------------------------------------------------------------------------------


@_registered
def gold_states(spark, sf_dir):
    return gold.gold_rows(_silver(spark, sf_dir))


@_registered
def gold_recent(spark, sf_dir):
    return gold.recent_gold_rows(_silver(spark, sf_dir), AS_OF)


@_registered
def gold_roundtrip(spark, sf_dir):
    """Full gold load from silver files, scanned back."""
    path = fresh_dir(spark, "gold")
    gold.load_gold(spark, _silver_table(spark, sf_dir), path, "full")
    return spark.read.parquet(path).drop("source_file")


@_registered
def gold_incremental(spark, sf_dir):
    """Twelve hours loaded into silver and published, and then both again."""
    bronze, path, published = _bronze_table(spark, sf_dir), fresh_dir(spark, "silver"), fresh_dir(spark, "gold")
    for _ in range(2):
        silver.load_silver(spark, bronze, path, "incremental", AS_OF, lookback=12 * silver.HOUR)
        gold.load_gold(spark, path, published, "incremental", AS_OF, lookback=12 * silver.HOUR)
    return spark.read.parquet(published).drop("source_file")


@_registered
def whole_run(spark, sf_dir):
    """Landed documents to published gold by the whole run, and then the same run again."""
    landing, root = fresh_dir(spark, "landing"), fresh_dir(spark, "lake")
    fixtures.snapshot_documents(spark, sf_dir).write.text(landing)
    for _ in range(2):
        run(spark, root, landing, "full", AS_OF, one_per_line=True, with_predictions=False)
    return spark.read.parquet(Lake(root).gold).drop("source_file")


# An hour that is emptied, and by how much copies come after their report.
EMPTIED = as_utc("2024-01-15T12:00:00")
COPY_LATER = 30 * HOUR


def _late_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze reports, every seventh of them reported once more thirty hours after its snapshot."""
    rows = fixtures.bronze_reports(spark, sf_dir, "event_id")
    later = F.date_format(F.try_to_timestamp("ingest_ts") + F.lit(COPY_LATER), ISO_SECONDS)
    return rows.unionByName(rows.filter("event_id % 7 = 0").withColumn("ingest_ts", later)).drop("event_id")


def _published_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Silver and gold published from ten-day loads out of order, then an hour that bronze has lost loaded again."""
    lake, rows = Lake(fresh_dir(spark, "lake")), with_ingest_hour(_late_copies(spark, sf_dir))
    write_bronze(rows, lake.bronze)
    starts = [as_utc("2024-01-01") + 10 * DAY * step for step in (1, 0, 3, 2)]
    loads = [HourRange(start, start + 10 * DAY) for start in starts]
    for hours in loads:
        silver.load_silver(spark, lake.bronze, lake.silver, as_of=hours.end - HOUR, lookback=10 * DAY - HOUR, overlap=0 * HOUR, published=True)
    gold.load_gold(spark, lake.silver, lake.gold)
    left = fresh_dir(spark, "bronze")
    write_bronze(rows.filter(F.date_trunc("hour", F.try_to_timestamp("ingest_ts")) != F.lit(EMPTIED)), left)
    silver.load_silver(spark, left, lake.silver, as_of=EMPTIED, lookback=0 * HOUR, overlap=0 * HOUR)
    gold.load_gold(spark, lake.silver, lake.gold)
    return lake


@_registered
def silver_published(spark, sf_dir):
    """Loads out of order with copies thirty hours apart and an hour that becomes empty: what a full load gives."""
    return read_silver(spark, _published_lake(spark, sf_dir).silver).drop("source_file")


@_registered
def gold_published(spark, sf_dir):
    """Gold of the same loads, which follows what silver's loads have changed."""
    return read_gold(spark, _published_lake(spark, sf_dir).gold).drop("source_file")


@_registered
def gold_connector(spark, sf_dir):
    """Gold through a connector by ``load_gold``, run twice: the second load appends nothing."""
    path, published, sink = _silver_table(spark, sf_dir), fresh_dir(spark, "gold"), fresh_dir(spark, "sink")
    for _ in range(2):
        gold.load_gold(spark, path, published, "full", connector="staged_loads", connector_options={"path": sink})
    return read_loads(spark, sink, GOLD_TABLE).drop("source_file")


@_registered
def silver_merged_scan(spark, sf_dir):
    """Silver with merged schema: the days after the middle of the month have files with a column more."""
    rows, path = _silver(spark, sf_dir), fresh_dir(spark, "silver")
    later = F.col("ingest_ts") >= F.lit(as_utc(AS_OF))
    write_silver(rows.filter(~later), path, "append")
    write_silver(rows.filter(later).withColumn("squawk", F.upper("icao24")), path, "append")
    return read_silver(spark, path, merge_schema=True)


@_registered
def gold_from_table(spark, sf_dir):
    """Gold published to a catalog table by ``load_gold``, whole and then some of its days again."""
    path, published, files = _silver_table(spark, sf_dir), fresh_dir(spark, "gold"), fresh_dir(spark, "table")
    name = f"gold_{files.rsplit('-', 1)[1]}"
    write_table(read_gold_layout(spark), name, partition_by=GOLD_DAY_KEY, path=files)
    gold.load_gold(spark, path, published, "full", table=name)
    gold.load_gold(spark, path, published, "incremental", AS_OF, lookback=12 * HOUR, table=name)
    found = cut_lineage(spark.table(name).drop("source_file"))
    spark.sql(f"DROP TABLE {name}")
    return found


def read_gold_layout(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], GOLD_TABLE)


@_registered
def silver_since_now(spark, sf_dir):
    """Reports of the last hours by the clock: the table's times are moved so that its last report came just now."""
    typed = clean.typed_times(_bronze(spark, sf_dir))
    last = typed.agg(F.max("ingest_ts").alias("last"))
    shift = F.current_timestamp() - F.col("last")
    moved = typed.withColumn("one", F.lit(1)).join(last.withColumn("one", F.lit(1)), "one").drop("one")
    fresh = clean.recent(moved.withColumn("told", F.col("ingest_ts")).withColumn("ingest_ts", F.col("ingest_ts") + shift), lookback=12 * HOUR)
    return fresh.drop("last", "ingest_ts").withColumnRenamed("told", "ingest_ts")


@_registered
def gold_merged_scan(spark, sf_dir):
    """Recursive scan of silver with merged schema: the directory keys are gone."""
    path = fresh_dir(spark, "silver")
    write_silver(_silver(spark, sf_dir), path, "overwrite")
    return gold.gold_rows(read_flat(spark, path))


def _without_name(spark: SparkSession, name: str, path: str) -> DataFrame:
    """The rows of an external table whose name is given up."""
    layout = spark.table(name).schema
    spark.sql(f"DROP TABLE {name}")
    return spark.read.schema(layout).parquet(path)


@_registered
def gold_table(spark, sf_dir):
    """Gold in a catalog table: created, then every other day replaced by itself."""
    rows, path = gold.gold_rows(_silver(spark, sf_dir)), fresh_dir(spark, "table")
    name = f"gold_{path.rsplit('-', 1)[1]}"
    write_table(rows, name, partition_by=GOLD_DAY_KEY, path=path)
    write_table(rows.filter(F.dayofmonth(GOLD_DAY_KEY) % 2 == 0), name, "replace", partition_by=GOLD_DAY_KEY)
    return _without_name(spark, name, path)


@_registered
def bronze_append_table(spark, sf_dir):
    """Bronze rows appended to an existing catalog table of the same layout, a day's parity at a time."""
    rows, path = _bronze(spark, sf_dir), fresh_dir(spark, "table")
    name = f"bronze_{path.rsplit('-', 1)[1]}"
    even = F.dayofmonth(F.try_to_timestamp("ingest_ts")) % 2 == 0
    write_table(rows.filter(even), name, path=path)
    write_table(rows.filter(~even), name)
    return _without_name(spark, name, path)


# --- models -------------------------------------------------------------------------------


@_registered
def rmse_metric(spark, sf_dir):
    """The error measure, taken of the guess that an aircraft stays where it is."""
    rows = training_set(_silver(spark, sf_dir)).withColumns(
        {"predicted_lat": F.col("lat"), "predicted_lon": F.col("lon"), "predicted_alt": F.col("baro_altitude")}
    )
    return rmse_by_target(rows).withColumn("rmse", F.round("rmse", 6))


@_registered
def rf_rmse(spark, sf_dir):
    """Error of the three forests on the test part."""
    return fit_and_evaluate(training_set(_silver(spark, sf_dir)))[1]


@_registered
def forest_mean_rmse(spark, sf_dir):
    """Error, on the test part, of forests that predict the mean of the train part."""
    errors = fit_and_evaluate(training_set(_silver(spark, sf_dir)), **MEAN_FOREST)[1]
    return errors.withColumn("rmse", F.round("rmse", 6))


@_registered
def forest_mean_predictions(spark, sf_dir):
    """Such forests fitted on silver files, saved, loaded, applied; their predictions written and read."""
    path, models, scored = _silver_table(spark, sf_dir), fresh_dir(spark, "models"), fresh_dir(spark, "predictions")
    train(spark, path, models, **MEAN_FOREST)
    predict(spark, path, models, scored)
    names = [f"predicted_{name}" for name in TARGETS]
    return spark.read.parquet(scored).drop(GOLD_DAY_KEY).withColumns({name: F.round(name, 6) for name in names})


@_registered
def scoring_incremental(spark, sf_dir):
    """Features of the reports of twelve hours; previous reports may lie any time before them."""
    hours = silver.written_hours(as_utc(AS_OF), 12 * silver.HOUR, silver.HOUR)
    moving = moving_reports(read_silver(spark, _silver_table(spark, sf_dir)), FEATURES_14, hours=hours)
    return motion.scoring_rows(moving).select("icao24", "time_position", *FEATURES_14)


@_registered
def scoring_from_state(spark, sf_dir):
    """Features of the reports of twelve hours, from the day's silver and the state of last reports before it."""
    hours = silver.written_hours(as_utc(AS_OF), 12 * silver.HOUR, silver.HOUR)
    path, kept = _silver_table(spark, sf_dir), fresh_dir(spark, "state")
    # A state of an earlier day, from which the asked one is moved on.
    state_at(spark, path, kept, hours.start - 5 * DAY)
    moving = DayMotion(spark, path, kept, hours).motion(FEATURES_14)
    scored = motion.scoring_rows(moving).filter(hours.contains(F.col("ingest_ts")))
    return scored.select("icao24", "time_position", *FEATURES_14)


@_registered
def training_incremental(spark, sf_dir):
    """Training rows of twelve hours; previous reports and targets may lie outside them."""
    hours = silver.written_hours(as_utc(AS_OF), 12 * silver.HOUR, silver.HOUR)
    rows = training_set(read_silver(spark, _silver_table(spark, sf_dir)), hours=hours)
    return rows.select("icao24", "time_position", *FEATURES_14, *TARGETS.values())


@_registered
def forest_mean_days(spark, sf_dir):
    """All predictions by mean forests, and then again those of the days of twelve hours, in place."""
    path, models, scored = _silver_table(spark, sf_dir), fresh_dir(spark, "models"), fresh_dir(spark, "predictions")
    train(spark, path, models, **MEAN_FOREST)
    for hours in (None, silver.written_hours(as_utc(AS_OF), 12 * silver.HOUR, silver.HOUR)):
        predict(spark, path, models, scored, hours)
    names = [f"predicted_{name}" for name in TARGETS]
    return spark.read.parquet(scored).withColumns({name: F.round(name, 6) for name in names})


@_registered
def predictions_in_range(spark, sf_dir):
    """Scored reports, and whether each prediction lies between the least and largest target of the train part."""
    rows = _silver(spark, sf_dir)
    known = training_set(rows)
    model, _ = fit_and_evaluate(known)
    bounds = known.filter(in_train_part()).agg(
        *(extreme(label).alias(f"{end}_{name}") for name, label in TARGETS.items()
          for end, extreme in (("least", F.min), ("most", F.max)))
    )
    # One row of bounds, met by a constant key.
    scored = predicted_positions(model, rows).withColumn("one", F.lit(1)).join(bounds.withColumn("one", F.lit(1)), "one")
    inside = [F.col(f"predicted_{name}").between(F.col(f"least_{name}"), F.col(f"most_{name}")) for name in TARGETS]
    return scored.select("icao24", "time_position", reduce(and_, inside).alias("in_range"))


@_registered
def predictions(spark, sf_dir):
    """Predicted positions of all silver rows with complete features."""
    rows = _silver(spark, sf_dir)
    model, _ = fit_and_evaluate(training_set(rows))
    return predicted_positions(model, rows)
