"""Headline queries, the median of three runs after a warm-up. Prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose tables and cores. With BENCH_PLAIN=1 the plain Spark forms
of the same work are timed as well, under "plain".
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytracks.functions.times import HOUR, HourRange, as_utc
from skytracks.operators import clean, motion
from skytracks.operators.snapshot import with_ingest_hour
from skytracks.plans import fixtures
from skytracks.plans.gold import load_gold
from skytracks.plans.predict import predict
from skytracks.plans.queries import QUERIES
from skytracks.plans.silver import load_silver
from skytracks.plans.train import train
from skytracks.session import build_session, fresh_dir
from skytracks.sources.lake import read_bronze, read_silver, write_bronze

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
AS_OF = "2024-01-15T12:00:00"
IN_MEMORY = (
    "snapshot_flatten", "bbox_filter", "quality_filter", "silver_full", "silver_parts",
    "motion_features", "future_targets", "training_rows", "split_counts", "feature_vector", "gold_states",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def plain_motion(silver: DataFrame) -> DataFrame:
    w = Window.partitionBy("icao24").orderBy("time_position", "ingest_ts")
    found = silver
    for name, source in motion.PREVIOUS.items():
        found = found.withColumn(name, F.lag(source, 1).over(w))
    return motion.with_rates(found)


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    bronze, silver, gold, models, out = (
        fresh_dir(spark, name) for name in ("bronze", "silver", "gold", "models", "predictions")
    )
    write_bronze(with_ingest_hour(fixtures.bronze_reports(spark, SF_DIR)), bronze)

    jobs = {name: lambda name=name: run(QUERIES[name](spark, SF_DIR)) for name in IN_MEMORY}
    jobs["bronze_scan_files"] = lambda: run(read_bronze(spark, bronze))
    jobs["silver_full_load"] = lambda: load_silver(spark, bronze, silver, "full")
    jobs["silver_incremental_load"] = lambda: load_silver(spark, bronze, silver, "incremental", AS_OF)
    jobs["gold_full_load"] = lambda: load_gold(spark, silver, gold, "full")
    jobs["gold_incremental_load"] = lambda: load_gold(spark, silver, gold, "incremental", AS_OF)
    jobs["motion_from_silver"] = lambda: run(motion.with_motion(motion.motion_inputs(read_silver(spark, silver))))
    jobs["train_models"] = lambda: train(spark, silver, models).collect()
    jobs["predict_all"] = lambda: predict(spark, silver, models, out)
    jobs["predict_days"] = lambda: predict(spark, silver, models, out, HourRange.covering(as_utc(AS_OF), HOUR))
    # The state is made by the first of the runs and read by the others.
    state = fresh_dir(spark, "state")
    jobs["predict_days_from_state"] = lambda: predict(spark, silver, models, out, HourRange.covering(as_utc(AS_OF), HOUR), state)

    plain = {}
    typed = clean.valid_reports(clean.typed_times(read_bronze(spark, bronze)))
    recent = clean.recent(clean.typed_times(read_bronze(spark, bronze)), AS_OF, HOUR)
    rows = fixtures.bronze_reports(spark, SF_DIR)
    distinct = clean.with_silver_hour(
        clean.valid_reports(clean.typed_times(rows)).dropDuplicates(["icao24", "time_position"])
    )
    plain["silver_full"] = lambda: run(distinct)
    plain["motion_features"] = lambda: run(plain_motion(distinct))
    plain["motion_from_silver"] = lambda: run(plain_motion(read_silver(spark, silver)))
    plain["silver_full_load"] = lambda: (
        clean.with_silver_hour(typed.dropDuplicates(["icao24", "time_position"]))
        .write.mode("overwrite").partitionBy("year", "month", "day", "hour").parquet(fresh_dir(spark, "plain"))
    )
    plain["silver_incremental_load"] = lambda: (
        clean.with_silver_hour(clean.valid_reports(recent).dropDuplicates(["icao24", "time_position"]))
        .write.mode("append").partitionBy("year", "month", "day", "hour").parquet(fresh_dir(spark, "plain"))
    )

    def timed(work) -> float:
        work()
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            work()
            runs.append(time.perf_counter() - start)
        return round(statistics.median(runs), 3)

    seconds = {name: timed(work) for name, work in jobs.items()}
    report = {
        "metric": "total wall time of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    report["plain"] = {name: timed(work) for name, work in plain.items()}
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
