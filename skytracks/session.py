"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Applied by build_session only where the caller has not set a value.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "skytracks", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or join) a session with the defaults above; ``conf`` keys win.

    Keyword names use ``__`` for dots: ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = DEFAULTS | {name.replace("__", "."): value for name, value in conf.items()}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return pin_utc(builder.getOrCreate())


def pin_utc(spark: SparkSession) -> SparkSession:
    """Report times carry no zone and mean UTC, so the session must read them as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local-mode session without the setting falls back to a folder of its own warehouse.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints")
    return context.getCheckpointDir()


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark).rstrip('/')}/skytracks/{fresh_name(name)}"


def fresh_name(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` as Parquet in the shared folder; later jobs read the columns they need and survive lost executors."""
    path = fresh_dir(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_layout(df: DataFrame) -> DataFrame:
    """Store ``df`` as it is dealt out and sorted, by a checkpoint in the shared folder: reading it needs no exchange, and gives
    the same parts on every cluster."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
