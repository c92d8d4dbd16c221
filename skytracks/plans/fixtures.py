"""State reports and snapshot documents derived from the ``events`` table, for queries and tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytracks.functions.times import ISO_SECONDS
from skytracks.schemas import BRONZE

# A document holds reports of one block of 2**10 consecutive rows of an input partition, which
# bounds its size whatever the data.
DOCUMENT_BITS = 10


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def _number(value) -> Column:
    return F.lit(float(value))


def report_columns() -> dict[str, Column]:
    """Bronze columns of an event; every tenth event is reported again an hour later."""
    event_id, user = F.col("event_id"), F.col("user_id").cast("string")
    tp = F.date_format(F.date_trunc("second", "ts"), ISO_SECONDS)
    snap = F.date_trunc("hour", "ts") + F.make_interval(hours=F.col("hours_later"))
    country = F.element_at(
        F.array(F.lit("France"), F.lit("Spain"), F.lit("Italy"), F.lit("Germany")),
        (F.col("user_id") % 4 + 1).cast("int"),
    )
    lon = ((event_id * 104729) % 1500).cast("double") / _number(100) - _number(5.5)
    lat = _number(41) + ((event_id * 7919) % 1050).cast("double") / _number(100)
    return {
        "ingest_ts": F.date_format(snap, ISO_SECONDS),
        "icao24": _unless(_every(97), F.lpad(user, 6, "0")),
        "callsign": F.when(_every(11), "").otherwise(F.concat(F.lit("FL"), user)),
        "origin_country": country,
        "time_position": _unless(_every(101), tp),
        "last_contact": tp,
        "lon": _unless(_every(79), lon),
        "lat": F.when(_every(83), F.lit(None)).when(_every(89), _number(95)).otherwise(lat),
        "baro_altitude": _unless(_every(53), F.col("value") * _number(20)),
        "on_ground": _every(13),
        "velocity": _unless(_every(59), F.col("value")),
        "heading": _unless(_every(61), ((event_id * 31) % 360).cast("double")),
        "vertical_rate": _unless(_every(67), (event_id % 41 - 20).cast("double") / _number(2)),
    }


def bronze_reports(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Bronze rows; ``keep`` names event columns to carry along."""
    offsets = F.when(_every(10), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    reported = events(spark, sf_dir).withColumn("hours_later", F.explode(offsets))
    return reported.select(*keep, *(column.alias(name) for name, column in report_columns().items()))


def _json(value: Column) -> Column:
    """``value`` as a JSON scalar."""
    listed = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return listed.substr(F.lit(2), F.length(listed) - 2)


def snapshot_documents(spark: SparkSession, sf_dir: str, mistyped: bool = False) -> DataFrame:
    """The same reports as raw snapshot documents, in a ``value`` column.

    Callsigns are padded or missing, a missing position time is 0 or null, and vectors have
    12 or 17 slots, or 11 where the last named one is null. With ``mistyped`` some numbers are quoted, some velocities
    are text, and some on_ground flags are quoted.
    """
    rows = bronze_reports(spark, sf_dir, "event_id")
    even = F.col("event_id") % 2 == 0
    raw = {name: F.col(name) for name in BRONZE.names if name != "ingest_ts"}
    raw["callsign"] = F.when((F.col("callsign") == "") & even, F.lit(None)).otherwise(
        F.concat(F.lit(" "), "callsign", F.lit("  \t"))
    )
    position = F.unix_timestamp("time_position", ISO_SECONDS)
    raw["time_position"] = F.when(position.isNull() & even, F.lit(0)).otherwise(position)
    raw["last_contact"] = F.unix_timestamp("last_contact", ISO_SECONDS)
    json = {name: _json(column) for name, column in raw.items()}
    if mistyped:
        for name, every, quoted in (("lon", 5, F.col("lon").cast("string")), ("last_contact", 7, raw["last_contact"].cast("string")),
                                    ("velocity", 8, F.lit("1d")), ("on_ground", 6, F.col("on_ground").cast("string"))):
            json[name] = F.when(_every(every), _json(quoted)).otherwise(json[name])
    last, _ = raw.pop("vertical_rate"), json.pop("vertical_rate")
    tail = F.when(last.isNull(), F.lit("")).otherwise(F.concat(F.lit(","), _json(last)))
    extra = F.when(last.isNotNull() & even, F.lit(',null,1200.5,"7000",false,0')).otherwise(F.lit(""))
    vector = F.concat(F.lit("["), F.concat_ws(",", *json.values()), tail, extra, F.lit("]"))
    block = F.shiftright(F.monotonically_increasing_id(), DOCUMENT_BITS)
    grouped = (
        rows.select("ingest_ts", block.alias("block"), vector.alias("vector"))
        .groupBy("ingest_ts", "block")
        .agg(F.concat_ws(",", F.collect_list("vector")).alias("vectors"))
    )
    time = F.unix_timestamp("ingest_ts", ISO_SECONDS).cast("string")
    return grouped.select(
        F.concat(F.lit('{"time":'), time, F.lit(',"states":['), "vectors", F.lit("]}")).alias("value")
    )
