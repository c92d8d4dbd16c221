"""Raw snapshot documents to flat bronze rows, and flat rows to the layout bronze files need."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytracks.functions.text import clean_callsign
from skytracks.functions.times import epoch_to_iso, padded_calendar_parts, parse_time, report_epoch
from skytracks.schemas import BRONZE, INGEST_HOUR_KEYS

# State vectors mix strings, numbers, booleans and nulls: every slot is read with the type it has in the document.
DOCUMENT = "time DOUBLE, states ARRAY<ARRAY<VARIANT>>, _malformed STRING"
# Types of a slot that count as a number; text that looks like one does not.
_NUMBER = "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"

# The position of each named field in a state vector.
SLOTS = (
    "icao24", "callsign", "origin_country", "time_position", "last_contact", "lon",
    "lat", "baro_altitude", "on_ground", "velocity", "heading", "vertical_rate",
)


def flatten_snapshots(
    documents: DataFrame, column: str = "value", on_malformed: Literal["fail", "skip"] = "fail"
) -> DataFrame:
    """One bronze row per state vector of each snapshot document in ``column``.

    Documents whose states are null, missing or empty give no rows. A document that is not
    valid JSON or has no time stops the job, or is left out with ``on_malformed="skip"``. A slot of another type than
    its field's becomes null: quoted numbers, text where a number belongs, anything but true and false on ``on_ground``.
    """
    parsed = documents.select(
        F.from_json(column, DOCUMENT, {"columnNameOfCorruptRecord": "_malformed"}).alias("doc")
    )
    malformed = F.col("doc._malformed").isNotNull() | F.col("doc.time").isNull()
    if on_malformed == "skip":
        parsed = parsed.filter(~malformed)
        states = F.col("doc.states")
    else:
        states = F.when(malformed, F.raise_error(F.lit("malformed snapshot document"))).otherwise(
            F.col("doc.states")
        )
    vectors = parsed.select(F.col("doc.time").alias("time"), F.explode(states).alias("state"))
    return vectors.select(epoch_to_iso(F.col("time")).alias("ingest_ts"), *(_field(name) for name in SLOTS))


def _field(name: str) -> Column:
    # get() is null past the end of a short vector; slots after the named ones are ignored.
    slot = F.get("state", F.lit(SLOTS.index(name)))
    held = F.schema_of_variant(slot)
    number = F.when(held.rlike(_NUMBER), F.try_variant_get(slot, "$", "double"))
    if name == "callsign":
        value = clean_callsign(F.try_variant_get(slot, "$", "string"))
    elif name in ("time_position", "last_contact"):
        value = epoch_to_iso(report_epoch(number))
    elif name == "on_ground":
        value = F.when(held == "BOOLEAN", F.try_variant_get(slot, "$", "boolean"))
    elif BRONZE[name].dataType.typeName() == "double":
        value = number
    else:
        value = F.try_variant_get(slot, "$", "string")
    return value.alias(name)


def with_ingest_hour(rows: DataFrame) -> DataFrame:
    """Add the zero-padded directory keys of the snapshot's hour."""
    ts = parse_time(F.col("ingest_ts"))
    return rows.select("*", *padded_calendar_parts(ts, INGEST_HOUR_KEYS))
