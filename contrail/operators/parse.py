"""From raw payloads / vectors to typed rows.

Two readings of a positional state vector exist:

* the *record* path (``parse_records``): rejects vectors shorter than 17
  slots, strips the callsign of any whitespace and labels a missing one
  ``N/A``, labels a missing country ``UNKNOWN``, defaults ``on_ground`` to
  false and stamps the payload's fetch time;
* the *Silver* path (``flatten_states``): no length rule, blank-trims the
  callsign, upper-cases the blank-trimmed country, converts the position time
  to a timestamp and keeps nulls as nulls.

Both read slots with ``get`` (null past the end, never an error) and cast
with ``try_cast`` (an unparsable value becomes null instead of failing the
job).

Both put out their rows with ``inline``: a filter on typed columns stays above it.
Pushed below, it would evaluate the whole derivation of the vector once more for
every slot it reads, in a method beyond the size that the JVM compiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.text import py_strip
from contrail.functions.timefn import epoch_to_ntz
from contrail.schemas import MIN_VECTOR_SLOTS, SLOT_TYPES, SLOTS

STATE = "state"

# Labels the record path gives a missing callsign / country.
NO_CALLSIGN = "N/A"
NO_COUNTRY = "UNKNOWN"


def slot(name: str, vec: str = STATE) -> Column:
    """Raw text of a named slot (null when the vector is too short)."""
    return F.get(F.col(vec), SLOTS[name])


def typed_slot(name: str, vec: str = STATE) -> Column:
    raw = slot(name, vec)
    kind = SLOT_TYPES[name]
    if kind == "bigint":
        # Integers are rounded from their numeric value (not truncated).
        return F.round(raw.try_cast("double")).try_cast("bigint")
    if kind == "string":
        return raw
    return raw.try_cast(kind)


def explode_payloads(payloads: DataFrame, states: str = "states") -> DataFrame:
    """One row per state vector; payloads without vectors produce no row."""
    others = [c for c in payloads.columns if c != states]
    return payloads.select(*others, F.explode(F.col(states)).alias(STATE))


def parse_records(vectors: DataFrame, min_slots: int = MIN_VECTOR_SLOTS,
                  keep=()) -> DataFrame:
    """Record path: one flight record per vector of at least ``min_slots``
    (``keep``: extra columns carried through, e.g. the ingest time)."""
    raw_call, raw_country = slot("callsign"), slot("origin_country")
    fetched = F.col("fetched_at") if "fetched_at" in vectors.columns else F.lit(None)
    fetch_time = F.coalesce(F.nullif(fetched.cast("bigint"), F.lit(0)),
                            F.col("time").cast("bigint")) if "time" in vectors.columns \
        else fetched.cast("bigint")
    record = F.struct(
        slot("icao24").alias("icao24"),
        F.when(raw_call.isNull() | (raw_call == ""), F.lit(NO_CALLSIGN))
         .otherwise(py_strip(raw_call)).alias("callsign"),
        F.when(raw_country.isNull() | (raw_country == ""), F.lit(NO_COUNTRY))
         .otherwise(raw_country).alias("origin_country"),
        typed_slot("time_position").alias("time_position"),
        typed_slot("last_contact").alias("last_contact"),
        typed_slot("longitude").alias("longitude"),
        typed_slot("latitude").alias("latitude"),
        typed_slot("baro_altitude").alias("baro_altitude"),
        F.coalesce(typed_slot("on_ground"), F.lit(False)).alias("on_ground"),
        typed_slot("velocity").alias("velocity"),
        typed_slot("true_track").alias("true_track"),
        typed_slot("vertical_rate").alias("vertical_rate"),
        typed_slot("geo_altitude").alias("geo_altitude"),
        typed_slot("squawk").alias("squawk"),
    )
    return vectors.select(F.inline(F.when(F.size(STATE) >= min_slots, F.array(record))),
                          fetch_time.alias("time_fetched"), *keep)


def flatten_states(vectors: DataFrame, drop_null_keys: bool = True) -> DataFrame:
    """Silver path: typed, standardized rows with a non-null aircraft and
    position time (duplicates still present).  ``drop_null_keys=False``
    keeps every row (for flagging instead of dropping)."""
    row = F.struct(
        slot("icao24").alias("icao24"),
        F.trim(slot("callsign")).alias("callsign"),
        F.upper(F.trim(slot("origin_country"))).alias("origin_country"),
        typed_slot("time_position").alias("time_position"),
        typed_slot("longitude").alias("longitude"),
        typed_slot("latitude").alias("latitude"),
        typed_slot("baro_altitude").alias("baro_altitude"),
        typed_slot("velocity").alias("velocity"),
        typed_slot("on_ground").alias("on_ground"),
    )
    # the ingest time stays outside: a filter on it reaches the scan
    rows = vectors.select(F.inline(F.array(row)), F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"))
    # the epoch's rules name it several times: they read the parsed number, not its text
    rows = rows.withColumn("time_position", epoch_to_ntz(F.col("time_position")))
    if not drop_null_keys:
        return rows
    return rows.filter(F.col("icao24").isNotNull() & F.col("time_position").isNotNull())


def records_to_silver(records: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Record-shaped rows (flat objects) into the Silver layout.  The record
    path's placeholder labels go back to null so both shapes agree."""
    call = F.trim(F.col("callsign"))
    country = F.upper(F.trim(F.col("origin_country")))
    ing = ingested_at if ingested_at is not None else F.col("ingested_at")
    return records.select(
        F.col("icao24"),
        F.when(call == NO_CALLSIGN, F.lit(None)).otherwise(call).alias("callsign"),
        F.when(country == NO_COUNTRY, F.lit(None)).otherwise(country).alias("origin_country"),
        epoch_to_ntz(F.col("time_position").cast("bigint")).alias("time_position"),
        F.col("longitude").cast("double"),
        F.col("latitude").cast("double"),
        F.col("baro_altitude").cast("double"),
        F.col("velocity").cast("double"),
        F.col("on_ground").cast("boolean"),
        ing.cast("timestamp_ntz").alias("ingested_at"),
    ).filter(F.col("icao24").isNotNull() & F.col("time_position").isNotNull())
