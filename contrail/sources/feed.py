"""The state-vector feed derived from the driver tables.

``events`` joined to ``nation`` becomes one raw state vector per event, in
the positional string form the upstream API delivers (every value as text,
JSON null as null).  Deterministic rules inject the defects the pipeline
must handle: null keys, empty and blank-padded callsigns, padded country
names, null coordinates, altitudes and ground flags, unparsable numbers, position times outside the valid range and
short vectors.  Position times fold 30 days into six hours of five-minute
slots so that the same aircraft reports the same position time many times
(dedup work) and many aircraft share a group (aggregation work).

Every event becomes a vector; nothing is filtered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.timefn import ntz_to_epoch
from contrail.sources.tables import table

# Fixed values of the derivation (also used by the SQL oracle).
ICAO_BASE = 4194304            # 0x400000: every address prints as >= 6 hex digits
EPOCH_BASE = 1704067200        # 2024-01-01 00:00:00 UTC
JITTER = 0.0103711317          # odd on purpose: keeps averages off rounding ties
FEET_PER_VALUE = 80
BAD_EPOCH = 99999999999999     # milliseconds sent as seconds: far outside the valid range


EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value")


def _null_if(eid: Column, modulus: int, value: Column) -> Column:
    return F.when(eid % modulus == 0, F.lit(None)).otherwise(value)


def typed_events(spark: SparkSession, data_dir: str) -> DataFrame:
    """One typed flight observation per event (before text encoding).  The narrow event
    rows are dealt out first: a table of few row groups has as few scan tasks, and they
    should not derive the vectors as well."""
    events = table(spark, data_dir, "events").select(*EVENT_COLUMNS)
    return typed_from(events.repartition("event_id", "ts"), table(spark, data_dir, "nation"))


def typed_from(events: DataFrame, nation: DataFrame) -> DataFrame:
    events = events.select(*EVENT_COLUMNS)
    nation = nation.select("n_nationkey", "n_name")
    # nation is a fixed 25-row dimension; the planner's size check decides on
    # a broadcast (and AQE re-checks at run time).
    e = events.join(nation, events.user_id % 5 == nation.n_nationkey, "left")
    eid, uid = F.col("event_id"), F.col("user_id")
    tpos = (F.lit(EPOCH_BASE) + (F.hour("ts") % 6) * 3600
            + F.floor(F.minute("ts") / 5) * 300).cast("bigint")
    baro = F.col("value") * FEET_PER_VALUE + (eid % 11) * F.lit(JITTER)
    return e.select(
        eid.alias("event_id"),
        _null_if(eid, 101, F.lower(F.hex(F.lit(ICAO_BASE) + uid))).alias("icao24"),
        F.when(eid % 11 == 0, F.lit(None))
         .when(eid % 23 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("FL"), (uid % 40).cast("string"), F.lit("  ")))
         .alias("callsign"),
        _null_if(eid, 13, F.concat(F.lit(" "), F.col("n_name"), F.lit(" "))).alias("origin_country"),
        _null_if(eid, 29, F.when(eid % 211 == 0, F.lit(BAD_EPOCH)).otherwise(tpos)).alias("time_position"),
        _null_if(eid, 29, tpos + eid % 5).alias("last_contact"),
        _null_if(eid, 31, F.lit(-120.0) + (uid % 4) * 60 + (eid % 10) * F.lit(JITTER)).alias("longitude"),
        _null_if(eid, 31, F.lit(-40.0) + (uid % 3) * 40 + (eid % 8) * F.lit(JITTER)).alias("latitude"),
        _null_if(eid, 17, baro).alias("baro_altitude"),
        _null_if(eid, 19, F.col("event_type") == "error").alias("on_ground"),
        ((eid % 300) + (eid % 7) * F.lit(JITTER)).alias("velocity"),
        ((eid * 7) % 360).cast("double").alias("true_track"),
        ((eid % 21) - 10).cast("double").alias("vertical_rate"),
        _null_if(eid, 17, baro + 25).alias("geo_altitude"),
        F.lpad((uid % 7777).cast("string"), 4, "0").alias("squawk"),
        (F.floor(ntz_to_epoch(F.col("ts")) / 60) * 60).cast("bigint").alias("time"),
        _null_if(eid, 7, ntz_to_epoch(F.col("ts"))).alias("fetched_at"),
        F.col("ts").alias("ingested_at"),
    )


def state_vectors(spark: SparkSession, data_dir: str) -> DataFrame:
    """Raw feed rows: ``time``, ``fetched_at``, ``state`` (ARRAY<STRING>, the
    positional vector) and ``ingested_at``.

    The vectors are dealt out evenly before they are read: a table of one file has as
    few scan tasks as row groups, and parsing is compiled apart from the derivation
    (together they make a method that the JVM does not compile)."""
    return vectors_from_typed(typed_events(spark, data_dir)).repartition("state", "ingested_at")


def vectors_from_typed(t: DataFrame) -> DataFrame:
    eid = F.col("event_id")
    s = lambda c: F.col(c).cast("string")
    # Unparsable altitude text on some rows (kept; parsing must not fail).
    baro_text = F.when(eid % 43 == 0, F.lit("n/a")).otherwise(s("baro_altitude"))
    slots = [
        s("icao24"), s("callsign"), s("origin_country"), s("time_position"),
        s("last_contact"), s("longitude"), s("latitude"), baro_text, s("on_ground"),
        s("velocity"), s("true_track"), s("vertical_rate"), F.lit(None).cast("string"),
        s("geo_altitude"), s("squawk"), F.lit(None).cast("string"),
        F.lit("0"),
    ]
    # Some vectors arrive one slot short of the 17 the feed promises.  The
    # array is referenced once so the generated code stays small.
    vec = F.slice(F.array(*slots), 1, F.when(eid % 37 == 0, 16).otherwise(17))
    return t.select("time", "fetched_at", vec.alias("state"), "ingested_at")
