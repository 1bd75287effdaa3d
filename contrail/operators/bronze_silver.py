"""VARIANT Bronze rows of both landed shapes (payloads with positional
vectors, flat records) to Silver rows, in one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.timefn import epoch_to_ntz
from contrail.operators.parse import NO_CALLSIGN, NO_COUNTRY
from contrail.schemas import SLOT_TYPES, SLOTS


def observations(bronze: DataFrame, *keep: str) -> DataFrame:
    """vector?, s and the kept columns (the ingest time): one row for each state
    vector of a payload (an object with a list ``states``) and for each record."""
    keep = keep or ("ingested_at",)
    states = F.try_variant_get("raw_data", "$.states", "array<variant>")
    item = lambda is_vector, v: F.struct(F.lit(is_vector).alias("vector"), v.alias("s"))
    items = F.when(states.isNotNull(), F.transform(states, lambda v: item(True, v))) \
             .otherwise(F.array(item(False, F.col("raw_data"))))
    return bronze.select(*keep, F.explode(items).alias("o")).select(*keep, "o.vector", "o.s")


def field(name: str, kind: str | None = None) -> Column:
    """Typed value by slot or by name; a JSON null or another type is null."""
    kind = kind or SLOT_TYPES[name]
    get = lambda path, kind: F.try_variant_get("s", path, kind)
    if kind == "bigint":        # rounded from the numeric value, not truncated
        number = F.when(F.col("vector"), get(f"$[{SLOTS[name]}]", "double")).otherwise(get(f"$.{name}", "double"))
        return F.round(number).try_cast("bigint")
    return F.when(F.col("vector"), get(f"$[{SLOTS[name]}]", kind)).otherwise(get(f"$.{name}", kind))


def bronze_silver_rows(bronze: DataFrame, drop_null_keys: bool = True) -> DataFrame:
    """Silver rows (not deduplicated).  The placeholder labels of the record
    shape go back to null so both shapes agree.  Every field is read from its object
    once: ``inline`` puts the values out, and the rules and the filter read them there."""
    names = ("icao24", "callsign", "origin_country", "time_position", "longitude", "latitude", "baro_altitude", "velocity", "on_ground")
    values = F.struct("vector", *[field(c).alias(c) for c in names])
    call, country = F.trim("callsign"), F.upper(F.trim("origin_country"))
    unlabelled = lambda c, label: F.when(F.col("vector") | (c != label), c)
    rows = observations(bronze).select("ingested_at", F.inline(F.array(values))).select(
        "icao24",
        unlabelled(call, NO_CALLSIGN).alias("callsign"),
        unlabelled(country, NO_COUNTRY).alias("origin_country"),
        epoch_to_ntz(F.col("time_position")).alias("time_position"),
        "longitude", "latitude", "baro_altitude", "velocity", "on_ground",
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"))
    return rows.where("icao24 IS NOT NULL AND time_position IS NOT NULL") if drop_null_keys else rows


def bronze_vectors(bronze: DataFrame) -> DataFrame:
    """Payload vectors in text form (time, fetched_at, state, ingested_at), as
    the record path and the vector checks read them."""
    number = lambda name: F.try_variant_get("raw_data", f"$.{name}", "bigint").alias(name)
    states = F.try_variant_get("raw_data", "$.states", "array<variant>")
    rows = bronze.select(number("time"), number("fetched_at"), "ingested_at", F.explode(states).alias("s"))
    texts = F.transform(F.try_variant_get("s", "$", "array<variant>"),
                        lambda v: F.try_variant_get(v, "$", "string"))
    return rows.select("time", "fetched_at", texts.alias("state"), "ingested_at")
