"""Gold: hour x country x geohash sector x flight phase aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.flight import feet, flight_phase, knots
from contrail.functions.geo import geohash
from contrail.functions.timefn import hour_floor
from contrail.operators.rank import dense_rank_within
from contrail.schemas import GOLD_COLUMNS, GOLD_KEY

# Labels for a missing country / callsign, and the sector size.
UNKNOWN_COUNTRY = "Unknown"
UNASSIGNED_CALLSIGN = "UNASSIGNED"
SECTOR_PRECISION = 4
#: 2^12 registers: a relative standard deviation of 1.04 / 64, about 1.6 %.
SKETCH_LG_K, SKETCH_RSD = 12, 1.04 / 64


def base_vectors(silver: DataFrame, precision: int = SECTOR_PRECISION) -> DataFrame:
    """Per-row projection feeding the aggregate."""
    alt_ft = feet(F.col("baro_altitude"))
    return silver.filter(F.col("icao24").isNotNull() & F.col("time_position").isNotNull()).select(
        hour_floor(F.col("time_position")).alias("snapshot_hour"),
        F.coalesce(F.trim("origin_country"), F.lit(UNKNOWN_COUNTRY)).alias("origin_country"),
        F.coalesce(F.trim("callsign"), F.lit(UNASSIGNED_CALLSIGN)).alias("callsign"),
        "icao24", "latitude", "longitude",
        geohash("longitude", "latitude", precision).alias("spatial_sector"),
        alt_ft.alias("altitude_ft"),
        knots(F.col("velocity")).alias("speed_knots"),
        "on_ground",
        flight_phase(F.col("on_ground"), alt_ft).alias("flight_phase"),
    )


def _values():
    airborne = ~F.col("on_ground")
    return {"lat": F.col("latitude"), "lon": F.col("longitude"), "speed": F.col("speed_knots"),
            "alt": F.when(airborne, F.col("altitude_ft"))}, airborne


def partials(base: DataFrame, *more: str) -> DataFrame:
    """Partial aggregates per (group, aircraft, ``more``): sums and counts for the
    means, extremes, and whether the aircraft was seen airborne or on the ground.
    Partials of finer keys can be folded into those of coarser ones (``fold``)."""
    values, airborne = _values()
    parts = [a for k, v in values.items() for a in (F.sum(v).alias(f"{k}_sum"), F.count(v).alias(f"{k}_n"))]
    return base.groupBy(*GOLD_KEY, "icao24", *more).agg(
        *parts, F.max(airborne).alias("flew"), F.max("on_ground").alias("stood"),
        F.max(values["alt"]).alias("alt_max"), F.min(values["alt"]).alias("alt_min"))


def fold(state: DataFrame) -> DataFrame:
    """Partials per (group, aircraft) from finer ones."""
    sums = [f"{k}_{part}" for k in _values()[0] for part in ("sum", "n")]
    return state.groupBy(*GOLD_KEY, "icao24").agg(
        *[F.sum(c).alias(c) for c in sums], F.max("flew").alias("flew"), F.max("stood").alias("stood"),
        F.max("alt_max").alias("alt_max"), F.min("alt_min").alias("alt_min"))


def groups_of(aircraft: DataFrame, calls: DataFrame) -> DataFrame:
    """Sector aggregates from partials per (group, aircraft) and rows with the
    groups' callsigns (repeated or not)."""
    def mean(name, digits):
        total, n = F.sum(f"{name}_sum"), F.sum(f"{name}_n")
        return F.round(F.when(n > 0, total / n), digits)

    groups = aircraft.groupBy(*GOLD_KEY).agg(
        mean("lat", 4).alias("sector_center_lat"),
        mean("lon", 4).alias("sector_center_lon"),
        F.count("icao24").alias("unique_aircraft_count"),
        F.count_if("flew").alias("airborne_aircraft_count"),
        F.count_if("stood").alias("ground_aircraft_count"),
        mean("alt", 2).alias("avg_airborne_altitude_ft"),
        F.round(F.max("alt_max"), 2).alias("max_airborne_altitude_ft"),
        F.round(F.min("alt_min"), 2).alias("min_airborne_altitude_ft"),
        mean("speed", 2).alias("avg_ground_speed_knots"))
    names = [f"_{k}" for k in GOLD_KEY]
    callsigns = (calls.select(*GOLD_KEY, "callsign").distinct().groupBy(*GOLD_KEY)
                 .agg(F.count("callsign").alias("active_callsigns_count"))
                 .withColumnsRenamed(dict(zip(GOLD_KEY, names))))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(GOLD_KEY, names)]
    return groups.join(callsigns, same).drop(*names)


def sector_aggregates(base: DataFrame) -> DataFrame:
    """One row per (hour, country, sector, phase).  A null sector is a group
    of its own.

    Distinct counts without expanding the rows: the rows are first aggregated
    per (group, aircraft), carrying sums and counts for the means and whether
    the aircraft was seen airborne or on the ground, and then per group; the
    callsigns are counted the same way.  Both first steps combine map-side and
    spread a hot group over the shuffle by aircraft or callsign."""
    return groups_of(partials(base), base)


def rank_sectors(agg: DataFrame, materialized: bool = False) -> DataFrame:
    """Dense rank of each group within its hour by airborne aircraft, most
    first (ties share a rank).

    On a lazy aggregate the rank is a window over the hour: it re-shuffles
    only the (small) aggregate, and the rows of one hour are bounded by the
    country x sector x phase domain, not by the input volume.  On a
    materialized aggregate (a written table) the distinct-level join is used
    instead: no re-shuffle of Gold at all, and no task sees a whole hour.
    """
    name = "hourly_sector_density_rank"
    if materialized:
        ranked = dense_rank_within(agg, ["snapshot_hour"], "airborne_aircraft_count",
                                   name, descending=True)
    else:
        w = Window.partitionBy("snapshot_hour").orderBy(
            F.col("airborne_aircraft_count").desc_nulls_last())
        ranked = agg.withColumn(name, F.dense_rank().over(w))
    return ranked.withColumn(name, F.col(name).cast("int"))


def gold(silver: DataFrame, precision: int = SECTOR_PRECISION) -> DataFrame:
    return rank_sectors(sector_aggregates(base_vectors(silver, precision))).select(*GOLD_COLUMNS)


def country_hourly(silver: DataFrame) -> DataFrame:
    """Hourly per-country summary: distinct aircraft, mean and peak speed
    (m/s), mean barometric altitude (m); ``updated_at`` is the newest ingest
    time that fed the row."""
    rows = silver.filter(F.col("icao24").isNotNull() & F.col("time_position").isNotNull())
    return rows.groupBy(
        hour_floor(F.col("time_position")).alias("flight_hour"),
        F.coalesce(F.trim("origin_country"), F.lit(UNKNOWN_COUNTRY)).alias("origin_country"),
    ).agg(
        F.count_distinct("icao24").alias("total_unique_flights"),
        F.round(F.avg("velocity"), 2).alias("avg_velocity_ms"),
        F.round(F.avg("baro_altitude"), 2).alias("avg_altitude_meters"),
        F.max("velocity").alias("max_velocity_ms"),
        F.max("ingested_at").alias("updated_at"),
    )


def approx_sector_aircraft(silver: DataFrame, rsd: float = 0.05) -> DataFrame:
    """Distinct aircraft per Gold group with a HyperLogLog++ sketch: fixed
    memory per group however many reports an hour holds."""
    return base_vectors(silver).groupBy(*GOLD_KEY).agg(
        F.approx_count_distinct("icao24", rsd).alias("approx_aircraft_count"),
        F.count(F.lit(1)).alias("reports"))


def within_sketch_error(estimate: Column, exact: Column, rsd: float = 0.05) -> Column:
    """Is an estimate within three relative standard deviations (and one)?"""
    return F.abs(estimate - exact) <= F.greatest(3 * rsd * exact, F.lit(1.0))


def aircraft_sketches(rows: DataFrame, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """A mergeable distinct-aircraft sketch per Gold group (at most 2^lg_k bytes)
    from base vectors or from stored partials: repeats of an aircraft change nothing."""
    return rows.groupBy(*GOLD_KEY).agg(F.hll_sketch_agg("icao24", lg_k).alias("aircraft_sketch"))


def roll_up(sketches: DataFrame, *key) -> DataFrame:
    """Estimated distinct aircraft of any coarser key, from stored sketches alone
    (distinct counts of the groups themselves cannot be added: an aircraft is in
    many groups)."""
    return sketches.groupBy(*key).agg(
        F.hll_sketch_estimate(F.hll_union_agg("aircraft_sketch")).alias("approx_aircraft"))


def gold_row_count(gold_df: DataFrame) -> DataFrame:
    return gold_df.agg(F.count(F.lit(1)).alias("total_gold_records"))
