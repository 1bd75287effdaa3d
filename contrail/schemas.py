"""Table schemas, keys and the state-vector slot layout."""

from __future__ import annotations

from pyspark.sql import types as T

# Positions of the fields inside one state vector, as the
# upstream feed defines them (slots 12, 15 and 16 are not read).
SLOTS = {
    "icao24": 0,
    "callsign": 1,
    "origin_country": 2,
    "time_position": 3,
    "last_contact": 4,
    "longitude": 5,
    "latitude": 6,
    "baro_altitude": 7,
    "on_ground": 8,
    "velocity": 9,
    "true_track": 10,
    "vertical_rate": 11,
    "geo_altitude": 13,
    "squawk": 14,
}
MIN_VECTOR_SLOTS = 17

# Typed meaning of each slot.
SLOT_TYPES = {
    "icao24": "string",
    "callsign": "string",
    "origin_country": "string",
    "time_position": "bigint",
    "last_contact": "bigint",
    "longitude": "double",
    "latitude": "double",
    "baro_altitude": "double",
    "on_ground": "boolean",
    "velocity": "double",
    "true_track": "double",
    "vertical_rate": "double",
    "geo_altitude": "double",
    "squawk": "string",
}

# Raw payload as delivered by the feed: one object with a list of vectors.
PAYLOAD = T.StructType([
    T.StructField("time", T.LongType()),
    T.StructField("fetched_at", T.LongType()),
    T.StructField("states", T.ArrayType(T.ArrayType(T.StringType()))),
])

# Landed record (one parsed vector) as written by the record path.
FLIGHT_RECORD = T.StructType([
    T.StructField("icao24", T.StringType()),
    T.StructField("callsign", T.StringType()),
    T.StructField("origin_country", T.StringType()),
    T.StructField("time_position", T.LongType()),
    T.StructField("last_contact", T.LongType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("baro_altitude", T.DoubleType()),
    T.StructField("on_ground", T.BooleanType()),
    T.StructField("velocity", T.DoubleType()),
    T.StructField("true_track", T.DoubleType()),
    T.StructField("vertical_rate", T.DoubleType()),
    T.StructField("geo_altitude", T.DoubleType()),
    T.StructField("squawk", T.StringType()),
    T.StructField("time_fetched", T.LongType()),
])

SILVER = T.StructType([
    T.StructField("icao24", T.StringType()),
    T.StructField("callsign", T.StringType()),
    T.StructField("origin_country", T.StringType()),
    T.StructField("time_position", T.TimestampNTZType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("baro_altitude", T.DoubleType()),
    T.StructField("velocity", T.DoubleType()),
    T.StructField("on_ground", T.BooleanType()),
    T.StructField("ingested_at", T.TimestampNTZType()),
])
SILVER_KEY = ("icao24", "time_position")

GOLD = T.StructType([
    T.StructField("snapshot_hour", T.TimestampNTZType()),
    T.StructField("origin_country", T.StringType()),
    T.StructField("spatial_sector", T.StringType()),
    T.StructField("sector_center_lat", T.DoubleType()),
    T.StructField("sector_center_lon", T.DoubleType()),
    T.StructField("flight_phase", T.StringType()),
    T.StructField("unique_aircraft_count", T.LongType()),
    T.StructField("active_callsigns_count", T.LongType()),
    T.StructField("airborne_aircraft_count", T.LongType()),
    T.StructField("ground_aircraft_count", T.LongType()),
    T.StructField("avg_airborne_altitude_ft", T.DoubleType()),
    T.StructField("max_airborne_altitude_ft", T.DoubleType()),
    T.StructField("min_airborne_altitude_ft", T.DoubleType()),
    T.StructField("avg_ground_speed_knots", T.DoubleType()),
    T.StructField("hourly_sector_density_rank", T.IntegerType()),
])
GOLD_KEY = ("snapshot_hour", "origin_country", "spatial_sector", "flight_phase")
GOLD_COLUMNS = tuple(f.name for f in GOLD.fields)

COUNTRY_HOURLY = T.StructType([
    T.StructField("flight_hour", T.TimestampNTZType()),
    T.StructField("origin_country", T.StringType()),
    T.StructField("total_unique_flights", T.LongType()),
    T.StructField("avg_velocity_ms", T.DoubleType()),
    T.StructField("avg_altitude_meters", T.DoubleType()),
    T.StructField("max_velocity_ms", T.DoubleType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

# Declared length limits of the Silver columns (checked, not enforced).
SILVER_LENGTH_LIMITS = {"icao24": 50, "callsign": 50, "origin_country": 100}
