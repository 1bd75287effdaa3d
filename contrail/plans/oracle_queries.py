"""DuckDB SQL for every registered query (same column names)."""

from __future__ import annotations

from contrail.plans.oracle import FEET, POSITION_TIME, _geohash_sql, phase_sql, q

_LOAD = "batch-00000000000"

_SLOT_NAMES = ("icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude", "latitude", "baro_altitude",
               "on_ground", "velocity", "true_track", "vertical_rate", "slot_12", "geo_altitude", "squawk", "slot_15", "slot_16")
#: (shape, field, kind, values) of the feed's payloads: every slot comes as text.
DRIFT_FEED = [("payload", "time", "number", "count(*)"), ("payload", "fetched_at", "number", "count(fetched_at)"),
              ("payload", "states", "array", "count(*)"),
              *[("vector", c, "null" if c in ("slot_12", "slot_15") else "string",
                 "count_if(NOT short_vector)" if c == "slot_16" else "count(*)") for c in _SLOT_NAMES]]
#: (field, kind, values, status) of the changed records; nulls are not written.
DRIFT_RECORDS = [
    ("icao24", "'string'", "count(icao24)", "same"), ("callsign", "'string'", "count(*)", "same"),
    ("origin_country", "'string'", "count(*)", "same"), ("on_ground", "'boolean'", "count(*)", "same"),
    *[(c, "'number'", f"count({c})", "same") for c in ("time_position", "last_contact", "longitude", "latitude", "baro_altitude")],
    *[(c, "'number'", "count(*)", "same") for c in ("true_track", "vertical_rate", "time_fetched")],
    ("geo_altitude", "'number'", "count_if(event_id % 17 <> 0)", "same"),
    ("velocity", "'array'", "count(*)", "retyped"), ("emergency", "'boolean'", "count(*)", "new"),
    ("squawk", "NULL", "CAST(0 AS BIGINT) * count(*)", "vanished")]


def oracle_sql() -> dict[str, str]:
    return {**core_sql(), **panel_sql()}


def core_sql() -> dict[str, str]:
    return {
        "state_parse": q("""
SELECT icao24,
       CASE WHEN callsign IS NULL OR callsign = '' THEN 'N/A'
            ELSE regexp_replace(callsign, '^\\s+|\\s+$', '', 'g') END AS callsign,
       CASE WHEN origin_country IS NULL OR origin_country = '' THEN 'UNKNOWN'
            ELSE origin_country END AS origin_country,
       time_position, last_contact, longitude, latitude, baro_altitude,
       coalesce(on_ground, false) AS on_ground, velocity, true_track, vertical_rate,
       geo_altitude, squawk,
       coalesce(nullif(fetched_at, 0), time) AS time_fetched
FROM typed WHERE NOT short_vector"""),
        "silver_standardize": q("SELECT * FROM silver_rows"),
        "silver_latest": q("SELECT * FROM silver"),
        "silver_upsert": q("SELECT * FROM silver"),
        "geohash4": q(f"""
SELECT icao24, time_position, longitude, latitude,
       {_geohash_sql('longitude', 'latitude', 4)} AS geohash4
FROM silver_rows"""),
        "geohash7": q(f"""
SELECT icao24, time_position, longitude, latitude,
       {_geohash_sql('longitude', 'latitude', 7)} AS geohash7
FROM silver_rows"""),
        "flight_phase": q(f"""
SELECT icao24, time_position, on_ground, {phase_sql(feet=f'({FEET})')} AS flight_phase FROM silver"""),
        "unit_convert": q("""
SELECT icao24, time_position,
       baro_altitude * CAST(3.28084 AS DOUBLE) AS altitude_ft,
       velocity * CAST(1.94384 AS DOUBLE) AS speed_knots
FROM silver"""),
        "gold_sector_hourly": q("SELECT * FROM gold"),
        "gold_rank": q("""
SELECT snapshot_hour, origin_country, spatial_sector, flight_phase,
       airborne_aircraft_count, hourly_sector_density_rank FROM gold"""),
        "gold_country_hourly": q("""
SELECT date_trunc('hour', time_position) AS flight_hour,
       coalesce(trim(origin_country), 'Unknown') AS origin_country,
       count(DISTINCT icao24) AS total_unique_flights,
       round(avg(velocity), 2) AS avg_velocity_ms,
       round(avg(baro_altitude), 2) AS avg_altitude_meters,
       max(velocity) AS max_velocity_ms,
       max(ingested_at) AS updated_at
FROM silver GROUP BY 1, 2"""),
        "gold_approx_aircraft": q("""
SELECT hour AS snapshot_hour, country AS origin_country, sector AS spatial_sector, phase AS flight_phase,
       count(*) AS reports, true AS within_error
FROM seen GROUP BY 1, 2, 3, 4"""),
        "gold_row_count": q("SELECT count(1) AS total_gold_records FROM gold"),
    }


GOLD_COLS = ("snapshot_hour", "origin_country", "spatial_sector", "sector_center_lat",
             "sector_center_lon", "flight_phase", "unique_aircraft_count",
             "active_callsigns_count", "airborne_aircraft_count", "ground_aircraft_count",
             "avg_airborne_altitude_ft", "max_airborne_altitude_ft",
             "min_airborne_altitude_ft", "avg_ground_speed_knots",
             "hourly_sector_density_rank")
SILVER_COLS = ("icao24", "callsign", "origin_country", "time_position", "longitude",
               "latitude", "baro_altitude", "velocity", "on_ground", "ingested_at")


def _check(layer, name, observed, failed, source):
    return (f"SELECT '{layer}' AS layer, '{name}' AS \"check\", "
            f"CAST(coalesce({observed}, 0) AS BIGINT) AS observed, "
            f"CAST(coalesce({failed}, 0) AS BIGINT) AS failed_rows, "
            f"coalesce({failed}, 0) = 0 AS passed FROM {source}")


def _nulls(layer, cols, required, source):
    parts = []
    for c in cols:
        nulls = f"(count(*) - count({c}))"
        parts.append(_check(layer, f"nulls:{c}", nulls, nulls if c in required else "0", source))
    return "\nUNION ALL ".join(parts)


def _dups(layer, key, source):
    k = ", ".join(key)
    sub = f"(SELECT {k}, count(*) AS n FROM {source} GROUP BY {k}) t"
    return _check(layer, "duplicate_keys:" + ",".join(key),
                  "count(CASE WHEN n > 1 THEN 1 END)",
                  "sum(CASE WHEN n > 1 THEN n - 1 ELSE 0 END)", sub)


def _rowcount(layer, source):
    return _check(layer, "row_count>0", "count(*)", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END",
                  source)


DRIFT = {  # slot -> (rows with text present, rows whose text does not parse)
    "time_position": ("count(time_position)", "0"),
    "last_contact": ("count(last_contact)", "0"),
    "longitude": ("count(longitude)", "0"),
    "latitude": ("count(latitude)", "0"),
    "baro_altitude": ("count(CASE WHEN bad_altitude OR baro_altitude IS NOT NULL THEN 1 END)",
                      "count(CASE WHEN bad_altitude THEN 1 END)"),
    "on_ground": ("count(on_ground)", "0"),
    "velocity": ("count(velocity)", "0"),
    "true_track": ("count(true_track)", "0"),
    "vertical_rate": ("count(vertical_rate)", "0"),
    "geo_altitude": ("count(geo_altitude)", "0"),
}

HIST_CTES = (
    """hx AS (SELECT origin_country, avg_ground_speed_knots AS x FROM fg
              WHERE avg_ground_speed_knots IS NOT NULL)""",
    """hs AS (SELECT count(x) AS n, min(x) AS lo, max(x) AS hi,
                     quantile_cont(x, 0.75) AS q75, quantile_cont(x, 0.25) AS q25 FROM hx)""",
    """hw AS (SELECT lo, hi, (hi - lo) / (log2(n) + 1.0) AS sturges,
                     2.0 * (q75 - q25) * pow(n, -1.0 / 3.0) AS fd FROM hs)""",
    """hp AS (SELECT fe, le,
                     CAST(CASE WHEN width > 0 THEN ceil((le - fe) / width) ELSE 1 END AS BIGINT) AS nb
              FROM (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS fe,
                           CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS le,
                           CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END AS width
                    FROM hw) t)""",
    """edges AS (SELECT i AS bin, i = nb - 1 AS last, i * ((le - fe) / nb) + fe AS a,
                        CASE WHEN i + 1 >= nb THEN le ELSE (i + 1) * ((le - fe) / nb) + fe END AS b
                 FROM (SELECT unnest(range(0, nb)) AS i, fe, le, nb FROM hp) t)""",
    """hc AS (SELECT origin_country, bin, a, b, count(*) AS cnt
              FROM hx JOIN edges ON x >= a AND (x < b OR last) GROUP BY ALL)""",
    """he AS (SELECT origin_country, bin, cnt, a AS bin_left, b AS bin_right,
                     sum(cnt) OVER (PARTITION BY origin_country) AS total
              FROM hc)""",
)

KDE_CTES = (
    """kx AS (SELECT origin_country, avg_ground_speed_knots AS x FROM fg
              WHERE avg_ground_speed_knots IS NOT NULL)""",
    """ks AS (SELECT min(x) AS lo, max(x) AS hi FROM kx)""",
    """kp AS (SELECT origin_country, count(x) AS n, stddev_samp(x) * pow(count(x), -0.2) AS h
              FROM kx GROUP BY 1 HAVING count(x) >= 2 AND stddev_samp(x) > 0)""",
    """kg AS (SELECT CAST(i AS INTEGER) AS grid_index,
                     CASE WHEN i = 199 THEN hi ELSE i * ((hi - lo) / 199.0) + lo END AS grid_value
              FROM ks, range(200) t(i))""",
)

BOX_CTES = (
    """bx AS (SELECT flight_phase, avg_airborne_altitude_ft AS x FROM gold
              WHERE avg_airborne_altitude_ft IS NOT NULL)""",
    """bq AS (SELECT flight_phase, count(x) AS n, avg(x) AS mean,
                     quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
                     quantile_cont(x, 0.75) AS q3 FROM bx GROUP BY 1)""",
    """bf AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence,
                     q3 + 1.5 * (q3 - q1) AS hi_fence FROM bq)""",
    """be AS (SELECT bx.flight_phase,
                     min(CASE WHEN x >= lo_fence THEN x END) AS lo_reach,
                     max(CASE WHEN x <= hi_fence THEN x END) AS hi_reach,
                     count(CASE WHEN x < lo_fence OR x > hi_fence THEN x END) AS n_fliers
              FROM bx JOIN bf USING (flight_phase) GROUP BY 1)""",
)


def panel_sql() -> dict[str, str]:
    gold_cols = ", ".join(GOLD_COLS)
    return {
        "top_gold_5000": q("""
SELECT * FROM gold
ORDER BY snapshot_hour DESC NULLS LAST, hourly_sector_density_rank ASC NULLS LAST,
         origin_country ASC NULLS LAST, spatial_sector ASC NULLS LAST,
         flight_phase ASC NULLS LAST
LIMIT 5000"""),
        "top_silver_5000": q("""
SELECT * FROM silver ORDER BY time_position DESC NULLS FIRST, icao24 ASC NULLS LAST LIMIT 5000"""),
        "kpi_cards": q("""
SELECT CAST(coalesce(sum(su), 0) AS BIGINT) AS total_tracked_aircraft,
       CAST(coalesce(sum(sa), 0) AS BIGINT) AS airborne_aircraft_volume,
       coalesce((SELECT origin_country FROM pc ORDER BY n DESC, origin_country LIMIT 1), 'N/A')
         AS busiest_country,
       CASE WHEN coalesce(sum(n), 0) = 0 THEN 0.0 ELSE round(sum(ss) / sum(cs), 4) END
         AS avg_ground_speed_knots,
       round(sum(ws) / sum(wn), 4) AS aircraft_weighted_speed_knots,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS gold_rows
FROM pc""", """pc AS (
  SELECT origin_country, count(*) AS n, sum(unique_aircraft_count) AS su,
         sum(airborne_aircraft_count) AS sa, sum(avg_ground_speed_knots) AS ss,
         count(avg_ground_speed_knots) AS cs,
         sum(avg_ground_speed_knots * unique_aircraft_count) AS ws,
         sum(CASE WHEN avg_ground_speed_knots IS NOT NULL THEN unique_aircraft_count END) AS wn
  FROM gold GROUP BY 1)"""),
        "country_top10": q("""
SELECT origin_country, CAST(sum(unique_aircraft_count) AS BIGINT) AS unique_aircraft_count
FROM gold GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
        "hourly_trend": q("""
SELECT snapshot_hour, CAST(sum(airborne_aircraft_count) AS BIGINT) AS airborne_aircraft_count,
       CAST(sum(ground_aircraft_count) AS BIGINT) AS ground_aircraft_count
FROM gold GROUP BY 1"""),
        "country_frequency": q("SELECT origin_country, count(*) AS count FROM clean GROUP BY 1"),
        "country_top5": q("""
SELECT origin_country, count(*) AS count FROM clean GROUP BY 1
ORDER BY count(*) DESC, origin_country LIMIT 5"""),
        "country_top5_sectors": q(f"SELECT {gold_cols} FROM fg"),
        "speed_histogram": q("""
SELECT origin_country, bin, bin_left, bin_right, cnt AS count,
       round(cnt / total / (bin_right - bin_left), 10) AS density
FROM he""", *HIST_CTES),
        "speed_kde": q("""
SELECT kx.origin_country, grid_index, grid_value,
       round(sum(exp(-0.5 * pow((grid_value - x) / h, 2))) / (n * h * sqrt(2 * pi())), 10)
         AS density
FROM kx JOIN kp USING (origin_country) CROSS JOIN kg
GROUP BY kx.origin_country, grid_index, grid_value, n, h""", *KDE_CTES),
        "phase_box_stats": q("""
SELECT bf.flight_phase, n, round(mean, 6) AS mean, round(q1, 6) AS q1,
       round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
       round(CASE WHEN lo_reach IS NULL OR lo_reach > q1 THEN q1 ELSE lo_reach END, 6) AS whislo,
       round(CASE WHEN hi_reach IS NULL OR hi_reach < q3 THEN q3 ELSE hi_reach END, 6) AS whishi,
       n_fliers
FROM bf JOIN be USING (flight_phase)""", *BOX_CTES),
        "phase_outliers": q(f"""
SELECT {gold_cols} FROM gold g JOIN bf USING (flight_phase)
WHERE g.avg_airborne_altitude_ft < lo_fence OR g.avg_airborne_altitude_ft > hi_fence""",
                            *BOX_CTES),
        "null_profile": q("\nUNION ALL ".join(
            f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count FROM gold"
            for c in GOLD_COLS)),
        "null_mask": q("SELECT " + ", ".join(f"{c} IS NULL AS {c}" for c in GOLD_COLS)
                       + " FROM gold"),
        "dq_nulls": q(_nulls("silver", SILVER_COLS, ("icao24", "time_position"), "silver")
                      + "\nUNION ALL " +
                      _nulls("gold", GOLD_COLS, ("snapshot_hour", "origin_country", "flight_phase"),
                             "gold")),
        "dq_duplicates": q("\nUNION ALL ".join([
            _dups("silver_input", ("icao24", "time_position"), "silver_rows"),
            _dups("silver", ("icao24", "time_position"), "silver"),
            _dups("gold", ("snapshot_hour", "origin_country", "spatial_sector", "flight_phase"),
                  "gold")])),
        "dq_lengths": q("\nUNION ALL ".join(
            _check("silver", f"max_length:{c}<={n}", f"max(length({c}))",
                   f"count(CASE WHEN length({c}) > {n} THEN 1 END)", "silver")
            for c, n in (("icao24", 50), ("callsign", 50), ("origin_country", 100)))),
        "dq_rowcounts": q("\nUNION ALL ".join([
            _rowcount("payload_states", "typed"),
            _rowcount("parsed_records", "typed WHERE NOT short_vector"),
            _rowcount("gold", "gold")])),
        "dq_quarantine": q("""
SELECT icao24, CAST(time_position AS VARCHAR) AS time_position_raw, ingested_at,
       CASE WHEN short_vector THEN 16 ELSE 17 END AS slots, 'short_vector' AS reason
FROM typed WHERE short_vector
UNION ALL
SELECT icao24, CAST(time_position AS VARCHAR) AS time_position_raw, ingested_at,
       CASE WHEN short_vector THEN 16 ELSE 17 END AS slots,
       'unparsable:baro_altitude' AS reason
FROM typed WHERE bad_altitude
UNION ALL
SELECT icao24, CAST(time_position AS VARCHAR) AS time_position_raw, ingested_at,
       CASE WHEN short_vector THEN 16 ELSE 17 END AS slots,
       'out_of_range:time_position' AS reason
FROM typed WHERE time_position NOT BETWEEN 0 AND 4102444799"""),
        "dq_type_drift": q("\nUNION ALL ".join(
            [_check("bronze", f"parsable:{k}", o, f, "typed") for k, (o, f) in DRIFT.items()]
            + [_check("bronze", "in_range:time_position", "count(time_position)",
                      "count_if(time_position NOT BETWEEN 0 AND 4102444799)", "typed")])),
        "dq_freshness": q(_check(
            "gold", "freshness:snapshot_hour<=7200s",
            "((SELECT epoch_us(max(ingested_at)) // 1000000 FROM silver)"
            " - epoch_us(max(snapshot_hour)) // 1000000)",
            "CASE WHEN ((SELECT epoch_us(max(ingested_at)) // 1000000 FROM silver)"
            " - epoch_us(max(snapshot_hour)) // 1000000) > 7200 THEN 1 ELSE 0 END",
            "gold")),
        "silver_flagged": q("""
SELECT * EXCLUDE (short_vector),
       icao24 IS NULL AS missing_icao24, time_position IS NULL AS missing_time_position,
       (longitude IS NULL OR latitude IS NULL) AS missing_position,
       baro_altitude IS NULL AS missing_altitude, on_ground IS NULL AS missing_on_ground,
       callsign IS NULL AS missing_callsign, origin_country IS NULL AS missing_country
FROM silver_all"""),
        "json_roundtrip": q("SELECT * FROM silver_rows"),
        "stream_dedup_keys": q("SELECT DISTINCT icao24, time_position FROM silver_rows"),
        "stream_silver": q("SELECT * FROM silver"),
        "stream_gold": q("SELECT * FROM gold"),
        "stream_hourly_traffic": q("""
SELECT date_trunc('hour', time_position) AS flight_hour, coalesce(origin_country, 'Unknown') AS origin_country,
       count(*) AS reports, true AS within_error
FROM silver_rows GROUP BY 1, 2"""),
        "stream_json_keys": q("SELECT DISTINCT icao24, time_position FROM silver_rows"),
        "bronze_variant_silver": q("""
SELECT * EXCLUDE (ingested_at, short_vector, copy)
FROM silver_all, (SELECT unnest([1, 2]) AS copy) c
WHERE NOT short_vector AND icao24 IS NOT NULL AND time_position IS NOT NULL"""),
        "bronze_partitions": q("""
SELECT year(t)::INT AS year, month(t)::INT AS month, day(t)::INT AS day, hour(t)::INT AS hour, count(*) AS payloads
FROM (SELECT make_timestamp(coalesce(fetched_at, time) * 1000000) AS t FROM typed) f GROUP BY ALL"""),
        "bronze_bad_files": q("""
SELECT (SELECT count(*) FROM typed) AS good_values, CAST(1 AS BIGINT) AS bad_files, CAST(2 AS BIGINT) AS bad_values"""),
        "records_silver": q(f"""
SELECT icao24, nullif(trim(callsign), '') AS callsign, upper(trim(origin_country)) AS origin_country,
       {POSITION_TIME} AS time_position, longitude, latitude, baro_altitude, velocity,
       coalesce(on_ground, false) AS on_ground
FROM typed WHERE NOT short_vector AND icao24 IS NOT NULL AND {POSITION_TIME} IS NOT NULL"""),
        "silver_append": q("""
SELECT DISTINCT ON (icao24, time_position, ingested_at >= TIMESTAMP '2024-01-15') * FROM silver_rows
ORDER BY icao24, time_position, ingested_at >= TIMESTAMP '2024-01-15', ingested_at DESC NULLS FIRST, callsign NULLS LAST,
         origin_country NULLS LAST, longitude NULLS LAST, latitude NULLS LAST,
         baro_altitude NULLS LAST, velocity NULLS LAST, on_ground NULLS LAST"""),
        "silver_bucketed": q("SELECT * FROM silver"),
        "gold_published": q("SELECT * FROM gold"),
        "gold_incremental": q("SELECT * FROM gold"),
        "gold_sketch_days": q("""
SELECT strftime(hour, '%Y-%m-%d') AS day, country AS origin_country, count(DISTINCT icao24) AS aircraft, true AS within_error
FROM seen GROUP BY 1, 2"""),
        "stream_late_rows": q("""
SELECT * FROM (
  SELECT icao24, callsign, origin_country, longitude, latitude, baro_altitude, velocity, on_ground, ingested_at,
         CASE WHEN ingested_at >= TIMESTAMP '2024-01-10' THEN time_position + INTERVAL 1 DAY ELSE time_position END AS time_position,
         false AS late
  FROM silver_rows WHERE ingested_at < TIMESTAMP '2024-01-20')
QUALIFY row_number() OVER (PARTITION BY icao24, time_position
  ORDER BY ingested_at DESC, callsign NULLS LAST, origin_country NULLS LAST, longitude NULLS LAST, latitude NULLS LAST,
           baro_altitude NULLS LAST, velocity NULLS LAST, on_ground NULLS LAST) = 1
UNION ALL BY NAME SELECT *, true AS late FROM silver_rows WHERE ingested_at >= TIMESTAMP '2024-01-20'"""),
        "bronze_loads": q(f"""
SELECT 'feed' AS landing, '{_LOAD}0' AS load, count(*) AS good_values, CAST(0 AS BIGINT) AS skipped_values,
       CAST(0 AS BIGINT) AS skipped_files FROM typed WHERE ingested_at < TIMESTAMP '2024-01-15'
UNION ALL SELECT 'feed', '{_LOAD}1', count(*), 0, 0 FROM typed WHERE ingested_at >= TIMESTAMP '2024-01-15'
UNION ALL VALUES ('files', '{_LOAD}0', 0, 3, 1), ('files', '{_LOAD}1', 3, 0, 0), ('files', '{_LOAD}2', 1, 0, 0)"""),
        "bronze_days": q("""
SELECT count(*) AS payloads FROM typed
WHERE make_timestamp(coalesce(fetched_at, time) * 1000000) BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-11 23:59:59'"""),
        "bronze_outer_array": q("""
SELECT * EXCLUDE (short_vector, load) REPLACE (TIMESTAMP '2024-02-01 06:00:00' AS ingested_at)
FROM silver_all, (SELECT unnest([1, 2]) AS load) l WHERE icao24 IS NOT NULL AND time_position IS NOT NULL"""),
        "bronze_dict_wrapper": q(f"""
SELECT icao24, nullif(trim(callsign), '') AS callsign, upper(trim(origin_country)) AS origin_country,
       {POSITION_TIME} AS time_position, longitude, latitude, baro_altitude, velocity,
       coalesce(on_ground, false) AS on_ground
FROM typed, (SELECT unnest([1, 2]) AS copy) c
WHERE NOT short_vector AND icao24 IS NOT NULL AND {POSITION_TIME} IS NOT NULL"""),
        "dq_conservation": q(f"""
, unit AS (SELECT icao24, time_position, {POSITION_TIME} AS placed FROM typed WHERE NOT short_vector)
SELECT 'landed' AS outcome, CAST((SELECT 2 * count(*) FROM unit) + (SELECT count(*) FROM typed WHERE short_vector) + 8 AS BIGINT) AS n
UNION ALL SELECT 'empty_payload', count(*) FROM typed WHERE short_vector
UNION ALL SELECT 'null_icao24', 2 * count(*) + 1 FROM unit WHERE icao24 IS NULL
UNION ALL SELECT 'null_time_position', 2 * count(*) FROM unit WHERE icao24 IS NOT NULL AND time_position IS NULL
UNION ALL SELECT 'invalid_time_position', 2 * count(*) FROM unit WHERE icao24 IS NOT NULL AND time_position IS NOT NULL AND placed IS NULL
UNION ALL SELECT 'silver', count(DISTINCT (icao24, placed)) FROM unit WHERE icao24 IS NOT NULL AND placed IS NOT NULL
UNION ALL SELECT 'superseded', 2 * count(*) - count(DISTINCT (icao24, placed)) FROM unit WHERE icao24 IS NOT NULL AND placed IS NOT NULL
UNION ALL VALUES ('unparsable', 2), ('file_skipped', 1), ('not_a_record', 3), ('empty_array', 1)"""),
        "variant_drift": q("\nUNION ALL ".join(
            [f"SELECT '{_LOAD}0' AS load, '{shape}' AS shape, '{name}' AS field, '{found}' AS found, {n} AS n, 'same' AS status FROM typed"
             for shape, name, found, n in DRIFT_FEED]
            + [f"SELECT '{_LOAD}1', 'record', '{name}', {found}, {n}, '{status}' FROM typed WHERE NOT short_vector"
               for name, found, n, status in DRIFT_RECORDS])),
    }
