"""Registered queries: each takes ``(spark, data_dir)`` and returns a
DataFrame derived from the driver tables, over all of their rows.

Queries over Gold first write the sector aggregate (and, where a layer is
read by several branches, that layer) to the shared folder; the returned
DataFrame is lazy over those written tables.  Streaming queries run their
stream to completion (``availableNow``) and return its output table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.flight import feet, flight_phase, knots
from contrail.functions.geo import geohash
from contrail.functions.timefn import hour_floor
from contrail.operators import accounting as A
from contrail.operators import distributions as D
from contrail.operators import gold as G
from contrail.operators import insights as I
from contrail.operators import parse as P
from contrail.operators import quality as Q
from contrail.operators import silver as S
from contrail.operators.bronze_silver import bronze_silver_rows
from contrail.plans import catalog_tables, tables
from contrail.plans.medallion import build_gold, refresh_gold_days, upsert_layers
from contrail.plans.tables import materialize
from contrail.schemas import GOLD_COLUMNS, GOLD_KEY, MIN_VECTOR_SLOTS, SILVER, SILVER_KEY, SILVER_LENGTH_LIMITS
from contrail.sources import bronze as B
from contrail.sources.feed import state_vectors, typed_events, typed_from, vectors_from_typed
from contrail.sources.tables import stream_table, table
from contrail.streaming import incremental as STR
from contrail.streaming import late as LATE

Query = Callable[[SparkSession, str], DataFrame]


# --- layers (shared building blocks) ---------------------------------------

def vectors(spark, d):
    return state_vectors(spark, d)


def silver_rows(spark, d):
    # parsed where they are derived: the narrow events are dealt out, the wide vectors are not
    return P.flatten_states(vectors_from_typed(typed_events(spark, d)))


def silver(spark, d):
    return S.latest(silver_rows(spark, d))


def gold_from(spark, silver_df):
    """Gold as the batch run builds it: the sector aggregate is written once,
    then ranked through its distinct (hour, airborne count) levels with a
    measured broadcast join -- no task holds an hour, nothing is
    recomputed by the rank, and every later branch reads the written
    aggregate."""
    agg = materialize(spark, G.sector_aggregates(G.base_vectors(silver_df)), "gold_aggregates")
    return G.rank_sectors(agg, materialized=True).select(*GOLD_COLUMNS)


def gold(spark, d):
    return gold_from(spark, silver(spark, d))


# Queries that read a layer in more than one branch read it from a table
# written once (as a deployment reads its Gold / Silver tables) instead of
# recomputing the pipeline per branch.

def silver_table(spark, d):
    return materialize(spark, silver(spark, d), "silver")


def gold_table(spark, d, silver_df=None):
    """Gold over the written aggregate (see ``gold_from``)."""
    return gold_from(spark, silver_df if silver_df is not None else silver(spark, d))


# --- parsing / Silver -------------------------------------------------------

def q_state_parse(spark, d):
    return P.parse_records(vectors(spark, d))


def q_silver_standardize(spark, d):
    return silver_rows(spark, d)


def q_silver_latest(spark, d):
    return silver(spark, d)


def q_silver_upsert(spark, d):
    """Two ingest batches (before / from the 15th): the second is upserted
    into the Silver version built from the first."""
    rows = silver_rows(spark, d)
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    first = S.latest(rows.filter(F.col("ingested_at") < cut))
    return S.upsert(first, rows.filter(F.col("ingested_at") >= cut))


# --- scalar functions -------------------------------------------------------

def _geo(precision):
    def run(spark, d):
        return silver_rows(spark, d).select(
            "icao24", "time_position", "longitude", "latitude",
            geohash("longitude", "latitude", precision).alias(f"geohash{precision}"))
    return run


def q_flight_phase(spark, d):
    s = silver(spark, d)
    return s.select("icao24", "time_position", "on_ground",
                    flight_phase(F.col("on_ground"), feet(F.col("baro_altitude"))).alias("flight_phase"))


def q_unit_convert(spark, d):
    s = silver(spark, d)
    return s.select("icao24", "time_position",
                    feet(F.col("baro_altitude")).alias("altitude_ft"),
                    knots(F.col("velocity")).alias("speed_knots"))


# --- Gold -------------------------------------------------------------------

def q_gold_sector_hourly(spark, d):
    return gold(spark, d)


def q_gold_rank(spark, d):
    return gold(spark, d).select("snapshot_hour", "origin_country", "spatial_sector",
                                 "flight_phase", "airborne_aircraft_count",
                                 "hourly_sector_density_rank")


def q_gold_country_hourly(spark, d):
    return G.country_hourly(silver(spark, d))


def q_gold_approx_aircraft(spark, d):
    """The sketch against the exact count: reports, and whether the estimate
    is within three relative standard deviations."""
    s = silver(spark, d)
    names = {k: f"_{k}" for k in GOLD_KEY}
    exact = G.sector_aggregates(G.base_vectors(s)).select(*GOLD_KEY, "unique_aircraft_count").withColumnsRenamed(names)
    both = G.approx_sector_aircraft(s).join(exact, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return both.select(*GOLD_KEY, "reports", G.within_sketch_error(
        F.col("approx_aircraft_count"), F.col("unique_aircraft_count")).alias("within_error"))


def q_gold_row_count(spark, d):
    return G.gold_row_count(gold(spark, d))


# --- dashboard panels ----------------------------------------------------------



def q_top_gold_5000(spark, d):
    return I.top_gold(gold(spark, d), I.GOLD_PAGE)


def q_top_silver_5000(spark, d):
    return I.top_silver(silver(spark, d), I.SILVER_PAGE)


def q_kpi_cards(spark, d):
    return I.kpi_cards(gold(spark, d))


def q_country_top10(spark, d):
    return I.country_volume(gold(spark, d), I.TOP_COUNTRIES)


def q_hourly_trend(spark, d):
    return I.hourly_traffic(gold(spark, d))


def q_country_top5(spark, d):
    return I.top_countries(I.geo_rows(gold(spark, d)), I.TOP_SCATTER_COUNTRIES)


def q_country_top5_sectors(spark, d):
    return I.top_country_rows(gold_table(spark, d), I.TOP_SCATTER_COUNTRIES)


def q_country_frequency(spark, d):
    return I.country_frequency(I.geo_rows(gold(spark, d)))


def _panel_rows(spark, d):
    """Gold rows of the top-5 countries, written once: the histogram and KDE
    read them in several passes (statistics, quantiles, binning)."""
    return materialize(spark, I.top_country_rows(gold_table(spark, d)), "panel_rows")


def q_speed_histogram(spark, d):
    rows = _panel_rows(spark, d)
    return D.density_histogram(rows, "avg_ground_speed_knots", "origin_country")


def q_speed_kde(spark, d):
    rows = _panel_rows(spark, d)
    return D.kde_curves(rows, "avg_ground_speed_knots", "origin_country")


def q_phase_box_stats(spark, d):
    return D.box_stats(gold_table(spark, d), "avg_airborne_altitude_ft", "flight_phase")


def q_phase_outliers(spark, d):
    return D.box_outliers(gold_table(spark, d), "avg_airborne_altitude_ft", "flight_phase")


def q_null_profile(spark, d):
    return I.null_profile(gold(spark, d))


def q_null_mask(spark, d):
    return I.null_mask(gold(spark, d))


# --- data quality -----------------------------------------------------------

def q_dq_nulls(spark, d):
    s = silver_table(spark, d)
    return Q.combine(
        Q.null_checks(s, "silver", SILVER_KEY),
        Q.null_checks(gold_table(spark, d, s), "gold",
                      ("snapshot_hour", "origin_country", "flight_phase")))


def q_dq_duplicates(spark, d):
    rows = materialize(spark, silver_rows(spark, d), "silver_rows")
    s = materialize(spark, S.latest(rows), "silver")
    return Q.combine(
        Q.duplicate_checks(rows, "silver_input", SILVER_KEY),
        Q.duplicate_checks(s, "silver", SILVER_KEY),
        Q.duplicate_checks(gold_table(spark, d, s), "gold", GOLD_KEY))


def q_dq_lengths(spark, d):
    return Q.length_checks(silver(spark, d), "silver", SILVER_LENGTH_LIMITS)


def q_dq_rowcounts(spark, d):
    # Each check has its own plan; Gold is computed once (the feed is a
    # cheap projection of the scan).
    return Q.combine(
        Q.row_count_check(vectors(spark, d).filter(F.size("state") > 0), "payload_states"),
        Q.row_count_check(P.parse_records(vectors(spark, d)), "parsed_records"),
        Q.row_count_check(gold(spark, d), "gold"))


def q_dq_quarantine(spark, d):
    return Q.quarantine(vectors(spark, d))


def q_dq_type_drift(spark, d):
    return Q.type_drift_checks(vectors(spark, d))


def q_dq_freshness(spark, d):
    """Newest Gold hour against the newest ingest time, 2-hour limit."""
    # The newest ingested row always wins its key, so the Silver clock is
    # the maximum over the undeduplicated rows (a cheap scalar subquery).
    now = silver_rows(spark, d).agg(F.max("ingested_at")).scalar()
    return Q.freshness_check(gold(spark, d), "gold", "snapshot_hour", now, 7200)


def q_silver_flagged(spark, d):
    return Q.flag_nulls(P.flatten_states(vectors(spark, d), drop_null_keys=False))


def q_json_roundtrip(spark, d):
    """Feed rows serialized as payload JSON text, parsed back with the
    payload schema, exploded and flattened: must equal the direct path."""
    from contrail.schemas import PAYLOAD
    v = vectors(spark, d)
    text = v.select(F.to_json(F.struct("time", "fetched_at",
                                       F.array("state").alias("states"))).alias("raw"),
                    "ingested_at")
    parsed = text.select(F.from_json("raw", PAYLOAD).alias("p"), "ingested_at").select(
        "p.time", "p.fetched_at", "p.states", "ingested_at")
    return P.flatten_states(P.explode_payloads(parsed))


_PANELS = {
    "top_gold_5000": q_top_gold_5000,
    "top_silver_5000": q_top_silver_5000,
    "kpi_cards": q_kpi_cards,
    "country_top10": q_country_top10,
    "hourly_trend": q_hourly_trend,
    "country_frequency": q_country_frequency,
    "country_top5": q_country_top5,
    "country_top5_sectors": q_country_top5_sectors,
    "speed_histogram": q_speed_histogram,
    "speed_kde": q_speed_kde,
    "phase_box_stats": q_phase_box_stats,
    "phase_outliers": q_phase_outliers,
    "null_profile": q_null_profile,
    "null_mask": q_null_mask,
    "dq_nulls": q_dq_nulls,
    "dq_duplicates": q_dq_duplicates,
    "dq_lengths": q_dq_lengths,
    "dq_rowcounts": q_dq_rowcounts,
    "dq_quarantine": q_dq_quarantine,
    "dq_type_drift": q_dq_type_drift,
    "dq_freshness": q_dq_freshness,
    "silver_flagged": q_silver_flagged,
    "json_roundtrip": q_json_roundtrip,
}


def queries() -> dict[str, Query]:
    return {
        "state_parse": q_state_parse,
        "silver_standardize": q_silver_standardize,
        "silver_latest": q_silver_latest,
        "silver_upsert": q_silver_upsert,
        "geohash4": _geo(4),
        "geohash7": _geo(7),
        "flight_phase": q_flight_phase,
        "unit_convert": q_unit_convert,
        "gold_sector_hourly": q_gold_sector_hourly,
        "gold_rank": q_gold_rank,
        "gold_country_hourly": q_gold_country_hourly,
        "gold_approx_aircraft": q_gold_approx_aircraft,
        "gold_row_count": q_gold_row_count,
        **_PANELS,
    }


# --- files: landing, Bronze, sinks ------------------------------------------------

def _fresh(spark, label):
    from contrail.plans.tables import work_folder
    return work_folder(spark, label)


def q_bronze_variant_silver(spark, d):
    """Payloads of two vectors, and of none (those whose vector is short),
    landed as JSON, loaded into the VARIANT table and flattened; the ingest
    time is the file's and is left out."""
    root = _fresh(spark, "bronze")
    two = F.array("state", "state")
    states = F.when(F.size("state") >= MIN_VECTOR_SLOTS, two).otherwise(F.slice(two, 1, 0))
    B.land_payloads(vectors(spark, d).withColumn("states", states), f"{root}/landing")
    return bronze_silver_rows(B.load_bronze(spark, f"{root}/landing", f"{root}/table", ingested_at="file")).drop("ingested_at")


def q_bronze_partitions(spark, d):
    """Payloads in each hourly landing partition."""
    root = _fresh(spark, "landing")
    B.land_payloads(vectors(spark, d), root, hourly=True)
    return (spark.read.option("pathGlobFilter", B.PATTERN).text(root).groupBy("year", "month", "day", "hour")
            .agg(F.count(F.lit(1)).alias("payloads")))


def q_bronze_bad_files(spark, d):
    """A file with two broken lines and a good one beside the landed payloads:
    it is skipped whole and reported."""
    root = _fresh(spark, "bronze")
    B.land_payloads(vectors(spark, d), f"{root}/landing/good")
    broken = vectors(spark, d).limit(1).select(F.explode(F.array(
        F.lit('{"states": [["x"'), F.lit('{"states": [], "time": 1}'), F.lit("no JSON"))).alias("value"))
    broken.coalesce(1).write.text(f"{root}/landing/bad")
    paths = {"good": B.PATTERN, "bad": "*.txt"}
    for name, pattern in paths.items():
        good = B.load_bronze(spark, f"{root}/landing/{name}", f"{root}/table", ingested_at="file", pattern=pattern)
    bad = B.bad_files(spark, f"{root}/table").agg(F.count(F.lit(1)).alias("bad_files"),
                                                  F.sum("bad_values").alias("bad_values"))
    return good.agg(F.count(F.lit(1)).alias("good_values")).join(bad)


def _put(spark, lines, path):
    """A few constant lines as one file of that name, in place of an older one."""
    made = _fresh(spark, "file")
    lines.coalesce(1).write.text(made)
    fs, at = tables._fs(spark, path)
    part = next(s.getPath() for s in fs.listStatus(tables._fs(spark, made)[1]) if s.getPath().getName().startswith("part-"))
    fs.mkdirs(at.getParent())
    fs.delete(at, False)
    fs.rename(part, at)


def _lines(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def q_bronze_loads(spark, d):
    """SRC4, SRC6: three loads.  The first has the feed's older half and a file
    with a broken line; before the second, that file is repaired and the newer half
    lands; before the third, one more file.  A load reads what is new or changed."""
    root, v = _fresh(spark, "bronze"), vectors(spark, d)
    late = F.col("ingested_at") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    record = '{"icao24": "%s", "time_position": 1704067200}'
    one, two, three = (record % f"file{k}" for k in range(3))
    for part, name, lines in ((~late, "fetch", (one, "{broken", two)), (late, "fetch", (one, two, three)), (None, "more", (one,))):
        if part is not None:
            B.land_payloads(v.where(part), f"{root}/landing/feed")
        _put(spark, _lines(spark, *lines), f"{root}/landing/files/{name}.json")
        for folder in ("feed", "files"):
            B.load_files(spark, f"{root}/landing/{folder}", f"{root}/table_{folder}", ingested_at="file")
    stored = [B.stored_values(spark, f"{root}/table_{folder}").select(F.lit(folder).alias("landing"), "load", "source_file", "file_skipped")
              for folder in ("feed", "files")]
    return stored[0].unionByName(stored[1]).groupBy("landing", "load").agg(
        F.count_if(~F.col("file_skipped")).alias("good_values"), F.count_if("file_skipped").alias("skipped_values"),
        F.count_distinct(F.when(F.col("file_skipped"), F.col("source_file"))).alias("skipped_files"))


def q_bronze_days(spark, d):
    """SRC11: two of the landing's days are loaded."""
    root = _fresh(spark, "bronze")
    B.land_payloads(vectors(spark, d), f"{root}/landing")
    B.load_files(spark, f"{root}/landing", f"{root}/table", ingested_at="file", days=("2024-01-10", "2024-01-11"))
    return B.read_bronze(spark, f"{root}/table").agg(F.count(F.lit(1)).alias("payloads"))


def q_bronze_outer_array(spark, d):
    """SRC2, SRC5, SRC7: each value is an array of a payload and an empty one;
    loaded twice by force, with a given ingest time that is stored."""
    root = _fresh(spark, "bronze")
    payload = lambda states: F.struct("time", "fetched_at", states.alias("states"))
    one = F.array("state")
    arrays = vectors(spark, d).select(F.to_json(F.array(payload(one), payload(F.slice(one, 1, 0)))).alias("value"))
    arrays.write.text(f"{root}/landing")
    for _ in range(2):
        B.load_files(spark, f"{root}/landing", f"{root}/table", pattern="*.txt", ingested_at="2024-02-01 06:00:00", force=True)
    return bronze_silver_rows(B.read_bronze(spark, f"{root}/table"))


def q_bronze_dict_wrapper(spark, d):
    """SRC10: two records handed over as the first value of an object."""
    root = _fresh(spark, "bronze")
    records = P.parse_records(vectors(spark, d))
    wrapped = records.select(F.to_json(F.struct(F.array(F.struct("*"), F.struct("*")).alias("records"))).alias("value"))
    wrapped.write.text(f"{root}/landing")
    B.load_files(spark, f"{root}/landing", f"{root}/table", pattern="*.txt", ingested_at="file")
    return bronze_silver_rows(B.read_bronze(spark, f"{root}/table")).drop("ingested_at")


def q_dq_conservation(spark, d):
    """DQ9: every landed unit has one outcome, and the outcomes add up to what was
    landed: payloads of two vectors and of none, a file with broken lines,
    values that are no records."""
    root = _fresh(spark, "bronze")
    two = F.array("state", "state")
    states = F.when(F.size("state") >= MIN_VECTOR_SLOTS, two).otherwise(F.slice(two, 1, 0))
    B.land_payloads(vectors(spark, d).withColumn("states", states), f"{root}/landing")
    _put(spark, _lines(spark, '{"states": [["x"', '{"states": [["a"], ["b"]]}', "no JSON"), f"{root}/landing/bad.json")
    _put(spark, _lines(spark, "3", "null", "[]", '{"states": ["no vector", [null, "x"]]}'), f"{root}/landing/odd.json")
    B.load_files(spark, f"{root}/landing", f"{root}/table", ingested_at="file")
    values = B.stored_values(spark, f"{root}/table")
    total = A.landed(values).select("load", F.lit("landed").alias("outcome"), "n")
    return A.conservation(values).unionByName(total).select("outcome", "n")


def q_variant_drift(spark, d):
    """DQ6: fields found in two loads, the feed's payloads and records in which a
    field is new, one is gone and one has become an array."""
    root = _fresh(spark, "bronze")
    B.land_payloads(vectors(spark, d), f"{root}/landing")
    B.load_files(spark, f"{root}/landing", f"{root}/table", ingested_at="file")
    changed = P.parse_records(vectors(spark, d)).drop("squawk").withColumn("velocity", F.array("velocity")) \
               .withColumn("emergency", F.lit(False))
    B.land_records(changed, f"{root}/landing")
    B.load_files(spark, f"{root}/landing", f"{root}/table", ingested_at="file")
    return A.variant_drift(B.stored_values(spark, f"{root}/table"))


def q_records_silver(spark, d):
    """The flat record shape: written as JSON, loaded, labels undone."""
    root = _fresh(spark, "records")
    B.land_records(P.parse_records(vectors(spark, d)), f"{root}/landing")
    return bronze_silver_rows(B.load_bronze(spark, f"{root}/landing", f"{root}/table", ingested_at="file")).drop("ingested_at")


def q_silver_append(spark, d):
    """Append-only Silver of two ingest batches: keys repeat across batches."""
    path, rows = _fresh(spark, "silver_append"), silver_rows(spark, d)
    late = F.col("ingested_at") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    for part in (~late, late):
        tables.append(S.latest(rows.where(part)), path)
    return spark.read.schema(SILVER).parquet(path)


def q_silver_bucketed(spark, d):
    """Two ingest batches upserted into a Silver table of the catalog, by day and in
    buckets by aircraft."""
    path, rows = _fresh(spark, "silver_bucketed"), silver_rows(spark, d)
    name = f"silver_bucketed_{uuid.uuid4().hex}"
    catalog_tables.create_silver(spark, name, path)
    late = F.col("ingested_at") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    for part in (~late, late):
        catalog_tables.upsert_silver(spark, name, path, rows.where(part))
    return spark.table(name).select(*SILVER.fieldNames())


def q_gold_published(spark, d):
    """Gold published in full, then its days once more, read back."""
    root = _fresh(spark, "sinks")
    tables.upsert_silver(spark, f"{root}/silver", silver_rows(spark, d))
    build_gold(spark, tables.read_silver(spark, f"{root}/silver"), f"{root}/gold")
    days = tables.read_days(spark, f"{root}/silver", SILVER, tables.DAY).select(tables.DAY).distinct()
    refresh_gold_days(spark, f"{root}/silver", days, f"{root}/gold")
    return tables.read_gold(spark, f"{root}/gold")


def q_gold_incremental(spark, d):
    """Gold kept up to date through stored partial aggregates over three upserts."""
    root, rows = _fresh(spark, "sinks"), silver_rows(spark, d)
    for part in _thirds():
        with tables.written(spark, rows.where(part), "batch") as batch:
            upsert_layers(spark, root, batch)
    return tables.read_gold(spark, f"{root}/gold")


def _thirds():
    cut = [F.lit(f"2024-01-{day} 00:00:00").cast("timestamp_ntz") for day in ("10", "20")]
    seen = F.col("ingested_at")
    return seen < cut[0], (seen >= cut[0]) & (seen < cut[1]), (seen >= cut[1]) | seen.isNull()


def q_gold_sketch_days(spark, d):
    """AGG21: stored sketches of the Gold groups, rolled up to day and country, held
    against the exact count of the day's aircraft."""
    state = materialize(spark, G.partials(G.base_vectors(silver(spark, d)), "callsign"), "gold_state")
    sketches = materialize(spark, G.aircraft_sketches(state), "gold_sketches")
    key = (F.date_format("snapshot_hour", "yyyy-MM-dd").alias("day"), "origin_country")
    exact = state.groupBy(*key).agg(F.count_distinct("icao24").alias("aircraft"))
    return G.roll_up(sketches, *key).join(exact, ["day", "origin_country"]).select(
        "day", "origin_country", "aircraft",
        G.within_sketch_error(F.col("approx_aircraft"), F.col("aircraft"), G.SKETCH_RSD).alias("within_error"))


# --- streaming ----------------------------------------------------------------

#: Files of the events table per micro-batch (a rate limit).
STREAM_FILES = 1000
#: The feed folds position times into six hours in any order: no report of it
#: is late by more.
FOLD_DELAY = "7 hours"


def _stream_vectors(spark, d, batch):
    return P.flatten_states(vectors_from_typed(typed_from(batch, table(spark, d, "nation"))))


def _stream_tables(spark, d, with_gold=True, max_files=STREAM_FILES):
    """Stream the ``events`` table (file source, checkpointed) through the
    feed projection into the Silver and Gold tables, under a fresh folder of
    the shared directory."""
    root = _fresh(spark, "stream")
    q = STR.upsert_stream(spark, stream_table(spark, d, "events", max_files), f"{root}/silver",
                          f"{root}/gold" if with_gold else None, f"{root}/_checkpoint",
                          to_rows=lambda batch: _stream_vectors(spark, d, batch))
    STR.run_available(q)
    return root


def q_stream_silver(spark, d, max_files=STREAM_FILES):
    return tables.read_silver(spark, f"{_stream_tables(spark, d, False, max_files)}/silver")


def q_stream_gold(spark, d, max_files=STREAM_FILES):
    return tables.read_gold(spark, f"{_stream_tables(spark, d, True, max_files)}/gold")


def q_stream_dedup_keys(spark, d, max_files=STREAM_FILES, delay=FOLD_DELAY):
    """STR2: first report per (aircraft, position time) within a watermark
    that covers the feed's disorder, written by a file sink; the surviving keys
    are returned (which duplicate arrives first is arbitrary, the key set is
    not)."""
    root = _fresh(spark, "stream")
    rows = _stream_vectors(spark, d, stream_table(spark, d, "events", max_files))
    q = (STR.dedup_stream(rows, delay).select("icao24", "time_position")
         .writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/_checkpoint")
         .trigger(availableNow=True).start())
    STR.run_available(q)
    return spark.read.parquet(f"{root}/out")


def q_stream_hourly_traffic(spark, d, max_files=STREAM_FILES, delay=FOLD_DELAY):
    """STR3: tumbling one-hour windows per country with a HyperLogLog
    aircraft count and a report count, in update mode; the sketch is held
    against the exact count of the same rows."""
    root = _fresh(spark, "stream")
    rows = _stream_vectors(spark, d, stream_table(spark, d, "events", max_files))
    key = ["flight_hour", "origin_country"]
    made = STR.collect_updates(STR.hourly_traffic_stream(rows, delay), f"{root}/out", f"{root}/_checkpoint", key)
    exact = silver_rows(spark, d).groupBy(
        hour_floor(F.col("time_position")).alias("flight_hour"),
        F.coalesce("origin_country", F.lit(G.UNKNOWN_COUNTRY)).alias("origin_country")).agg(
        F.count_distinct("icao24").alias("aircraft"))
    return made.join(exact, key).select(*key, "reports", G.within_sketch_error(
        F.col("approx_aircraft"), F.col("aircraft")).alias("within_error"))


def q_stream_json_keys(spark, d):
    """SRC6, STR1, STR5: a JSON landing streamed a few files at a time through
    Bronze into Silver (keys: which file is newest is arbitrary)."""
    root = _fresh(spark, "stream")
    B.land_payloads(vectors(spark, d), f"{root}/landing", hourly=True)
    n_files = spark.read.option("pathGlobFilter", B.PATTERN).text(f"{root}/landing").select(
        "_metadata.file_path").distinct().count()
    q = STR.upsert_stream(spark, STR.bronze_stream(spark, f"{root}/landing", max(1, -(-n_files // 3))),
                          f"{root}/silver", None, f"{root}/_checkpoint")
    STR.run_available(q)
    return tables.read_silver(spark, f"{root}/silver").select("icao24", "time_position")


def q_stream_late_rows(spark, d):
    """STR2, STR5: four arrivals of the feed, the third a day ahead, so that the fourth
    is behind the watermark.  The newest kept row of each key, and every late row."""
    root, rows = _fresh(spark, "stream"), silver_rows(spark, d)
    ahead = rows.withColumn("time_position", F.col("time_position") + F.expr("INTERVAL 1 DAY"))
    first, second, third = _thirds()
    odd = F.pmod(F.xxhash64("icao24", "time_position", "ingested_at"), F.lit(2)) == 1
    for part in (rows.where(first & odd), rows.where(first & ~odd), ahead.where(second), rows.where(third)):
        part.write.mode("append").parquet(f"{root}/in")
        arrivals = spark.readStream.schema(SILVER).option("maxFilesPerTrigger", STREAM_FILES).parquet(f"{root}/in")
        STR.run_available(LATE.outcome_stream(arrivals, f"{root}/out", f"{root}/_checkpoint", FOLD_DELAY))
    kept = LATE.kept_silver(spark, f"{root}/out").withColumn("late", F.lit(False))
    return kept.unionByName(LATE.late_rows(spark, f"{root}/out").withColumn("late", F.lit(True)))


_PANELS |= {
    "gold_incremental": q_gold_incremental,
    "gold_sketch_days": q_gold_sketch_days,
    "stream_late_rows": q_stream_late_rows,
    "bronze_variant_silver": q_bronze_variant_silver,
    "bronze_partitions": q_bronze_partitions,
    "bronze_bad_files": q_bronze_bad_files,
    "bronze_loads": q_bronze_loads,
    "bronze_days": q_bronze_days,
    "bronze_outer_array": q_bronze_outer_array,
    "bronze_dict_wrapper": q_bronze_dict_wrapper,
    "dq_conservation": q_dq_conservation,
    "variant_drift": q_variant_drift,
    "records_silver": q_records_silver,
    "silver_append": q_silver_append,
    "silver_bucketed": q_silver_bucketed,
    "gold_published": q_gold_published,
    "stream_dedup_keys": q_stream_dedup_keys,
    "stream_hourly_traffic": q_stream_hourly_traffic,
    "stream_silver": q_stream_silver,
    "stream_gold": q_stream_gold,
    "stream_json_keys": q_stream_json_keys,
}
