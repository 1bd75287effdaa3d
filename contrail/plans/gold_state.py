"""Incremental Gold: stored partial aggregates and mergeable sketches.

``gold_state`` has one row per (group, aircraft, callsign) with sums, counts and
extremes, partitioned by hour.  A batch touches (hour, aircraft) pairs: a new row and
the row that it supersedes have the same position time, so they lie in one pair.
The pairs' partials are made again from Silver and replace the stored ones, those of
all other aircraft are kept.  Nothing is subtracted: sums do not drift, and extremes
and distinct callsigns are right after a superseded row has gone.

The touched hours of Gold, with their ranks, and of the sketches are then folded from
the state alone.  Hours are the unit because the rank compares an hour's groups.

One writer at a time per table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.timefn import hour_floor
from contrail.operators import gold as G
from contrail.plans import tables
from contrail.schemas import GOLD, GOLD_COLUMNS

_KEY = [T.StructField("snapshot_hour", T.TimestampNTZType()), T.StructField("origin_country", T.StringType()),
        T.StructField("spatial_sector", T.StringType()), T.StructField("flight_phase", T.StringType())]
STATE = T.StructType([
    *_KEY, T.StructField("icao24", T.StringType()), T.StructField("callsign", T.StringType()),
    *[T.StructField(f"{name}_{part}", kind) for name in ("lat", "lon", "speed", "alt")
      for part, kind in (("sum", T.DoubleType()), ("n", T.LongType()))],
    T.StructField("flew", T.BooleanType()), T.StructField("stood", T.BooleanType()),
    T.StructField("alt_max", T.DoubleType()), T.StructField("alt_min", T.DoubleType())])
SKETCHES = T.StructType([*_KEY, T.StructField("aircraft_sketch", T.BinaryType())])


def hour_key(hour: Column) -> Column:
    return F.date_format(hour, "yyyy-MM-dd-HH")


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_days(spark, path, STATE, tables.HOUR)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_days(spark, path, SKETCHES, tables.HOUR).drop(tables.HOUR)


def _publish(spark: SparkSession, rows: DataFrame, path: str, schema: T.StructType) -> None:
    """Replace the hours that ``rows`` has."""
    tables.recover(spark, path, schema, tables.HOUR)
    folder = tables.stage(rows.withColumn(tables.HOUR, hour_key(F.col("snapshot_hour"))), path, tables.HOUR)
    tables.publish(spark, folder, path, schema, tables.HOUR)
    tables.remove(spark, folder)


def _hours(touched: DataFrame) -> DataFrame:
    return touched.select(hour_key(F.col("snapshot_hour")).alias(tables.HOUR)).distinct()


def touched_silver(spark: SparkSession, silver_path: str, touched: DataFrame) -> DataFrame:
    """Silver rows of the touched (snapshot_hour, icao24) pairs; the join on the day
    prunes the partitions of all other days."""
    pairs = touched.withColumn(tables.DAY, F.to_date("snapshot_hour"))
    return (tables.read_days(spark, silver_path, tables.SILVER, tables.DAY)
            .withColumn("snapshot_hour", hour_floor(F.col("time_position")))
            .join(pairs, [tables.DAY, "snapshot_hour", "icao24"], "left_semi").drop(tables.DAY, "snapshot_hour"))


def refresh_state(spark: SparkSession, silver_path: str, state_path: str, touched: DataFrame) -> None:
    """Put the touched pairs' partials in the place of the stored ones."""
    made = G.partials(G.base_vectors(touched_silver(spark, silver_path, touched)), "callsign")
    kept = (read_state(spark, state_path).join(_hours(touched), tables.HOUR, "left_semi")
            .join(touched, ["snapshot_hour", "icao24"], "left_anti"))
    names = STATE.fieldNames()
    _publish(spark, kept.select(*names).unionByName(made.select(*names)), state_path, STATE)


def refresh_gold_hours(spark: SparkSession, state_path: str, gold_path: str, sketch_path: str, touched: DataFrame) -> None:
    """Fold the touched hours of the state into Gold and its sketches.  Gold is
    partitioned by day: a touched day's other hours are taken over as they are."""
    hours = _hours(touched)
    state = read_state(spark, state_path).join(hours, tables.HOUR, "left_semi").drop(tables.HOUR)
    with tables.written(spark, G.groups_of(G.fold(state), state), "gold_aggregates") as agg:
        fresh = G.rank_sectors(agg, materialized=True).select(*GOLD_COLUMNS)
        days = touched.select(F.to_date("snapshot_hour").alias(tables.SNAPSHOT_DATE)).distinct()
        stored = tables.read_days(spark, gold_path, GOLD, tables.SNAPSHOT_DATE).join(days, tables.SNAPSHOT_DATE, "left_semi")
        others = stored.withColumn(tables.HOUR, hour_key(F.col("snapshot_hour"))).join(hours, tables.HOUR, "left_anti")
        tables.refresh_gold(spark, others.select(*GOLD_COLUMNS).unionByName(fresh), gold_path, full=False)
    _publish(spark, G.aircraft_sketches(state), sketch_path, SKETCHES)
