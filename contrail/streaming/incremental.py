"""Incremental pipeline on Structured Streaming.

* ``bronze_stream``: new landing files only (the file source's checkpoint
  remembers what was read), bad files skipped per micro-batch.
* ``medallion_stream``: every table of the batch run (Bronze and its ledger,
  rejects, quarantine, drift, accounting, Silver, Gold) from one foreachBatch
  sink, idempotent by batch id.
* ``dedup_stream``: first report per (aircraft, position time) within a
  watermark; state is bounded by the watermark.
* ``hourly_traffic_stream``: tumbling one-hour windows with a HyperLogLog
  distinct-aircraft count (exact distinct is not allowed on streams).
* ``upsert_stream``: exact latest-wins Silver and Gold refresh per
  micro-batch through ``foreachBatch``: the batch is merged into the touched
  day partitions and Gold is recomputed for those days (late rows included).
  Latest-wins is idempotent, so a replayed batch, also the first one and also
  after the checkpoint was reset, gives the same tables.

Streams run with ``trigger(availableNow=True)``: everything present is
processed in bounded micro-batches, then the query stops.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from contrail.functions.timefn import epoch_to_ntz, ntz_to_epoch
from contrail.operators import gold as G
from contrail.operators.bronze_silver import bronze_silver_rows
from contrail.plans import tables
from contrail.plans.medallion import ingest_load, refresh_gold_days
from contrail.sources.bronze import PATTERN, commit_load, is_new, parse_text, read_ledger, variant_rows, write_load


# Landing files per micro-batch: a rate limit, every file is read.
MAX_FILES_PER_BATCH = 1000


def bronze_stream(spark: SparkSession, landing: str, max_files: int = MAX_FILES_PER_BATCH,
                  pattern: str = PATTERN) -> DataFrame:
    """Bronze rows (VARIANT) of the landing files that are new."""
    lines = (spark.readStream.option("pathGlobFilter", pattern)
             .option("maxFilesPerTrigger", max_files).text(landing))
    return parse_text(lines)


def clean_batch(batch: DataFrame) -> DataFrame:
    """Objects of the batch's good files (a file is never split over batches)."""
    bad = batch.where("bad_text IS NOT NULL").select("source_file").distinct()
    return variant_rows(batch.join(bad, "source_file", "left_anti").drop("bad_text"))


def event_time(rows: DataFrame, col: str = "time_position") -> DataFrame:
    """Watermarks need TIMESTAMP (LTZ): ``event_ts`` is the NTZ wall clock
    read as UTC (via epoch seconds, so no session time zone is involved and
    hour windows align with the NTZ hours)."""
    return rows.withColumn("event_ts", F.timestamp_seconds(ntz_to_epoch(F.col(col))))


def from_event_time(ts: Column) -> Column:
    return epoch_to_ntz(F.unix_seconds(ts))


def dedup_stream(rows: DataFrame, delay: str = "2 hours") -> DataFrame:
    return (event_time(rows).withWatermark("event_ts", delay)
            .dropDuplicatesWithinWatermark(["icao24", "time_position"])
            .drop("event_ts"))


def hourly_traffic_stream(rows: DataFrame, delay: str = "2 hours") -> DataFrame:
    r = event_time(rows).withWatermark("event_ts", delay)
    country = F.coalesce(F.trim("origin_country"), F.lit(G.UNKNOWN_COUNTRY))
    return (r.groupBy(F.window("event_ts", "1 hour").alias("w"), country.alias("origin_country"))
             .agg(F.approx_count_distinct("icao24").alias("approx_aircraft"),
                  F.count(F.lit(1)).alias("reports"))
             .select(from_event_time(F.col("w.start")).alias("flight_hour"),
                     "origin_country", "approx_aircraft", "reports"))


def upsert_batch(spark: SparkSession, silver_path: str, gold_path: str | None,
                 to_rows=None):
    """foreachBatch handler; ``to_rows`` turns a micro-batch into Silver rows
    (default: Bronze batches from ``bronze_stream``)."""
    to_rows = to_rows or (lambda b: bronze_silver_rows(clean_batch(b)))
    refresh = (lambda days: refresh_gold_days(spark, silver_path, days, gold_path)) if gold_path else None

    def handle(batch: DataFrame, batch_id: int) -> None:
        tables.upsert_silver(spark, silver_path, to_rows(batch), then=refresh)
    return handle


def upsert_stream(spark: SparkSession, stream: DataFrame, silver_path: str,
                  gold_path: str | None, checkpoint: str, to_rows=None):
    return (stream.writeStream.foreachBatch(upsert_batch(spark, silver_path, gold_path, to_rows))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def medallion_batch(spark: SparkSession, warehouse: str, name: str):
    """foreachBatch handler: a micro-batch becomes a Bronze load of its own, named
    by the stream and the batch, and is taken through every table that a batch run
    writes.  A replayed batch overwrites its load; files that another load has
    already (a batch run, or this stream before its checkpoint was lost) are
    left out."""
    bronze = f"{warehouse.rstrip('/')}/bronze"

    def handle(batch: DataFrame, batch_id: int) -> None:
        load = f"{name}-{batch_id:012d}"
        write_load(is_new(batch, read_ledger(spark, bronze).where(F.col("load") != load)).select(*batch.columns), bronze, load)
        commit_load(spark, bronze, load)
        ingest_load(spark, warehouse, load, check=False)
    return handle


def medallion_stream(spark: SparkSession, stream: DataFrame, warehouse: str, checkpoint: str):
    """STR1, STR4: the batch run's tables, kept up to date from new landing files.
    Loads are named after the checkpoint, so a stream with a new one does not
    overwrite those of the old."""
    name = f"stream-{zlib.crc32(checkpoint.rstrip('/').encode()):08x}"
    return (stream.writeStream.foreachBatch(medallion_batch(spark, warehouse, name))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def collect_updates(stream: DataFrame, path: str, checkpoint: str, key) -> DataFrame:
    """Run an update-mode aggregation to completion: every micro-batch's
    updated rows are appended with the batch id, and the newest version of
    each key is returned (a window over the key, one small partition per
    key)."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(path)

    q = (stream.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    run_available(q)
    out = stream.sparkSession.read.parquet(path)
    w = Window.partitionBy(*key).orderBy(F.col("_batch").desc())
    return (out.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
               .drop("_rn", "_batch"))


def run_available(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()
