"""Latest-wins corrections with a bounded state, and late rows kept aside.

Every micro-batch is held against the newest kept rows of its keys (aircraft, position
time) in one shuffle by key.  Every input row comes out once, with its outcome:

* ``first``: the first newest row of a key, ``correction``: a row that replaces the
  newest row of an earlier micro-batch (at most one a key and micro-batch);
* ``superseded``: an older row, or a repeat;
* ``late``: a row behind the watermark, which a watermarked operator would have
  dropped without a trace.

So kept and late rows add up to the input.  Newest is what ``silver.latest`` calls so,
and the newest row among firsts and corrections is the key's Silver row.  A null
position time or aircraft must have been removed (the Silver rows have none).

The state is the firsts and corrections of earlier micro-batches themselves.  Outcomes
lie by day, and a micro-batch reads the days that the watermark has not passed, so the
state is bounded by the delay.  The watermark is the newest position time of the earlier
micro-batches less the delay, as in Spark's own.

Outcomes lie by micro-batch, too: a micro-batch done again after a failure reads the
state before it and writes the same rows in the place of its own.  A path belongs to one
checkpoint, and both to one delay.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators import silver as S
from contrail.plans import tables
from contrail.schemas import SILVER, SILVER_KEY

#: The session's state store.  Nothing here sets it: the outcomes are the state.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
EPOCH = dt.datetime(1970, 1, 1)
OUTCOME, BATCH = "outcome", "batch"
KEPT = ("first", "correction")
RESULT = T.StructType([*SILVER.fields, T.StructField(OUTCOME, T.StringType())])
STORED = T.StructType([*RESULT.fields, T.StructField(tables.DAY, T.DateType()), T.StructField(BATCH, T.LongType())])


def _micros(at: Column) -> Column:
    """Microseconds since 1970, as a watermark sees them: of the whole millisecond."""
    us = F.timestamp_diff("MICROSECOND", F.lit(str(EPOCH)).cast("timestamp_ntz"), at)
    return us - F.pmod(us, F.lit(1000))


def _kept_before(spark: SparkSession, path: str, batch_id: int, days: list[str], kinds=KEPT) -> DataFrame:
    """Firsts and corrections of the given day folders from earlier micro-batches."""
    there = [f"{path}/{OUTCOME}={kind}/{day}" for kind in kinds
             for day in sorted(set(days) & set(tables.folders(spark, f"{path}/{OUTCOME}={kind}")))]
    if not there:
        return spark.createDataFrame([], SILVER)
    kept = spark.read.schema(STORED).option("basePath", path).parquet(*there)
    return kept.where(F.col(BATCH) < batch_id).select(*SILVER.fieldNames())


def _watermark(spark: SparkSession, path: str, batch_id: int, delay: str) -> int:
    """In microseconds since 1970.  Every position time that was not late has a first, so
    the newest day with one of an earlier micro-batch has the newest time."""
    for day in sorted(tables.folders(spark, f"{path}/{OUTCOME}=first"), reverse=True):
        newest = F.max("time_position") - F.expr(f"INTERVAL '{delay}'")
        mark = _kept_before(spark, path, batch_id, [day], ("first",)).agg(_micros(newest)).first()[0]
        if mark is not None:
            return max(mark, 0)
    return 0


def outcomes(stored: DataFrame, rows: DataFrame, mark: int) -> DataFrame:
    """Every one of ``rows`` with its outcome, given the kept rows of earlier micro-batches
    and the watermark.  A stored row wins over its repeats."""
    names = SILVER.fieldNames()
    live = stored.select(*names).where(_micros(F.col("time_position")) >= mark)
    both = live.withColumn("_known", F.lit(True)).unionByName(rows.select(*names).withColumn("_known", F.lit(False)))
    by_key = Window.partitionBy(*SILVER_KEY).orderBy(*S.newest_first(), F.col("_known").desc())
    whole = by_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    outcome = (F.when(_micros(F.col("time_position")) < mark, "late")
                .when(F.col("_rn") > 1, "superseded")
                .when(F.col("_corrects"), "correction").otherwise("first"))
    return (both.withColumns({"_rn": F.row_number().over(by_key), "_corrects": F.max("_known").over(whole)})
                .where(~F.col("_known")).select(*names, outcome.alias(OUTCOME)))


def outcome_batch(spark: SparkSession, path: str, delay: str):
    """foreachBatch handler: write the outcomes of a micro-batch."""
    path = path.rstrip("/")

    def handle(batch: DataFrame, batch_id: int) -> None:
        mark = _watermark(spark, path, batch_id, delay)
        since = f"{tables.DAY}={(EPOCH + dt.timedelta(microseconds=mark)).date()}"
        live = {day for kind in KEPT for day in tables.folders(spark, f"{path}/{OUTCOME}={kind}") if day >= since}
        made = outcomes(_kept_before(spark, path, batch_id, sorted(live)), batch, mark)
        (made.withColumns({tables.DAY: F.to_date("time_position"), BATCH: F.lit(batch_id).cast("long")})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(OUTCOME, tables.DAY, BATCH).parquet(path))
    return handle


def outcome_stream(rows: DataFrame, path: str, checkpoint: str, delay: str = "2 hours"):
    """Write the outcomes, one folder each, exactly once."""
    return (rows.writeStream.foreachBatch(outcome_batch(rows.sparkSession, path, delay))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path).select(*RESULT.fieldNames())


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    return read_outcomes(spark, path).where(F.col(OUTCOME) == "late").drop(OUTCOME)


def kept_silver(spark: SparkSession, path: str) -> DataFrame:
    """The newest kept row of each key."""
    return S.latest(read_outcomes(spark, path).where(F.col(OUTCOME).isin(*KEPT)).drop(OUTCOME))
