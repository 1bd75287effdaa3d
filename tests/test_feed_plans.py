"""Plans over the feed: even shares, and methods that the JVM compiles."""

import datetime as dt
import os
import re

from pyspark.sql import functions as F

from contrail.operators import parse as P
from contrail.plans import catalog as C
from contrail.sources.feed import typed_events
from helpers import vec_rows, vector

#: HotSpot leaves methods beyond this size to its interpreter.
COMPILED = 8000


def _feed(spark, folder, n=500):
    at = dt.datetime(2024, 1, 1)
    events = [(k, at + dt.timedelta(minutes=7 * k), k % 50, "error" if k % 3 else "view", k / 4) for k in range(n)]
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double") \
         .coalesce(1).write.parquet(os.path.join(folder, "events.parquet"))
    spark.createDataFrame([(k, f"N{k}") for k in range(5)], "n_nationkey int, n_name string") \
         .coalesce(1).write.parquet(os.path.join(folder, "nation.parquet"))
    return folder


def _method_sizes(spark, df):
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = debug.codegenString(df._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]


def test_feed_methods_are_small_enough_to_be_compiled(spark, scratch):
    d = _feed(spark, scratch)
    for df in (C.silver_rows(spark, d), P.parse_records(C.vectors(spark, d)), C.silver(spark, d)):
        sizes = _method_sizes(spark, df)
        assert sizes and max(sizes) < COMPILED


def test_silver_rows_are_parsed_where_the_vectors_are_derived(spark, scratch):
    plan = C.silver_rows(spark, _feed(spark, scratch))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "RepartitionByExpression [event_id#" in plan
    # the text of the position time is read once, though the rules of an epoch name it several times
    assert len(re.findall(r"state#\d+\[3\]", plan)) == 1


def test_silver_times_on_the_edges_of_the_epoch(spark):
    given = ["0", "-1", "4102444799", "4102444800", "1.5", "99999999999999", "1e400", "x", "", None]
    rows = vec_rows(spark, [vector(icao=str(k), tpos=t) for k, t in enumerate(given)])
    got = {r.icao24: r.time_position for r in P.flatten_states(rows, drop_null_keys=False).collect()}
    epoch = dt.datetime(1970, 1, 1)
    want = {"0": epoch, "2": dt.datetime(2099, 12, 31, 23, 59, 59), "4": epoch + dt.timedelta(seconds=2)}
    assert got == {str(k): want.get(str(k)) for k in range(len(given))}
    assert {r.icao24 for r in P.flatten_states(rows).collect()} == set(want)


def test_feed_of_one_file_is_dealt_out(spark, scratch):
    d = _feed(spark, scratch, 5000)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        shares = [r["count"] for r in C.silver_rows(spark, d).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(shares) > 1 and max(shares) < 2 * sum(shares) / len(shares)


def test_vectors_are_derived_from_events_dealt_out(spark, scratch):
    d = _feed(spark, scratch, 5000)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        shares = [r["count"] for r in typed_events(spark, d).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(shares) == 5000 and len(shares) > 1 and max(shares) < 2 * sum(shares) / len(shares)


def test_a_filter_on_the_ingest_time_reaches_the_scan(spark, scratch):
    rows = C.silver_rows(spark, _feed(spark, scratch)).where(F.col("ingested_at") < F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz"))
    assert "LessThan(ts," in rows._jdf.queryExecution().executedPlan().toString()


def test_records_of_short_and_missing_vectors(spark):
    rows = vec_rows(spark, [vector(), vector(slots=16), None, []])
    assert P.parse_records(rows).count() == 1
    assert P.flatten_states(rows, drop_null_keys=False).count() == 4 and P.flatten_states(rows).count() == 2
