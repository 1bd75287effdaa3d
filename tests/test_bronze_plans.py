"""Stored values are read once: plans and results of the readers of VARIANT rows."""

from pyspark.sql import functions as F

from contrail.operators import accounting as A
from contrail.operators.bronze_silver import bronze_silver_rows
from contrail.sources import bronze as B

VALUES = ['{"records": [{"icao24": "a", "time_position": 1704067200, "callsign": "N/A", "origin_country": "unknown"}, {"icao24": "b"}]}',
          '{"records": [{"icao24": "c"}, 3]}', '{"records": []}', '{"states": [["d"], "x"]}', '{"one": [1], "two": [{}]}',
          '[{"icao24": "e", "time_position": 1704067200}, null]', "{}", "null", "3"]


def _raw(spark):
    return spark.createDataFrame([(k, x) for k, x in enumerate(VALUES)], "k int, value string").select(
        "k", F.try_parse_json("value").alias("raw_data"))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_elements_make_the_map_of_a_value_once(spark):
    assert _plan(B.variant_rows(_raw(spark))).count("MapType(") == 1


def test_elements_of_odd_values(spark):
    got = B.variant_rows(_raw(spark)).select("k", F.to_json("raw_data").alias("v")).collect()
    assert [[r.v for r in got if r.k == k] for k in (1, 3, 4, 6, 7, 8)] == [[VALUES[k].replace(": ", ":").replace(", ", ",")] for k in (1, 3, 4, 6, 7, 8)]
    assert [sum(r.k == k for r in got) for k in (0, 2, 5)] == [2, 0, 2]


def test_silver_rows_read_each_field_once(spark):
    rows = bronze_silver_rows(B.variant_rows(_raw(spark)).withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp_ntz")))
    assert _plan(rows).count("$.callsign") == 1 and _plan(rows).count("$.time_position") == 1
    assert sorted((r.icao24, r.callsign, r.origin_country) for r in rows.collect()) == [("a", None, None), ("e", None, None)]


def test_drift_reads_the_stored_values_once(spark, scratch):
    spark.createDataFrame([(x,) for x in VALUES], "value string").coalesce(1).write.text(f"{scratch}/landing")
    B.load_files(spark, f"{scratch}/landing", f"{scratch}/table", pattern="*.txt", ingested_at="file")
    found = A.discovered(B.stored_values(spark, f"{scratch}/table"))
    assert _plan(found).count("Join") == 1
    got = {(r["shape"], r["field"]): (r.found, r.n) for r in found.collect()}
    assert got["vector", "icao24"] == ("string", 1) and got["payload", "states"] == ("array", 1)
    assert got["record", "icao24"] == ("string", 3) and got["record", "two"] == ("array", 1)
