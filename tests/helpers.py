"""Small builders for hand fixtures."""

import datetime as dt

from pyspark.sql import types as T

from contrail.schemas import SILVER

VEC = T.StructType([
    T.StructField("time", T.LongType()), T.StructField("fetched_at", T.LongType()),
    T.StructField("state", T.ArrayType(T.StringType())),
    T.StructField("ingested_at", T.TimestampNTZType()),
])

T0 = 1704067200  # 2024-01-01 00:00:00


def vector(icao="abc123", call="UAL1", country="France", tpos=T0, lon="1.5", lat="2.5",
           alt="1000", on_ground="false", vel="100", slots=17):
    v = [icao, call, country, None if tpos is None else str(tpos), str(T0), lon, lat, alt,
         on_ground, vel, "90", "0", None, "1010", "7000", None, "0"]
    return v[:slots]


def vec_rows(spark, vectors, ingested=None, time=T0, fetched=None):
    ing = ingested or dt.datetime(2024, 1, 1, 1, 0, 0)
    return spark.createDataFrame([(time, fetched, v, ing) for v in vectors], VEC)


def silver_df(spark, rows):
    return spark.createDataFrame(rows, SILVER)


def ts(s):
    return dt.datetime.fromisoformat(s)
