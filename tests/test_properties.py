"""Properties over a seeded random batch of vectors."""

import datetime as dt
import random

from pyspark.sql import functions as F

from contrail.operators import gold as G
from contrail.operators import parse as P
from contrail.operators import silver as S
from helpers import T0, VEC, vector


def _random_vectors(n, seed, clean=False):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        on_ground = rnd.choice(["true", "false"] if clean else ["true", "false", None])
        call = rnd.choice(["AB1", "CD22 ", " EF3"] if clean else ["AB1", "", None, " \t"])
        v = vector(icao=f"a{rnd.randrange(12):02d}", call=call,
                   country=rnd.choice(["France", " Spain ", "Peru"]),
                   tpos=T0 + 300 * rnd.randrange(30), lon=f"{rnd.uniform(-20, 20):.5f}",
                   lat=f"{rnd.uniform(30, 60):.5f}", alt=f"{rnd.uniform(0, 12000):.2f}",
                   on_ground=on_ground, vel=f"{rnd.uniform(0, 300):.3f}")
        ing = dt.datetime(2024, 1, 2) + dt.timedelta(seconds=i)
        rows.append((T0, None, v, ing))
    return rows


def test_record_path_equals_payload_path(spark):
    df = spark.createDataFrame(_random_vectors(300, 1, clean=True), VEC)
    via_payload = S.latest(P.flatten_states(df))
    via_records = S.latest(P.records_to_silver(P.parse_records(df, keep=["ingested_at"])))
    a = sorted(map(tuple, via_payload.collect()), key=repr)
    b = sorted(map(tuple, via_records.select(*via_payload.columns).collect()), key=repr)
    assert a == b


def test_dedup_idempotent_and_order_free(spark):
    rows = _random_vectors(400, 2)
    df = P.flatten_states(spark.createDataFrame(rows, VEC))
    rev = P.flatten_states(spark.createDataFrame(list(reversed(rows)), VEC).repartition(7))
    once = sorted(map(tuple, S.latest(df).collect()), key=repr)
    assert once == sorted(map(tuple, S.latest(S.latest(df)).collect()), key=repr)
    assert once == sorted(map(tuple, S.latest(rev).collect()), key=repr)


def test_airborne_plus_ground_covers_unique(spark):
    df = P.flatten_states(spark.createDataFrame(_random_vectors(400, 3, clean=True), VEC))
    g = G.gold(S.latest(df))
    bad = g.filter(F.col("airborne_aircraft_count") + F.col("ground_aircraft_count")
                   < F.col("unique_aircraft_count"))
    assert g.count() > 0 and bad.count() == 0
