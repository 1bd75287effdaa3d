from pyspark.sql import functions as F

from contrail.functions import flight_phase, geohash
from contrail.functions.flight import PHASE_GROUND, PHASE_HIGH, PHASE_LOW, PHASE_MID, PHASE_UNKNOWN
from contrail.functions.timefn import epoch_to_ntz, hour_floor, ntz_to_epoch


def test_geohash_known_points(spark):
    df = spark.createDataFrame(
        [(-5.603, 42.605), (-122.4194, 37.7749), (180.0, 90.0), (None, 1.0), (1.0, None),
         (181.0, 0.0)], "lon double, lat double")
    out = df.select(geohash("lon", "lat", 4).alias("g4"), geohash("lon", "lat", 5).alias("g5"),
                    geohash("lon", "lat", 7).alias("g7")).collect()
    assert [r.g4 for r in out] == ["ezs4", "9q8y", "zzzz", None, None, None]
    assert out[0].g5 == "ezs42" and out[0].g7 == "ezs42s0"
    assert out[1].g7 == "9q8yyk8"


def test_geohash_prefix_property(spark):
    df = spark.range(0, 500).select(
        ((F.col("id") * 7.919) % 360 - 180).alias("lon"),
        ((F.col("id") * 3.141) % 180 - 90).alias("lat"))
    rows = df.select(*[geohash("lon", "lat", p).alias(f"g{p}") for p in range(1, 9)]).collect()
    for r in rows:
        for p in range(1, 8):
            assert r[f"g{p + 1}"].startswith(r[f"g{p}"])


def test_phase_boundaries(spark):
    df = spark.createDataFrame(
        [(False, 9999.99), (False, 10000.0), (False, 28000.0), (False, 28000.01), (False, None),
         (True, 50000.0), (None, 500.0), (None, None)], "g boolean, ft double")
    got = [r.p for r in df.select(flight_phase(F.col("g"), F.col("ft")).alias("p")).collect()]
    assert got == [PHASE_LOW, PHASE_MID, PHASE_MID, PHASE_HIGH, PHASE_UNKNOWN, PHASE_GROUND,
                   PHASE_LOW, PHASE_UNKNOWN]


def test_time_is_zone_independent(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "Asia/Kolkata", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            r = spark.range(1).select(epoch_to_ntz(F.lit(1704067200 + 5 * 3600 + 1234)).alias("t")) \
                .select(F.col("t").cast("string").alias("t"),
                        hour_floor(F.col("t")).cast("string").alias("h"),
                        ntz_to_epoch(F.col("t")).alias("e")).first()
            assert r.t == "2024-01-01 05:20:34" and r.h == "2024-01-01 05:00:00"
            assert r.e == 1704067200 + 5 * 3600 + 1234
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


_BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def _bisect_geohash(lon, lat, precision):
    """The classic interval-halving encoder, as an independent reference."""
    lo_lon, hi_lon, lo_lat, hi_lat = -180.0, 180.0, -90.0, 90.0
    bits, out, even = [], [], True
    while len(out) < precision:
        if even:
            mid = (lo_lon + hi_lon) / 2
            bits.append(1 if lon >= mid else 0)
            lo_lon, hi_lon = (mid, hi_lon) if lon >= mid else (lo_lon, mid)
        else:
            mid = (lo_lat + hi_lat) / 2
            bits.append(1 if lat >= mid else 0)
            lo_lat, hi_lat = (mid, hi_lat) if lat >= mid else (lo_lat, mid)
        even = not even
        if len(bits) == 5:
            out.append(_BASE32[int("".join(map(str, bits)), 2)])
            bits = []
    return "".join(out)


def test_geohash_matches_bisection(spark):
    import random
    rnd = random.Random(11)
    pts = [(rnd.uniform(-179.999, 179.999), rnd.uniform(-89.999, 89.999)) for _ in range(400)]
    df = spark.createDataFrame(pts, "lon double, lat double")
    got = df.select("lon", "lat", *[geohash("lon", "lat", p).alias(f"g{p}") for p in (3, 4, 6, 9)])
    for r in got.collect():
        for p in (3, 4, 6, 9):
            assert r[f"g{p}"] == _bisect_geohash(r.lon, r.lat, p)
