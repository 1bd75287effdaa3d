import datetime as dt

from pyspark.sql import functions as F

from contrail.operators import parse as P
from contrail.operators import silver as S
from helpers import T0, vec_rows, vector


def test_record_path_rules(spark):
    vs = [vector(call=None), vector(call=""), vector(call="   "), vector(call="\tUAL1 "),
          vector(country=None), vector(country=" france "), vector(on_ground=None),
          vector(slots=16), vector(slots=0)]
    out = P.parse_records(vec_rows(spark, vs, fetched=0, time=T0 + 7)).collect()
    assert len(out) == 7  # the 16-slot and the empty vector are rejected
    assert [r.callsign for r in out[:4]] == ["N/A", "N/A", "", "UAL1"]
    assert out[4].origin_country == "UNKNOWN" and out[5].origin_country == " france "
    assert out[6].on_ground is False
    assert all(r.time_fetched == T0 + 7 for r in out)  # fetched_at 0 is falsy


def test_silver_path_rules(spark):
    vs = [vector(call="  UAL1 ", country=" france "), vector(on_ground=None),
          vector(slots=16, icao="short1"), vector(tpos=None), vector(icao=None),
          vector(alt="n/a", icao="bad1"), vector(tpos="1704067200.6", icao="round1")]
    rows = {r.icao24: r for r in P.flatten_states(vec_rows(spark, vs)).collect()}
    assert "short1" in rows  # no length rule on the Silver path
    assert len(rows) == 4
    r = rows["abc123"]
    assert r.callsign == "UAL1" and r.origin_country == "FRANCE"
    assert rows["bad1"].baro_altitude is None
    assert rows["round1"].time_position == dt.datetime(2024, 1, 1, 0, 0, 1)


def test_latest_wins_and_idempotent(spark):
    early, late = dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 2)
    a = vec_rows(spark, [vector(alt="100")], ingested=early)
    b = vec_rows(spark, [vector(alt="200")], ingested=late)
    rows = P.flatten_states(a.unionByName(b))
    once = S.latest(rows)
    assert [r.baro_altitude for r in once.collect()] == [200.0]
    twice = S.latest(once.unionByName(once))
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    up = S.upsert(S.latest(P.flatten_states(b)), P.flatten_states(a))
    assert [r.baro_altitude for r in up.collect()] == [200.0]
    assert S.append(once, rows).count() == 2  # parity mode keeps repeats


def test_json_null_time_dropped(spark):
    vs = [vector(tpos=None)]
    assert P.flatten_states(vec_rows(spark, vs)).count() == 0
    assert P.flatten_states(vec_rows(spark, vs), drop_null_keys=False).filter(
        F.col("time_position").isNull()).count() == 1
