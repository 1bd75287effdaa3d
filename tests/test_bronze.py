import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from contrail.operators import gold as G
from contrail.operators import parse as P
from contrail.operators.bronze_silver import bronze_silver_rows
from contrail.plans import tables
from contrail.plans.medallion import run
from contrail.sources import bronze as B
from helpers import T0, vec_rows, vector


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def bronze(spark, scratch, land, **options):
    return B.load_bronze(spark, land, os.path.join(scratch, "bronze"), **{"ingested_at": "file"} | options)


def icaos(rows):
    return sorted(r.icao24 for r in rows.collect())


def test_file_shapes_and_skip(spark, scratch):
    land = os.path.join(scratch, "landing", "year=2024", "month=01", "day=01")
    payload = {"time": T0, "states": [vector(icao="p1"), vector(icao="p2", tpos=T0 + 60)]}
    record = {"icao24": "r1", "callsign": "N/A", "origin_country": "UNKNOWN",
              "time_position": T0, "longitude": 1.0, "latitude": 2.0, "baro_altitude": 100.0,
              "on_ground": False, "velocity": 50.0, "time_fetched": T0}
    _write(land, "a.json", json.dumps(payload) + "\n\n" + json.dumps(record) + "\n")
    _write(land, "b.json", json.dumps(payload) + "\n{\"states\": [[\"x\"\n")  # truncated
    _write(land, "c.txt", json.dumps(payload) + "\n")  # not a .json file
    rows = bronze(spark, scratch, os.path.join(scratch, "landing"))
    assert {os.path.basename(r.source_file) for r in rows.select("source_file").distinct().collect()} == {"a.json"}
    got = {r.icao24: r for r in bronze_silver_rows(rows).collect()}
    assert set(got) == {"p1", "p2", "r1"}
    assert got["r1"].callsign is None and got["r1"].origin_country is None  # labels undone
    assert B.bad_files(spark, os.path.join(scratch, "bronze")).count() == 1


def test_valid_json_of_other_types_costs_only_its_field(spark, scratch):
    land = os.path.join(scratch, "types")
    good = {"time": T0, "states": [vector(icao="g1")]}
    odd = {"time": float(T0), "states": ["not a vector", vector(icao="g2", vel={"a": 1}), 7, None, []],
           "new_field": [1, {"x": 2}]}
    _write(land, "a.json", json.dumps(good) + "\n" + json.dumps(odd) + "\n3\n\"text\"\nnull\n")
    rows = bronze(spark, scratch, land)
    got = {r.icao24: r for r in bronze_silver_rows(rows).collect()}
    assert set(got) == {"g1", "g2"} and got["g2"].velocity is None
    # nothing of the raw data is lost
    x = rows.select(F.try_variant_get("raw_data", "$.new_field[1].x", "int").alias("x")).where("x IS NOT NULL")
    assert [r.x for r in x.collect()] == [2]


def test_states_are_vectors_and_wrapped_records_are_not(spark, scratch):
    land = os.path.join(scratch, "wrapped")
    recs = [{"icao24": "w1", "time_position": T0}, {"icao24": "w2", "time_position": T0}]
    _write(land, "f.json", json.dumps({"records": recs}))
    _write(land, "g.json", json.dumps({"states": [vector(icao="s1"), vector(icao="s2")]}))
    _write(land, "h.json", json.dumps({"tags": [1, 2]}))
    rows = bronze(spark, scratch, land)
    assert rows.count() == 4
    assert icaos(bronze_silver_rows(rows)) == ["s1", "s2", "w1", "w2"]


def test_array_files(spark, scratch):
    land = os.path.join(scratch, "arr")
    p = [{"time": T0, "states": [vector(icao="v1"), [None] * 17]},
         {"time": T0, "states": [vector(icao="v2", on_ground="true")]}, {"time": T0, "states": []}]
    # numbers and booleans as JSON values, as the API sends them
    p[0]["states"][0][3] = T0
    p[0]["states"][0][5] = 1.5
    _write(land, "fetch_1.json", json.dumps(p, indent=2))
    rows = bronze(spark, scratch, land, multi_line=True, ingested_at=F.lit("2024-01-02 00:00:00"))
    got = {r.icao24: r for r in bronze_silver_rows(rows).collect()}
    assert set(got) == {"v1", "v2"} and got["v1"].longitude == 1.5 and got["v2"].on_ground
    assert got["v1"].ingested_at == dt.datetime(2024, 1, 2)


def test_impossible_epochs_are_dropped_and_reported(spark, scratch):
    from contrail.operators import quality as Q
    tposes = [T0, 99999999999999, -5, 4102444800, 4102444799, 10**30]
    vs = vec_rows(spark, [vector(icao=f"e{k}", tpos=t) for k, t in enumerate(tposes)])
    assert icaos(P.flatten_states(vs)) == ["e0", "e4"]
    bad = {r.icao24 for r in Q.quarantine(vs).where("reason = 'out_of_range:time_position'").collect()}
    assert bad == {"e1", "e2", "e3"}
    check = {r.check: r.failed_rows for r in Q.type_drift_checks(vs).collect()}
    assert check["in_range:time_position"] == 3
    land = os.path.join(scratch, "epochs")
    B.land_payloads(vs, land)
    assert icaos(bronze_silver_rows(bronze(spark, scratch, land))) == ["e0", "e4"]


def test_landing_roundtrip(spark, scratch):
    vs = vec_rows(spark, [vector(icao="l1"), vector(icao="l2")], time=T0, fetched=T0 + 3600 * 30)
    path = os.path.join(scratch, "landed")
    B.land_payloads(vs, path, hourly=True)
    B.land_records(P.parse_records(vs), os.path.join(scratch, "records"))
    dirs = sorted(os.listdir(os.path.join(path, "year=2024", "month=01", "day=02")))
    assert dirs == ["hour=06"]
    assert icaos(bronze_silver_rows(bronze(spark, scratch, path))) == ["l1", "l2"]
    other = os.path.join(scratch, "other")
    assert icaos(bronze_silver_rows(bronze(spark, other, os.path.join(scratch, "records")))) == ["l1", "l2"]


def rows_of(spark, vectors, hour):
    return P.flatten_states(vec_rows(spark, vectors, ingested=dt.datetime(2024, 1, 1, hour)))


def state(df):
    return sorted((r.icao24, r.baro_altitude) for r in df.collect())


DAY = 86400


def test_silver_upsert_is_idempotent(spark, scratch):
    path = os.path.join(scratch, "silver")
    assert tables.read_silver(spark, path).count() == 0
    a = rows_of(spark, [vector(alt="100"), vector(icao="other day", tpos=T0 + DAY)], 1)
    b = rows_of(spark, [vector(alt="200"), vector(icao="zz")], 2)
    tables.upsert_silver(spark, path, a)
    untouched = os.listdir(os.path.join(path, "day=2024-01-02"))
    want = [("abc123", 200.0), ("other day", 1000.0), ("zz", 1000.0)]
    for batch in (b, b, a):             # replays of the last and of the first batch
        tables.upsert_silver(spark, path, batch)
        assert state(tables.read_silver(spark, path)) == want
    tables.upsert_silver(spark, path, b.where("false"))
    assert state(tables.read_silver(spark, path)) == want
    assert len(untouched) == len(os.listdir(os.path.join(path, "day=2024-01-02")))
    assert tables.folders(spark, tables._staging(path)) == []


def test_crash_between_stage_and_publish(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "silver")
    tables.upsert_silver(spark, path, rows_of(spark, [vector(alt="100"), vector(icao="kept")], 1))
    publish = tables.publish

    def crash(*args):
        raise RuntimeError("lost driver")
    monkeypatch.setattr(tables, "publish", crash)
    b = rows_of(spark, [vector(alt="200")], 2)
    with pytest.raises(RuntimeError):
        tables.upsert_silver(spark, path, b)
    monkeypatch.setattr(tables, "publish", publish)
    assert len(tables.folders(spark, tables._staging(path))) == 1
    # a publication that stopped half way left the day without its files
    tables.remove(spark, f"{path}/day=2024-01-01")
    tables.upsert_silver(spark, path, rows_of(spark, [vector(icao="next", tpos=T0 + DAY)], 3))
    assert state(tables.read_silver(spark, path)) == [("abc123", 200.0), ("kept", 1000.0), ("next", 1000.0)]
    # an unfinished staging is dropped
    os.makedirs(os.path.join(tables._staging(path), "days-x", "day=2024-01-01"))
    tables.upsert_silver(spark, path, b)
    assert tables.folders(spark, tables._staging(path)) == []


def test_gold_full_refresh_drops_old_days(spark, scratch):
    path = os.path.join(scratch, "gold")
    one = G.gold(rows_of(spark, [vector(), vector(icao="b", tpos=T0 + DAY)], 1))
    tables.refresh_gold(spark, one, path, full=True)
    assert tables.read_gold(spark, path).count() == 2
    two = G.gold(rows_of(spark, [vector(icao="b", tpos=T0 + DAY), vector(icao="c", tpos=T0 + DAY)], 1))
    tables.refresh_gold(spark, two, path, full=False)
    got = {r.snapshot_hour.day: r.unique_aircraft_count for r in tables.read_gold(spark, path).collect()}
    assert got == {1: 1, 2: 2}
    tables.refresh_gold(spark, two, path, full=True)
    assert [r.snapshot_hour.day for r in tables.read_gold(spark, path).collect()] == [2]


def test_few_files_per_day(spark, scratch):
    vs = vec_rows(spark, [vector(icao=f"a{i}", tpos=T0 + DAY * (i % 3)) for i in range(200)]).repartition(20)
    path = os.path.join(scratch, "silver")
    tables.upsert_silver(spark, path, P.flatten_states(vs))
    for day in tables.folders(spark, path):
        assert len([f for f in os.listdir(os.path.join(path, day)) if f.endswith(".parquet")]) <= 2


def test_medallion_run(spark, scratch):
    land = os.path.join(scratch, "landing")
    vs = vec_rows(spark, [vector(icao=f"a{i}", tpos=T0 + 300 * i) for i in range(6)] + [vector(alt="n/a")])
    B.land_payloads(vs, land)
    wh = os.path.join(scratch, "wh")
    r1 = run(spark, land, wh)
    again = run(spark, land, wh)  # nothing new
    assert again.silver_rows == r1.silver_rows and B.read_ledger(spark, f"{wh}/bronze").select("load").distinct().count() == 1
    r2 = run(spark, land, wh, force=True)  # a full re-load of the same files
    assert r1.silver_rows == r2.silver_rows == 7 and r2.gold_rows == r1.gold_rows > 0
    assert tables.read_silver(spark, os.path.join(wh, "silver")).count() == 7
    assert spark.read.parquet(os.path.join(wh, "country_hourly")).count() == 1
    reasons = {r.reason for r in spark.read.parquet(os.path.join(wh, "quarantine")).collect()}
    assert reasons == {"unparsable:baro_altitude"}
    app = run(spark, land, wh + "_a", mode="append")
    app2 = run(spark, land, wh + "_a", mode="append", force=True)
    assert app.gold_rows == app2.gold_rows
    assert spark.read.parquet(os.path.join(wh + "_a", "silver_append")).count() == 7 + 7


def test_ensure_table_and_schema_drift(spark, scratch):
    from contrail.operators import quality as Q
    from contrail.schemas import SILVER
    path = os.path.join(scratch, "silver_tbl")
    tables.ensure_table(spark, "contrail_silver_t", SILVER, path)
    tables.ensure_table(spark, "contrail_silver_t", SILVER, path)  # idempotent
    assert spark.table("contrail_silver_t").schema == SILVER
    ok = Q.schema_drift(spark.table("contrail_silver_t"), SILVER, "silver")
    assert all(r[-1] for r in ok)
    drifted = spark.table("contrail_silver_t").drop("velocity").withColumn(
        "on_ground", F.lit("yes"))
    bad = {r[1]: r for r in Q.schema_drift(drifted, SILVER, "silver") if not r[-1]}
    assert set(bad) == {"schema:velocity:double", "schema:on_ground:boolean"}


def test_command_line(spark, scratch, capsys):
    from contrail.__main__ import main
    land = os.path.join(scratch, "cli_landing")
    B.land_payloads(vec_rows(spark, [vector(icao=f"c{i}") for i in range(3)]), land)
    main(["run", "--landing", land, "--warehouse", os.path.join(scratch, "cli_wh")])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out == {"silver_rows": 3, "gold_rows": 1}
    # stream into the tables of the batch run, other days, then the run again
    B.land_payloads(vec_rows(spark, [vector(icao="s", tpos=T0 + DAY)]), land)
    main(["stream", "--landing", land, "--warehouse", os.path.join(scratch, "cli_wh")])
    main(["run", "--landing", land, "--warehouse", os.path.join(scratch, "cli_wh")])
    main(["stream", "--landing", land, "--warehouse", os.path.join(scratch, "cli_wh")])
    wh = os.path.join(scratch, "cli_wh")
    assert tables.read_silver(spark, f"{wh}/silver").count() == 4
    assert {r.snapshot_hour.day for r in tables.read_gold(spark, f"{wh}/gold").collect()} == {1, 2}


def test_stored_bronze_keeps_everything(spark, scratch):
    land = os.path.join(scratch, "lb_landing")
    long_bad = "{" + "x" * 500  # longer than any preview: reported whole
    _write(land, "good.json", json.dumps({"time": T0, "states": [vector(icao="g1")]}) + "\n")
    _write(land, "bad.json", json.dumps({"time": T0, "states": [vector(icao="b1")]}) + "\n" + long_bad + "\n")
    good = bronze(spark, scratch, land, ingested_at=None)
    assert icaos(bronze_silver_rows(good)) == ["g1"]
    path = os.path.join(scratch, "bronze")
    raw = spark.read.schema(B.BRONZE).parquet(path)  # the table keeps every row
    assert raw.count() == 3 and raw.select("source_file").distinct().count() == 2
    assert dict(raw.dtypes)["raw_data"] == "variant"
    # the ingest time is stored: the same in every read
    times = [r.ingested_at for r in raw.collect()]
    assert times == [r.ingested_at for r in raw.collect()] and None not in times
    rows = B.bad_files(spark, path).collect()
    assert len(rows) == 1 and os.path.basename(rows[0].source_file) == "bad.json"
    assert rows[0].bad_values == 1 and rows[0].sample == long_bad
