"""Load ledger, accounting, drift, gates, and the stream of whole loads."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from contrail.operators import accounting as A
from contrail.plans import catalog, tables
from contrail.plans.medallion import ingest_load, run, unfinished_loads
from contrail.sources import bronze as B
from contrail.streaming import incremental as STR
from helpers import T0, vec_rows, vector


def put(folder, name, *values, raw=()):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("".join(json.dumps(v) + "\n" for v in values) + "".join(x + "\n" for x in raw))


def payload(*vectors, **more):
    return {"time": T0, "states": list(vectors)} | more


def names(spark, table, load=None):
    objects = B.read_bronze(spark, table, load)
    return sorted(r.i for r in objects.select(F.try_variant_get("raw_data", "$.states[0][0]", "string").alias("i")).collect())


def outcomes(df):
    return {r.outcome: r.n for r in df.collect()}


def test_only_new_and_changed_files_are_loaded(spark, scratch):
    land, table = f"{scratch}/land", f"{scratch}/bronze"
    put(land, "a.json", payload(vector(icao="a")))
    put(land, "b.json", payload(vector(icao="b")), raw=["{broken"])
    put(land, "empty.json", raw=[" "])                                           # blank lines are no values
    put(land, "odd [1] {x}.json", payload(vector(icao="o")))
    assert B.load_files(spark, land, table, ingested_at="file") == "batch-000000000000"
    assert names(spark, table) == ["a", "o"]
    assert B.load_files(spark, land, table, ingested_at="file") is None         # nothing new
    time.sleep(1.1)
    put(land, "b.json", payload(vector(icao="b")), payload(vector(icao="b2")))   # repaired
    put(land, "c.json", payload(vector(icao="c")))
    second = B.load_files(spark, land, table, ingested_at="file")
    assert names(spark, table, second) == ["b", "b2", "c"] and names(spark, table) == ["a", "b", "b2", "c", "o"]
    ledger = {(os.path.basename(r.source_file), r.load[-1]): (r.n_values, r.bad_values) for r in B.read_ledger(spark, table).collect()}
    assert ledger == {("a.json", "0"): (1, 0), ("b.json", "0"): (2, 1), ("empty.json", "0"): (0, 0),
                      ("odd%20%5B1%5D%20%7Bx%7D.json", "0"): (1, 0), ("b.json", "1"): (2, 0), ("c.json", "1"): (1, 0)}
    assert [r.bad_values for r in B.bad_files(spark, table).collect()] == [1]
    third = B.load_files(spark, land, table, ingested_at="file", force=True, files_per_read=2)
    assert names(spark, table, third) == ["a", "b", "b2", "c", "o"]
    assert tables.folders(spark, scratch) and not tables.exists(spark, f"{table}__pending")


def test_an_unfinished_load_is_not_seen_and_done_again(spark, scratch):
    land, table = f"{scratch}/land", f"{scratch}/bronze"
    put(land, "a.json", payload(vector(icao="a")))
    B.load_files(spark, land, table, ingested_at="file")
    put(land, "b.json", payload(vector(icao="b")))
    lines = spark.read.text(f"{land}/b.json")
    B.write_load(B.parse_text(lines), table, "batch-000000000001")              # the writer dies before its commit
    assert names(spark, table) == ["a"]
    assert B.load_files(spark, land, table, ingested_at="file") == "batch-000000000001"
    assert names(spark, table) == ["a", "b"]


def test_days_prune_the_landing(spark, scratch):
    land, table = f"{scratch}/land", f"{scratch}/bronze"
    for k in range(5):
        B.land_payloads(vec_rows(spark, [vector(icao=f"d{k}")], time=T0 + 86400 * (29 + k)), land)  # Jan 30 .. Feb 3
    files = B.landed_files(spark, land, days=("2024-01-31", "2024-02-01"))
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [((" in plan and files.count() == 2
    B.load_files(spark, land, table, ingested_at="file", days=("2024-01-31", "2024-02-01"))
    assert names(spark, table) == ["d1", "d2"]
    B.load_files(spark, land, table, ingested_at="file")
    assert names(spark, table) == [f"d{k}" for k in range(5)]


def test_every_unit_has_one_outcome(spark, scratch):
    land, table = f"{scratch}/land", f"{scratch}/bronze"
    record = {"icao24": "r", "time_position": T0}
    put(land, "good.json", payload(vector(icao="p"), vector(icao="p", alt="2"), "no vector", None, [], [None, "x"], vector(icao=None)),
        payload(), record, [record, payload(vector(icao="q")), 7, payload()], {"records": [record, {"icao24": None}]},
        {"icao24": "t"}, {"icao24": "t", "time_position": None}, {"icao24": "t", "time_position": -1}, {"icao24": "t", "time_position": [1]},
        5, "text", None, [], {}, {"states": None}, {"states": 3, "icao24": "s", "time_position": T0})
    put(land, "bad.json", payload(vector(icao="x"), vector(icao="y")), raw=["{", "}"])
    B.load_files(spark, land, table, ingested_at="file")
    values = B.stored_values(spark, table)
    got = outcomes(A.conservation(values))
    assert got == {"silver": 4, "superseded": 3, "not_a_record": 6, "null_icao24": 6, "empty_payload": 2, "empty_array": 1,
                   "null_time_position": 2, "invalid_time_position": 2, "unparsable": 2, "file_skipped": 1}
    assert sum(got.values()) == A.landed(values).first().n
    from contrail.operators.bronze_silver import bronze_silver_rows
    assert bronze_silver_rows(B.read_bronze(spark, table)).count() == got["silver"] + got["superseded"]
    rejects = A.rejects(values).collect()
    assert len(rejects) == 18 and {r.raw_text for r in rejects if r.outcome == "unparsable"} == {"{", "}"}
    assert A.conservation(values.where("false")).count() == 0


def test_drift_of_fields(spark, scratch):
    land, table = f"{scratch}/land", f"{scratch}/bronze"
    typed = ["a", "C", "X", T0, T0, 1.5, 2, None, True, 3.25, 1, 0, None, 5, "7000", False, 0]
    put(land, "a.json", payload(typed, vector()[:16] + ["0", "extra"], fetched_at=T0), {"icao24": 7, "velocity": "fast", "on_ground": {"x": 1}})
    B.load_files(spark, land, table, ingested_at="file")
    got = {(r["shape"], r["field"]): (r.found, r.n, r.status) for r in A.variant_drift(B.stored_values(spark, table)).collect()}
    assert got["payload", "fetched_at"] == ("number", 1, "same") and got["payload", "states"] == ("array", 1, "same")
    assert got["vector", "time_position"] == ("mixed", 2, "retyped")             # a number and a text
    assert got["vector", "icao24"] == ("string", 2, "same") and got["vector", "slot_12"] == ("null", 2, "same")
    assert got["vector", "slot_17"] == ("string", 1, "new")
    assert got["record", "icao24"] == ("number", 1, "retyped") and got["record", "on_ground"] == ("object", 1, "retyped")
    assert got["record", "squawk"] == (None, 0, "vanished") and got["record", "velocity"] == ("string", 1, "same")


def test_gates_see_their_own_load(spark, scratch):
    land, wh = f"{scratch}/land", f"{scratch}/wh"
    put(land, "a.json", payload(vector(icao="a"), vector(icao="b")))
    first = run(spark, land, wh, max_lag_seconds=10**10)
    assert first.silver_rows == 2 and {r.check for r in first.checks.collect()} >= {
        "conservation", "fields_retyped", "freshness:snapshot_hour<=10000000000s"}
    put(land, "b.json", payload())                                               # an empty fetch into full tables
    with pytest.raises(ValueError, match="silver_input/row_count>0"):
        run(spark, land, wh)
    assert tables.read_silver(spark, f"{wh}/silver").count() == 2 and unfinished_loads(spark, wh) == []
    put(land, "c.json", payload(vector(icao="c")))
    third = run(spark, land, wh)
    assert third.silver_rows == 3
    counted = spark.read.parquet(f"{wh}/accounting").groupBy("load").pivot("outcome").sum("n").orderBy("load").collect()
    assert [(r.silver, r.empty_payload) for r in counted] == [(2, None), (None, 1), (1, None)]
    put(land, "d.json", payload(vector(icao="late")))
    with pytest.raises(ValueError, match="gold/freshness"):
        run(spark, land, wh, max_lag_seconds=60)
    put(land, "e.json", {"icao24": "r", "time_position": T0, "velocity": [1]})
    with pytest.raises(ValueError, match="bronze/fields_retyped"):
        run(spark, land, wh, fail_on_drift=True)


def test_a_load_that_was_not_finished_is_taken_on(spark, scratch):
    land, wh = f"{scratch}/land", f"{scratch}/wh"
    put(land, "a.json", payload(vector(icao="a")))
    load = B.load_files(spark, land, f"{wh}/bronze", ingested_at="file")         # the run dies after the load
    assert unfinished_loads(spark, wh) == [load]
    assert run(spark, land, wh).silver_rows == 1 and unfinished_loads(spark, wh) == []
    ingest_load(spark, wh, load)                                                 # again: the same tables
    assert tables.read_silver(spark, f"{wh}/silver").count() == 1
    assert spark.read.parquet(f"{wh}/accounting").count() == 1


TABLES = ("quarantine", "rejects", "drift", "accounting")


def content(spark, wh):
    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)
    bronze = B.stored_values(spark, f"{wh}/bronze").select(F.to_json("raw_data"), "ingested_at", "source_file", "bad_text", "file_skipped")
    out = {"bronze": rows(bronze), "silver": rows(tables.read_silver(spark, f"{wh}/silver")), "gold": rows(tables.read_gold(spark, f"{wh}/gold"))}
    for name in ("quarantine", "rejects"):
        out[name] = rows(spark.read.parquet(f"{wh}/{name}").drop("load"))
    return out


def test_a_stream_writes_what_a_run_writes(spark, scratch):
    land = f"{scratch}/land"
    put(land, "a.json", payload(vector(icao="a"), vector(icao="b", alt="n/a")))
    put(land, "b.json", payload(vector(icao="a", alt="9"), "no vector"), 7)
    put(land, "c.json", payload(vector(icao="c", tpos=T0 + 90_000)), raw=["{broken"])
    put(land, "d.json", payload(vector(icao="d", tpos=T0 + 90_000), vector(icao=None)))
    run(spark, land, f"{scratch}/run")
    want = content(spark, f"{scratch}/run")

    def stream(wh, checkpoint, files=1):
        STR.run_available(STR.medallion_stream(spark, STR.bronze_stream(spark, land, files), wh, checkpoint))
    wh = f"{scratch}/stream"
    stream(wh, f"{scratch}/ck1")
    assert content(spark, wh) == want
    assert B.read_ledger(spark, f"{wh}/bronze").select("load").distinct().count() == 4
    stream(wh, f"{scratch}/ck2", files=3)               # the checkpoint is lost: every file comes again
    assert content(spark, wh) == want
    handle = STR.medallion_batch(spark, wh, "again")    # the same batch twice, with a new file
    put(land, "e.json", payload(vector(icao="e")))
    batch = B.parse_text(spark.read.text(f"{land}/e.json"))
    handle(batch, 0)
    once = content(spark, wh)
    handle(batch, 0)
    assert content(spark, wh) == once and len(once["silver"]) == len(want["silver"]) + 1
    assert run(spark, land, wh).silver_rows == len(once["silver"])     # a run on the stream's tables: nothing new


def test_load_queries_without_a_fixed_file_layout(spark):
    rows = {(r.landing, r.load[-1]): r for r in catalog.q_bronze_loads(spark, "/root/testdata/sf0.001").collect()}
    assert rows["files", "0"].skipped_values == 3 and rows["files", "1"].good_values == 3 and ("feed", "2") not in rows
