import json
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from contrail.operators import gold as G
from contrail.operators import silver as S
from contrail.operators.bronze_silver import bronze_silver_rows
from contrail.plans import catalog, tables
from contrail.schemas import GOLD_COLUMNS
from contrail.sources import bronze as B
from contrail.sources.tables import stream_table, table
from contrail.streaming import incremental as STR
from helpers import T0, vector


def _land(path, name, vectors):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(json.dumps({"time": T0, "states": vectors}) + "\n")


def _rows(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_stream_upsert_equals_batch(spark, scratch):
    land = os.path.join(scratch, "landing")
    _land(land, "f1.json", [vector(icao=f"a{i}", tpos=T0 + 300 * i, alt="1000") for i in range(5)])
    root = os.path.join(scratch, "out")
    q = STR.upsert_stream(spark, STR.bronze_stream(spark, land, max_files=1),
                          f"{root}/silver", f"{root}/gold", f"{root}/ckpt")
    STR.run_available(q)
    time.sleep(1.1)  # a later modification time marks the later ingest
    _land(land, "f2.json", [vector(icao="a0", tpos=T0, alt="9000"),
                            vector(icao="b1", tpos=T0 + 86400)])  # new day
    _land(land, "f3.json", ["not a vector"] + [vector(icao="ok", tpos=T0 + 60)])  # costs that vector only
    with open(os.path.join(land, "f4.json"), "w") as f:                           # no JSON: file skipped
        f.write(json.dumps({"states": [vector(icao="bad")]}) + "\n{broken\n")
    q = STR.upsert_stream(spark, STR.bronze_stream(spark, land, max_files=1),
                          f"{root}/silver", f"{root}/gold", f"{root}/ckpt")
    STR.run_available(q)
    streamed = tables.read_silver(spark, f"{root}/silver")
    batch = S.latest(bronze_silver_rows(B.load_bronze(spark, land, f"{root}/bronze", ingested_at="file")))
    assert streamed.where("icao24 IN ('ok', 'bad')").count() == 1
    assert _rows(streamed.collect()) == _rows(batch.collect())
    assert [r.baro_altitude for r in streamed.filter(F.col("icao24") == "a0").collect()] == [9000.0]
    gold_stream = tables.read_gold(spark, f"{root}/gold").select(*GOLD_COLUMNS)
    assert _rows(gold_stream.collect()) == _rows(G.gold(batch).collect())
    # a reset checkpoint replays batch 0 and everything after it
    again = STR.upsert_stream(spark, STR.bronze_stream(spark, land, max_files=2),
                              f"{root}/silver", f"{root}/gold", f"{root}/ckpt2")
    STR.run_available(again)
    assert _rows(tables.read_silver(spark, f"{root}/silver").collect()) == _rows(batch.collect())
    assert _rows(tables.read_gold(spark, f"{root}/gold").collect()) == _rows(G.gold(batch).collect())


def test_dedup_and_hourly_streams(spark, scratch):
    land = os.path.join(scratch, "landing2")
    _land(land, "f1.json", [vector(icao="a1"), vector(icao="a1"), vector(icao="a2"),
                            vector(icao="a3", tpos=T0 + 3600)])
    rows = STR.bronze_stream(spark, land).transform(bronze_silver_rows)
    q1 = (STR.dedup_stream(rows).writeStream.format("memory").queryName("dedup_t")
          .trigger(availableNow=True).start())
    q1.awaitTermination()
    assert spark.table("dedup_t").count() == 3
    q2 = (STR.hourly_traffic_stream(rows).writeStream.format("memory").queryName("hourly_t")
          .outputMode("update").trigger(availableNow=True).start())
    q2.awaitTermination()
    got = {(r.flight_hour.hour, r.approx_aircraft) for r in spark.table("hourly_t").collect()}
    assert got == {(0, 2), (1, 1)}


DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver test data absent")
def test_folder_tables_and_new_files(spark, scratch):
    """events as three part files, in three micro-batches, gives the rows of
    the single file; a file that is added later is seen."""
    events = spark.read.parquet(f"{DATA}/events.parquet")
    shutil.copy(f"{DATA}/nation.parquet", f"{scratch}/nation.parquet")
    events.repartition(3, "event_id").write.parquet(f"{scratch}/events.parquet")
    single = _rows(catalog.q_silver_latest(spark, DATA).collect())
    assert _rows(catalog.q_silver_latest(spark, scratch).collect()) == single
    assert _rows(catalog.q_stream_silver(spark, scratch, max_files=1).collect()) == single
    keys = sorted(((r[0], r[3]) for r in single), key=repr)
    assert _rows(catalog.q_stream_dedup_keys(spark, scratch, max_files=1).collect()) == keys
    hourly = _rows(catalog.q_stream_hourly_traffic(spark, DATA).collect())
    assert _rows(catalog.q_stream_hourly_traffic(spark, scratch, max_files=1).collect()) == hourly
    # too short a delay drops late reports, as a watermark should
    assert catalog.q_stream_dedup_keys(spark, scratch, max_files=1, delay="0 seconds").count() <= len(keys)
    before = table(spark, scratch, "events").count()
    events.limit(50).write.mode("append").parquet(f"{scratch}/events.parquet")
    assert table(spark, scratch, "events").count() == before + 50
    with pytest.raises(Exception, match="events|exist"):
        stream_table(spark, f"{scratch}/nowhere", "events", 1)
