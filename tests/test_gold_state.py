"""Incremental Gold: stored partials equal a full recount after any upserts."""

import random

from pyspark.sql import functions as F

from contrail.operators import gold as G
from contrail.plans import gold_state as GS
from contrail.plans import medallion as M
from contrail.plans import tables
from contrail.schemas import GOLD_COLUMNS
from helpers import silver_df, ts


def _rows(df):
    return sorted((tuple(r) for r in df.select(*GOLD_COLUMNS).collect()), key=repr)


def _batch(rng, load, n):
    """Reports of few aircraft at few times, so that batches supersede one another."""
    out = []
    for _ in range(n):
        when = f"2024-01-0{rng.randint(1, 2)} 0{rng.randint(0, 2)}:{rng.choice(('00', '20', '40'))}:00"
        out.append((f"a{rng.randint(0, 5)}", rng.choice((None, "", "C1", "C2")), rng.choice((None, "FRANCE", "SPAIN")), ts(when),
                    rng.choice((None, 1.5, 30.25)), rng.choice((None, 2.5, 40.25)), rng.choice((None, 500.0, 9000.0)),
                    rng.choice((None, 100.0, 201.0)), rng.choice((None, True, False)), ts(f"2024-01-03 0{load}:00:00")))
    return out


def test_random_upserts_equal_a_full_recount(spark, scratch):
    rng, wh = random.Random(5), f"{scratch}/wh"
    for load in range(4):
        rows = silver_df(spark, _batch(rng, load, (40, 6, 1, 25)[load]))
        M.upsert_layers(spark, wh, rows)
        silver = tables.read_silver(spark, f"{wh}/silver")
        assert _rows(tables.read_gold(spark, f"{wh}/gold")) == _rows(G.gold(silver))
        sketches = G.roll_up(GS.read_sketches(spark, f"{wh}/gold_sketches"), F.to_date("snapshot_hour").alias("day"))
        exact = silver.groupBy(F.to_date("time_position").alias("day")).agg(F.count_distinct("icao24").alias("n"))
        assert {tuple(r) for r in sketches.collect()} == {tuple(r) for r in exact.collect()}
    # a batch done again, also after only the state was published, changes nothing
    before = _rows(tables.read_gold(spark, f"{wh}/gold"))
    M.upsert_layers(spark, wh, rows)
    assert _rows(tables.read_gold(spark, f"{wh}/gold")) == before


def test_only_touched_pairs_are_read_again(spark, scratch):
    wh, n = f"{scratch}/wh", 50
    row = lambda k, day, load: (f"p{k}", "C", "FRANCE", ts(f"2024-01-0{day} 05:00:00"), 1.5, 2.5, 900.0, 100.0, False,
                                ts(f"2024-01-0{load} 00:00:00"))
    M.upsert_layers(spark, wh, silver_df(spark, [row(k, day, 5) for k in range(n) for day in (1, 2)]))
    touched = spark.createDataFrame([("p3", ts("2024-01-02 05:00:00"))], "icao24 string, snapshot_hour timestamp_ntz")
    assert GS.touched_silver(spark, f"{wh}/silver", touched).count() == 1
    M.upsert_layers(spark, wh, silver_df(spark, [row(3, 2, 6)[:4] + (30.0, 40.0, 900.0, 100.0, False, ts("2024-01-06 00:00:00"))]))
    gold = tables.read_gold(spark, f"{wh}/gold")
    assert sorted(r.unique_aircraft_count for r in gold.collect()) == [1, n - 1, n]      # p3 has moved on one day


def test_state_is_built_for_an_older_silver(spark, scratch):
    wh = f"{scratch}/wh"
    old, new = _batch(random.Random(1), 0, 20), _batch(random.Random(2), 1, 3)
    tables.upsert_silver(spark, f"{wh}/silver", silver_df(spark, old))
    M.upsert_layers(spark, wh, silver_df(spark, new))
    assert _rows(tables.read_gold(spark, f"{wh}/gold")) == _rows(G.gold(tables.read_silver(spark, f"{wh}/silver")))


def test_a_large_day_is_read_in_shares(spark, scratch):
    """One file of a day has several row groups, which the reader deals out."""
    day = F.lit("2024-01-01").cast("date")
    rows = spark.range(0, 2_000_000, 1, 1).select((F.rand(1) * 1e9).alias("x"), F.rand(2).alias("y"), F.xxhash64("id").alias("z"), day.alias(tables.DAY))
    tables._write_days(rows, f"{scratch}/days", tables.DAY)
    shares = spark.read.parquet(f"{scratch}/days").groupBy(F.input_file_name().alias("file"), F.spark_partition_id()).count().groupBy("file").count().collect()
    assert len(shares) == 1 and shares[0]["count"] > 2
