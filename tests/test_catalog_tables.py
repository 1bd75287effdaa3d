"""Silver and Gold as bucketed and partitioned tables of the catalog."""

import datetime as dt
import re

import pytest

from contrail.operators import silver as S
from contrail.plans import catalog_tables as C
from contrail.plans import tables
from contrail.plans.medallion import run
from contrail.schemas import SILVER
from tests.helpers import T0, silver_df, ts, vector
from tests.test_loads import payload, put


def row(icao, second, ingested, alt=1.0, day="2024-01-01"):
    at = ts(f"{day} 00:00:00") + dt.timedelta(seconds=second)
    return (icao, "C", "X", at, 1.0, 2.0, alt, 3.0, False, None if ingested is None else ts(ingested))


def content(df):
    return sorted((tuple(r) for r in df.select(*SILVER.fieldNames()).collect()), key=repr)


def batch(spark, first, n, ingested, day="2024-01-01"):
    return silver_df(spark, [row(f"a{k % 7}", k % 11, ingested, float(k), day) for k in range(first, first + n)])


def exchanges_above_scan(plan: str) -> int:
    """Exchanges between the scan of a bucketed table and the plan's root."""
    above, depth = [], None
    for line in plan.splitlines():
        at = len(re.match(r"[\s:+|-]*", line).group())
        if "Bucketed: true" in line:
            depth = at
            break
        above.append((at, line))
    assert depth is not None, plan
    found = 0
    for at, line in reversed(above):
        if at < depth:
            found += "Exchange" in line
            depth = at
    return found


def explained(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_upserts_equal_the_plain_merge_and_do_not_shuffle_stored_rows(spark, scratch):
    path, name = f"{scratch}/silver", "contrail_bucketed_a"
    C.create_silver(spark, name, path, 4)
    C.create_silver(spark, name, path, 4)                       # there already
    assert C.buckets(spark, name) == 4 and spark.table(name).count() == 0
    assert spark.table(name).schema.fieldNames() == [*SILVER.fieldNames(), "day"]
    parts = [batch(spark, 0, 60, "2024-01-02"), batch(spark, 30, 80, "2024-01-03"), batch(spark, 5, 40, None),
             batch(spark, 0, 20, "2024-01-09", "2024-01-05")]
    want = silver_df(spark, [])
    for part in parts:
        C.upsert_silver(spark, name, path, part)
        want = silver_df(spark, S.upsert(want, part).collect())
        assert content(spark.table(name)) == content(want)
        assert content(tables.read_silver(spark, path)) == content(want)      # the same files by path
    for part in (silver_df(spark, []), parts[1]):               # nothing, and a replay
        C.upsert_silver(spark, name, path, part)
        assert content(spark.table(name)) == content(want)
    assert spark.conf.get(C.OVERWRITE).lower() == "static"
    assert exchanges_above_scan(explained(C.merged(spark, name, parts[0], [dt.date(2024, 1, 1)]))) == 0
    assert "PartitionFilters: [isnotnull(day" in explained(spark.table(name).where(C.F.col("day").isin([dt.date(2024, 1, 1)])))
    # the files of a bucket hold its rows only, so a read by bucket loses nothing
    assert spark.table(name).groupBy("icao24").count().count() == want.select("icao24").distinct().count()
    assert exchanges_above_scan(explained(spark.table(name).groupBy("icao24").count())) == 0
    assert tables.folders(spark, tables._staging(path)) == []


def test_ingest_time_has_a_default(spark, scratch):
    C.create_silver(spark, "contrail_bucketed_b", f"{scratch}/silver", 2)
    spark.sql("INSERT INTO contrail_bucketed_b (icao24, time_position, day) "
              "VALUES ('x', timestamp_ntz'2024-01-01 00:00:05', date'2024-01-01')")
    got = spark.table("contrail_bucketed_b").collect()
    assert len(got) == 1 and got[0].ingested_at > ts("2024-01-01") and got[0].callsign is None


def test_a_table_over_existing_files_and_other_files(spark, scratch):
    path = f"{scratch}/silver"
    C.create_silver(spark, "contrail_bucketed_c", path, 3)
    C.upsert_silver(spark, "contrail_bucketed_c", path, batch(spark, 0, 50, "2024-01-02"))
    want = content(spark.table("contrail_bucketed_c"))
    spark.sql("DROP TABLE contrail_bucketed_c")                 # a catalog that forgot the table
    C.create_silver(spark, "contrail_bucketed_c", path, 3)
    assert content(spark.table("contrail_bucketed_c")) == want
    with pytest.raises(ValueError, match="without 5 buckets"):
        C.create_silver(spark, "contrail_bucketed_c5", path, 5)
    tables.upsert_silver(spark, f"{scratch}/plain", batch(spark, 0, 50, "2024-01-02"))
    with pytest.raises(ValueError, match="without 3 buckets"):
        C.create_silver(spark, "contrail_bucketed_c3", f"{scratch}/plain", 3)


def test_a_finished_staging_is_published_by_the_next_writer(spark, scratch):
    path, name = f"{scratch}/silver", "contrail_bucketed_d"
    C.create_silver(spark, name, path, 4)
    a, b = batch(spark, 0, 30, "2024-01-02"), batch(spark, 10, 60, "2024-01-03")
    C.upsert_silver(spark, name, path, a)
    C.stage(spark, name, path, C.merged(spark, name, b, [dt.date(2024, 1, 1)]))      # the writer dies before publishing
    tables.make_folder(spark, f"{tables._staging(path)}/days-unfinished")
    assert content(spark.table(name)) == content(S.latest(a))
    C.upsert_silver(spark, name, path, silver_df(spark, []))
    assert content(spark.table(name)) == content(S.upsert(a, b))
    assert tables.folders(spark, tables._staging(path)) == []


def test_run_writes_the_catalog_tables(spark, scratch):
    land = f"{scratch}/land"
    spark.sql(f"CREATE DATABASE contrail_run LOCATION '{scratch}/contrail_run.db'")
    put(land, "a.json", payload(vector(icao="a"), vector(icao="b"), vector(icao="a", alt="7")))
    plain, wh = f"{scratch}/plain", f"{scratch}/wh"
    run(spark, land, wh, database="contrail_run", n_buckets=4)
    put(land, "b.json", payload(vector(icao="a", tpos=T0 + 86400), vector(icao="c")))
    run(spark, land, plain)
    got = run(spark, land, wh, database="contrail_run", n_buckets=4)
    assert got.silver_rows == 4 and C.buckets(spark, "contrail_run.silver") == 4
    # ingest times are those of the files, equal in both runs
    assert content(spark.table("contrail_run.silver")) == content(tables.read_silver(spark, f"{plain}/silver"))
    gold = spark.table("contrail_run.gold")
    assert sorted(map(repr, gold.drop("snapshot_date").collect())) == sorted(map(repr, tables.read_gold(spark, f"{plain}/gold").collect()))
    assert gold.select("snapshot_date").distinct().count() == 2
    assert spark.table("contrail_run.country_hourly").count() == spark.read.parquet(f"{plain}/country_hourly").count() > 0
    with pytest.raises(ValueError, match="database"):
        run(spark, land, wh, mode="append", database="contrail_run")
